"""Sharding, mixing and packing: laws, round trips and exact optima."""

import functools
import itertools
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lapwise.llm import mixing, packing, sharding


@pytest.mark.parametrize("copies", [0, 400])
def test_shards_differ_by_one(rows, copies):
    data = [(i, f"text {i}") for i in range(233)] + [(7, "hot")] * copies + [(None, None), (5, ""), (6, "é")]
    found = sharding.assign(rows("doc_id long, text string, shard int", *[(*d, 0) for d in data])).collect()
    assert len(found) == len(data)
    slots = defaultdict(list)
    for row in found:
        slots[row["shard"]].append(row["slot"])
    sizes = Counter(len(v) for v in slots.values())
    assert len(slots) == 40 and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in data)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == want
    assert {r["law"] for r in found} == {"rows"} and {r["grown_shard"] for r in found} == {None}


def test_few_rows_and_none(rows):
    df = rows("doc_id long, text string", (1, "a"), (2, "b"))
    assert sorted(r["slot"] for r in sharding.assign(df).collect()) == [0, 0]
    assert sharding.assign(df.limit(0)).count() == 0


def test_walk_moves_few_rows():
    rng = np.random.default_rng(1)
    points = sharding.ring(10)
    demand = rng.multinomial(20_000, rng.dirichlet(np.full(len(points), 5))).tolist()

    def homes(extra):
        total = sum(demand) + extra
        bounds = [total // 10 + (s < total % 10) for s in range(10)]
        now = list(demand)
        now[3] += extra
        return {
            (arc, rank): shard for arc, low, high, shard, _ in sharding.walk(now, points, bounds)
            for rank in range(low, high)
        }

    before, after = homes(0), homes(100)
    assert len(before) == 20_000 and sum(before[k] != after[k] for k in before) < 2_000


def test_shards_do_not_depend_on_the_layout(rows, monkeypatch):
    """The same rows in other files, or beside one row more, keep their shards."""
    monkeypatch.setattr(sharding, "BLOCK", 16)
    data = [(i, f"text {i}") for i in range(900)] + [(7, "hot")] * 400 + [(None, f"t{i}") for i in range(90)] + [(None, None)] * 3
    df = rows("doc_id long, text string", *data)

    def placed(df):
        return Counter(tuple(r) for r in sharding.assign(df).collect())

    whole = placed(df)
    assert sum(whole.values()) == len(data)
    assert placed(df.repartition(7)) == whole == placed(df.coalesce(1).orderBy("text"))
    homes = Counter((r[0], r[2], r[4]) for r in whole.elements())
    more = Counter((r[0], r[2], r[4]) for r in placed(rows("doc_id long, text string", (5_000, "new"), *data)).elements())
    assert (homes - more).total() < len(data) * 0.05


def test_points_have_places_of_their_own():
    points = sharding.ring(40)
    assert len({place for place, _ in points}) == len(points) == 40 * sharding.POINTS


def test_raking_meets_all_marginals(spark, rows):
    cells = rows(
        "_source string, _lang string, _topic string, _sum long",
        *[(s, x, t, 10 + 7 * i) for i, (s, x, t) in enumerate(itertools.product("abc", "xy", "pq"))],
    )
    goal = {
        "_source": {"a": 0.5, "b": 0.3, "c": 0.2, "missing": 1.0}, "_lang": {"x": 1, "y": 3}, "_topic": {"p": 1, "q": 1},
    }
    goal["_source"].pop("missing")
    raked = mixing.rake(cells, goal, rounds=30, keep=0.1)
    found = raked.collect()
    tokens = 0.1 * sum(r["_sum"] for r in found)
    for name, want in goal.items():
        whole = sum(want.values())
        for value, share in want.items():
            assert abs(sum(r["_weight"] for r in found if r[name] == value) / tokens - share / whole) < 1e-6
    assert all(abs(r["wanted"] - r["reached"]) < 1e-6 for r in mixing.marginals(raked).collect())
    # The same factors by plain proportional fitting, as no cell is short of tokens.
    table = np.array([10.0 + 7 * i for i in range(12)]).reshape(3, 2, 2)
    for _ in range(30):
        for axis, want in enumerate(([0.5, 0.3, 0.2], [0.25, 0.75], [0.5, 0.5])):
            others = tuple(a for a in range(3) if a != axis)
            shape = [1, 1, 1]
            shape[axis] = -1
            table *= (np.array(want) / table.sum(axis=others)).reshape(shape)
    assert max(r["_probability"] for r in found) < 1
    have = {(r["_source"], r["_lang"], r["_topic"]): r["_weight"] for r in found}
    for (i, s), (j, x), (k, t) in itertools.product(enumerate("abc"), enumerate("xy"), enumerate("pq")):
        assert abs(have[s, x, t] - tokens * table[i, j, k]) < 1e-6


def test_short_cells_are_kept_whole_and_the_others_raked(rows):
    cells = rows(
        "_source string, _lang string, _topic string, _sum long",
        ("a", "x", "p", 1000), ("a", "y", "p", 1000), ("b", "x", "p", 10), ("b", "y", "p", 1000), ("c", "x", "p", 40),
    )
    goal = {"_source": {"a": 0.5, "b": 0.3, "c": 0.2}, "_lang": {"x": 0.5, "y": 0.5}, "_topic": {"p": 1}}
    raked = mixing.rake(cells, goal, rounds=60, keep=0.4)
    have = {(r["_source"], r["_lang"]): r for r in raked.collect()}
    assert have["c", "x"]["_probability"] == 1.0 == have["b", "x"]["_probability"]
    assert all(0 < r["_weight"] <= r["_sum"] for r in have.values())
    reached = {(r["dimension"], r["value"]): (r["wanted"], r["reached"]) for r in mixing.marginals(raked).collect()}
    assert reached["source", "c"][1] < 0.2 and reached["source", "c"][0] == pytest.approx(0.2)  # too few tokens at all


def test_one_stray_document_changes_little(rows):
    rng = np.random.default_rng(2)
    data = [
        (i, "word " * int(rng.integers(1, 1200)), "hot" if i % 3 else f"s{i % 17}", rng.choice(["en", "fr", "de"]).item())
        for i in range(1500)
    ]
    stray = [(9000, "word " * 20, "alone", "xx")]

    def kept(given):
        found = mixing.weigh(rows("doc_id long, text string, source string, lang string", *given)).collect()
        tokens = sum(r["n_tokens"] for r in found)
        return sum(r["n_tokens"] * r["probability"] for r in found), tokens

    (before, tokens), (after, _) = kept(data), kept(data + stray)
    assert abs(before / tokens - mixing.KEEP) < 0.02 and abs(after - before) < 0.01 * before


def test_mixture_samples_what_it_weighs(rows):
    data = [(i, "word " * (i % 900 + 1), f"s{i % 3 if i % 5 else 0}", "en" if i % 4 else None, "z") for i in range(900)]
    data += [(2000, None, "s0", "en", "z"), (None, "a b", None, "fr", "z"), (5, "word", "s1", "en", "z")]
    df = rows("doc_id long, text string, source string, lang string, _tokens string", *data)
    weighed, kept = mixing.weigh(df).collect(), mixing.sample(df).collect()
    assert len(weighed) == len(data)
    assert Counter(r["doc_id"] for r in kept) == Counter(r["doc_id"] for r in weighed if r["kept"])
    assert kept[0].asDict().keys() == set(df.columns)
    assert all(0 <= r["probability"] <= 1 for r in weighed)
    expected = sum(r["probability"] for r in weighed)
    assert abs(len(kept) - expected) < 4 * expected**0.5
    assert mixing.weigh(df.limit(0)).count() == 0


def optimum(lengths, capacity):
    """Fewest sequences, by trying everything."""
    @functools.cache
    def best(left):
        if not left:
            return 0
        first, rest, found = left[0], left[1:], len(left)
        for size in range(len(rest) + 1):
            for chosen in set(itertools.combinations(rest, size)):
                if first + sum(chosen) <= capacity:
                    other = list(rest)
                    for c in chosen:
                        other.remove(c)
                    found = min(found, 1 + best(tuple(other)))
        return found

    return best(tuple(sorted(lengths, reverse=True)))


def test_reduction_keeps_an_optimum():
    rng = np.random.default_rng(4)
    fixed_some = 0
    for _ in range(150):
        capacity = int(rng.integers(6, 25))
        lengths = rng.integers(1, capacity + 1, rng.integers(1, 10)).tolist()
        counts = np.bincount(lengths, minlength=capacity + 1)
        fixed, left = packing.reduced(counts)
        rest = np.repeat(np.arange(capacity + 1), left).tolist()
        number = sum(times for _, times in fixed)
        fixed_some += number > 0
        assert number + optimum(rest, capacity) == optimum(lengths, capacity), lengths
        assert all(sum(length * many for length, many in p) <= capacity for p, _ in fixed)
    assert fixed_some > 50


def lower_bound(length, capacity):
    """Martello and Toth's bound L2."""
    found = 0
    for cut in range(capacity // 2 + 1):
        big = length > capacity - cut
        half = ~big & (2 * length > capacity)
        small = length[(2 * length <= capacity) & (length >= cut)].sum()
        room = half.sum() * capacity - length[half].sum()
        found = max(found, big.sum() + half.sum() + max(0, -(-(small - room) // capacity)))
    return found


def test_plan_places_every_rank_once():
    rng = np.random.default_rng(5)
    counts = np.bincount(rng.integers(1, 65, 5000), minlength=65)
    rules = packing.plan(counts)
    length = np.repeat(np.arange(65), counts)
    rank = np.concatenate([np.arange(n) for n in counts])
    at = rules[packing._rule(rules, length, rank)]
    sequence, offset = at[:, 3] + (rank - at[:, 1]) // at[:, 2], at[:, 4] + (rank - at[:, 1]) % at[:, 2] * length
    for s in range(sequence.max() + 1):
        own = np.argsort(offset[sequence == s])
        ends = np.cumsum(length[sequence == s][own])
        assert (offset[sequence == s][own] == np.concatenate([[0], ends[:-1]])).all() and ends[-1] <= 64
    assert sequence.max() + 1 <= lower_bound(length, 64) + 2


def test_packing_round_trip(rows):
    data = [(i, f"piece {i} " * (i % 200)) for i in range(300)] + [(400, None), (401, ""), (None, "x"), (3, "again " * 9)]
    data += [(402, "very long words " * 2000)]
    df = rows("doc_id long, text string, piece string, length string", *[(*d, "x", "y") for d in data])
    found = packing.pack(df, ids=True).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter((i, *tokenizer.encode(t or "", add_special_tokens=False).ids, 2) for i, t in data if i != 3)
    docs, sequences = defaultdict(list), defaultdict(list)
    for row in found:
        assert zlib.crc32(np.array(row["ids"], "<u4").tobytes()) == row["ids_crc32"] and len(row["ids"]) == row["length"]
        docs[row["doc_id"]].append(row)
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
    for name, own in docs.items():
        if name != 3:
            own.sort(key=lambda r: r["piece"])
            assert want.pop((name, *itertools.chain(*[r["ids"] for r in own])))
            assert [r["start"] for r in own] == [0, *itertools.accumulate(r["length"] for r in own[:-1])]
            assert all(r["length"] == 1024 for r in own[1:])
    assert not want
    for places in sequences.values():
        places.sort()
        assert [p for p, _ in places] == [0, *itertools.accumulate(n for _, n in places[:-1])]
        assert sum(n for _, n in places) <= 1024
    assert packing.pack(df.limit(0)).count() == 0
