"""Near-duplicate groups, components and top-k search against brute force."""

import random

import numpy as np
from pyspark.sql import functions as F

from lapwise.llm import minhash, pivots
from lapwise.llm.components import components


def shingled(value, size):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in value or "").split()
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def grouped(docs, size):
    """Smallest reachable id by comparing all pairs."""
    sets = [(i, shingled(t, size)) for i, t in docs if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, one) in enumerate(sets):
        for j, other in sets[:n]:
            if one and other and 100 * len(one & other) >= 80 * len(one | other):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in parent}


def near_copies(seed, count, words, edits):
    rng = random.Random(seed)
    base = [f"w{seed}x{i}" for i in range(words)]
    for _ in range(count):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(words)] = f"e{rng.random()}"
        yield " ".join(copy)


def test_groups_equal_brute_force(rows):
    # Copies whose similarities lie on both sides of 0.8, so that components, far members and late links all occur.
    texts = [t for seed in range(6) for t in near_copies(seed, 25, 90, 6)]
    texts += list(near_copies(9, 200, 60, 5))
    texts += ["", None, " ", "one two", "One Two", "one two three", "a b c d", "a b c d"] + ["same text of five words"] * 30
    docs = list(enumerate(texts))
    random.Random(1).shuffle(docs)
    df = rows("doc_id long, text string, component_id string", *[(i, t, "x") for i, t in docs], (None, "a b c d", "x"))
    want = grouped(docs, 4)
    found = minhash.near_duplicates(df, size=4).collect()
    assert len(found) == len(docs) + 1
    for row in found:
        if row["doc_id"] is None:
            assert row["component_id"] is None and row["kept"]
        else:
            assert row["component_id"] == want[row["doc_id"]], row
            assert row["kept"] == (row["component_id"] == row["doc_id"])
            assert row["n_shingles"] == len(shingled(dict(docs)[row["doc_id"]], 4))


def test_no_documents(rows):
    assert minhash.near_duplicates(rows("doc_id long, text string")).count() == 0


def test_repeated_id_is_one_document(rows):
    df = rows("doc_id long, text string", (5, "a b c d e"), (5, "f g h i j"), (7, "f g h i j"), (9, "k l m n o"))
    found = sorted((r["doc_id"], r["component_id"]) for r in minhash.near_duplicates(df).collect())
    assert found == [(5, 5), (5, 5), (7, 5), (9, 9)]


def test_sketch_fills_every_place_and_estimates():
    for n in (1, 2, 7, 600, 20_000):
        items = minhash.mix(np.arange(n, dtype=np.uint64) + np.uint64(5))
        assert not (minhash.sketch(items) == minhash._EMPTY).any()
    one = minhash.mix(np.arange(0, 900, dtype=np.uint64))
    other = minhash.mix(np.arange(100, 1000, dtype=np.uint64))
    agree = (minhash.sketch(one) == minhash.sketch(other)).mean()
    assert abs(agree - 0.8) < 0.08


def test_components_of_chains_and_stars(rows):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(1, i) for i in range(2, 40)] + [(7, 7), (3, 2)]
    found = {r["node"]: r["component"] for r in components(rows("a long, b long", *chain, *star)).collect()}
    assert set(found.values()) == {1, 100}
    assert all(found[i] == (1 if i < 100 else 100) for i in found) and len(found) == 61 + 39


def test_top_k_equals_brute_force(rows, monkeypatch):
    monkeypatch.setattr(pivots, "BLOCK", 40)
    monkeypatch.setattr(pivots, "QUERIES", 4)
    rng = np.random.default_rng(2)
    vectors = rng.normal(0, 0.3, (400, 6))
    vectors[50:200] = vectors[50]  # a third are one vector
    data = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    data += [(500, None), (501, []), (502, [1.0, None, 1, 1, 1, 1]), (503, [float("nan")] * 6), (504, [1.0] * 3)]
    data += [(None, [9.0] * 6)]
    data = [(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in data]
    found = pivots.top_k(rows("vec_id long, embedding array<double>, score int", *[(*d, 0) for d in data]),
                         F.col("id") % 20 == 0)
    whole = np.floor(1024 * vectors).astype(np.int64)
    want = []
    for q in range(0, 400, 20):
        scores = whole @ whole[q]
        order = [c for c in np.lexsort((np.arange(400), -scores)).tolist() if c != q][:10]
        want += [(q, rank, c, int(scores[c])) for rank, c in enumerate(order, 1)]
    assert sorted(tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect()) == want


def test_top_k_of_few_or_none(rows):
    two = rows("vec_id long, embedding array<float>", (0, [1.0, 2.0]), (1, [0.5, 0.5]))
    assert [tuple(r) for r in pivots.top_k(two, F.col("id") == 0).collect()] == [(0, 1, 1, 1024 * 512 + 2048 * 512)]
    assert pivots.top_k(two.limit(0), F.col("id") == 0).count() == 0
