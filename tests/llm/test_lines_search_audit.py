"""Line dedup, ranked search and filter audit against plain versions, with odd input."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from lapwise.llm import filter_audit, lexical, line_dedup

BLANKS = " \t\n\x0b\f\r"


def key_of(line):
    return re.sub("[A-Z]", lambda m: m.group().lower(), line.strip(BLANKS))


def plain_lines(docs, least, keep_first=False):
    """Kept lines per document; ``docs`` are (id, text)."""
    holders = defaultdict(set)
    first = {}
    for row, (i, text) in enumerate(docs):
        for place, line in enumerate((text or "").split("\n")):
            holders[key_of(line)].add(row)
            order = ((i is not None, i or 0), place)
            if key_of(line) not in first or order < first[key_of(line)]:
                first[key_of(line)] = order
    found = []
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [
            line for place, line in enumerate(lines)
            if not key_of(line) or len(holders[key_of(line)]) < least
            or (keep_first and first[key_of(line)] == ((i is not None, i or 0), place))
        ]
        found.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return found


def line_docs():
    rng = random.Random(3)
    common = ["Share this page", " share THIS page\t", "Éclair ÀB", "a", "", "  ", "x" * 5000, "\r", "\x0b|\x0b"]
    docs = [(i, "\n".join(rng.choice(common + [f"line {rng.random()}"]) for _ in range(rng.randrange(1, 9)))) for i in range(60)]
    docs += [(100, None), (101, ""), (None, "Share this page\nown line"), (7, "Share this page"), (7, "Share this page")]
    docs += [(200, "\n".join(["Share this page", "kept"] * 300)), (201, "\n" * 130 + "a"), (202, "éclair Àb\nÉclair Àb")]
    return docs


@pytest.mark.parametrize("least", [1, 2, 10])
def test_lines_of_many_documents_go(rows, least):
    docs = line_docs()
    df = rows("doc_id long, text string, _id int, _key string", *[(*d, 5, "k") for d in docs])
    want = sorted(
        ((i, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in plain_lines(docs, least)), key=str
    )
    cut = line_dedup.without_repeats(df, min_documents=least)
    assert cut.columns == df.columns
    texts = Counter((r["doc_id"], r["text"], r["_id"], r["_key"]) for r in cut.collect())
    assert texts == Counter(
        (i, None if given is None else kept, 5, "k") for (i, _, _, kept), (_, given) in zip(plain_lines(docs, least), docs)
    )
    bitmaps = Counter((r["doc_id"], r["n_lines"], r["n_dropped"]) for r in line_dedup.keep_bitmaps(df, min_documents=least).collect())
    assert bitmaps == Counter((i, n, gone) for i, n, gone, _ in plain_lines(docs, least))
    if least == line_dedup.MIN_DOCUMENTS:
        assert sorted((tuple(r) for r in line_dedup.digest(df).collect()), key=str) == want


def test_first_occurrence_stays(rows):
    docs = [d for d in line_docs() if d[0] != 7]
    found = line_dedup.without_repeats(rows("doc_id long, text string", *docs), min_documents=2, keep_first=True).collect()
    assert {r["doc_id"]: r["text"] or "" for r in found} == {i: kept for i, _, _, kept in plain_lines(docs, 2, True)}


def test_bitmaps_are_sparse(rows):
    docs = [(i, "\n".join(["same" if p in (0, 130) else f"{i}-{p}" for p in range(200)])) for i in range(10)]
    for row in line_dedup.keep_bitmaps(rows("doc_id long, text string", *docs)).collect():
        assert [(w["word"], w["bits"]) for w in row["dropped"]] == [(0, 1), (2, 4)]


def test_no_lines(rows):
    empty = rows("doc_id long, text string")
    assert line_dedup.digest(empty).count() == 0 and line_dedup.keep_bitmaps(empty).count() == 0


def plain_search(docs, items, k):
    fold = lambda t: re.findall(
        "[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
    )
    tokens = [fold(t) for _, t in docs]
    n, length = sum(bool(t) for t in tokens), sum(map(len, tokens))
    df = Counter(term for t in tokens for term in set(t))
    wanted = defaultdict(set)
    for i, text in items:
        wanted[i] |= set(fold(text))
    result = []
    for i, own in wanted.items():
        scored = []
        for (doc, _), found in zip(docs, tokens):
            tf, score = Counter(found), 0
            for term in own & set(found):
                weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1)))
                score += weight * ((1_000_000_000 * tf[term]) // (1000 * tf[term] + 8 * (10 + 90 * len(found) * n // length)))
            if score:
                scored.append((-score, doc is None, doc or 0, doc))
        for rank, (score, _, _, doc) in enumerate(sorted(scored, key=lambda r: r[:3])[:k], 1):
            result.append((i, rank, doc, -score))
    return result


def search_case():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(120)] + ["Été", "naïve", "THE", "the", "x1"]
    share = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rng.choices(words, share, k=rng.randrange(1, 60)))) for i in range(400)]
    docs += [(500, None), (501, ""), (502, "-- !"), (None, "w3 w4 the"), (9, "w3 w4 the"), (9, "w3 w4 the"), (510, "w5," * 9000)]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 15)))) for i in range(30)]
    items += [(40, None), (41, "unknown words"), (42, "w3"), (42, "W4 the"), (None, "naïve été")]
    return docs, items


@pytest.mark.parametrize("block", [16_384, 7])
def test_search_equals_full_scoring(spark, rows, monkeypatch, block):
    monkeypatch.setattr(lexical, "ITEMS", 12)
    monkeypatch.setattr(lexical, "BLOCK_DOCS", block)
    docs, items = search_case()
    df = rows("doc_id long, text string, score int, item_id int", *[(*d, 1, 1) for d in docs]).repartition(3)
    found = lexical.search(df, rows("item_id long, text string, rank int", *[(*i, 1) for i in items])).collect()
    assert sorted(map(tuple, found), key=str) == sorted(plain_search(docs, items, 10), key=str)


def test_skipping_by_pairs_is_exact_and_skips_more():
    rng = np.random.default_rng(4)
    n_docs, n_terms = 600, 12
    held = rng.random((n_terms, n_docs)) < np.linspace(0.9, 0.05, n_terms)[:, None]
    value = rng.integers(1, 1000, (n_terms, n_docs)) * held
    value[1] = np.where(held[0], np.minimum(value[1], 50), value[1])  # these two never have their maxima together
    term, doc = np.nonzero(held)
    index = lexical.Index(term, doc, value[term, doc], n_terms, n_docs)
    units = [tuple(range(i, i + 2)) for i in range(0, n_terms, 2)]
    assert index.bound((0, 1)) < index.most(0) + index.most(1)
    scores = value.sum(0)
    for least in (0, 1, int(np.sort(scores)[-10]), int(scores.max()), int(scores.max()) + 1):
        docs, score = lexical.candidates(index, units, least)
        want = np.flatnonzero(scores >= max(least, 1))
        assert docs.tolist() == want.tolist() and score.tolist() == scores[want].tolist()


def test_search_of_nothing(rows):
    docs, items = rows("doc_id long, text string"), rows("item_id long, text string")
    some = rows("item_id long, text string", (1, "a"))
    assert lexical.search(docs, some).count() == 0 and lexical.search(docs, items).count() == 0
    assert lexical.search(rows("doc_id long, text string", (1, "a")), items).columns == ["item_id", "rank", "doc_id", "score"]


def plain_audit(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    earliest = {}
    for i, text, _ in docs:
        if i is not None:
            earliest[text or ""] = min(i, earliest.get(text or "", i))
    judged = []
    for i, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
            "E": i is not None and i > earliest[text],
        }
        judged.append((lang or "", fails, i in good, i in toxic))
    result = []
    for part in {p for p, *_ in judged}:
        own = [j for j in judged if j[0] == part]
        shapley, found = Counter(), []
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, name in enumerate(order, 1):
                gone = [j for j in left if j[1][name]]
                left = [j for j in left if not j[1][name]]
                shapley[name] += len(gone)
                found.append((
                    part, order, step, len(left), len(gone), sum(j[1][name] for j in own) - len(gone),
                    sum(j[1][name] and sum(j[1].values()) == 1 for j in own), sum(j[2] for j in gone), sum(j[3] for j in gone),
                ))
        result += [(*row, shapley[row[1][row[2] - 1]]) for row in found]
    return result


def test_audit_equals_plain_version(rows):
    rng = random.Random(8)
    docs = []
    for i in range(300):
        words = rng.choices([f"w{j}" for j in range(rng.choice([30, 400]))], k=rng.choice([5, 150, 250, 300]))
        text = " ".join(w.upper() if rng.random() < 0.05 else w for w in words) + rng.choice(["", " #", "é|"])
        docs.append((i, text, rng.choice(["en", "fr", "", None])))
    docs += [(400 + i, docs[3][1], "en") for i in range(40)] + [(2, docs[3][1], "fr"), (2, docs[3][1], "fr")]
    docs += [(None, docs[3][1], "en"), (500, None, None), (501, "", "fr"), (502, "Ab ab " * 100, "en")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 450, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    df = rows("doc_id long, text string, lang string, _mask int, part int", *[(*d, 1, 2) for d in docs]).repartition(3)
    found = filter_audit.report(df, rows("doc_id long, quality int, toxic int", *labels)).collect()
    assert sorted(map(tuple, found)) == sorted(plain_audit(docs, labels))


def test_wide_integers():
    for mask in range(32):
        removed, documents = filter_audit.unpacked(5 * filter_audit.packed(mask))
        assert documents == 5 and removed.sum() == (5 * 120 if mask else 0)
    most = 2**62
    removed, documents = filter_audit.unpacked(most * filter_audit.packed(31))
    assert documents == most and (removed[:, 0] == most).all() and not removed[:, 1:].any()


def test_audit_of_nothing(rows):
    empty, labels = rows("doc_id long, text string, lang string"), rows("doc_id long, quality int, toxic int")
    assert filter_audit.report(empty, labels).count() == 0
    one = filter_audit.report(rows("doc_id long, text string, lang string", (1, None, None)), labels)
    assert one.count() == 600 and {r["part"] for r in one.collect()} == {""}
