"""Trained operators: held-out accuracy, calibration and odd input."""

import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lapwise.llm import langid, licenses, pseudo_likelihood, text, toxicity

ODD = [(901, None), (902, ""), (903, " \n"), (None, "plain words"), (904, "x " * 3000), (904, "x " * 3000)]


def toxic_docs(count=400):
    rng = random.Random(4)
    for i in range(count):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randint(5, 80))]
        label = int(rng.random() < 0.3)
        if label:
            words[rng.randrange(len(words))] = rng.choice(["vile,", "Rotten", "foul."])
        yield i, " ".join(words), label


def test_toxicity_on_held_out_rows(rows):
    data = list(toxic_docs())
    docs = rows("doc_id long, text string, score string", *[(i, t, "s") for i, t, _ in data], *[(*d, "s") for d in ODD])
    labels = rows("doc_id long, quality int, toxic int", *[(i, 1, y) for i, _, y in data], (None, 1, 1), (3, None, None))
    model = toxicity.train(docs, labels)
    found = toxicity.score(docs, model).collect()
    assert len(found) == len(data) + len(ODD)
    label = {i: y for i, _, y in data}
    held = [r for r in found if r["held_out"] and r["doc_id"] in label]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found if r["doc_id"] is not None)
    assert len(held) > 40 and np.mean([r["predicted"] == label[r["doc_id"]] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in found)
    assert len(model.places) < 5000
    kept = {r["doc_id"] for r in toxicity.keep(docs, model).collect()}
    assert kept == {r["doc_id"] for r in found if not r["predicted"]}


def test_toxicity_without_labels(rows):
    docs = rows("doc_id long, text string", (1, "a b"), (2, None))
    found = toxicity.score(docs, toxicity.train(docs, rows("doc_id long, quality int, toxic int"))).collect()
    assert [round(r["score"], 6) for r in found] == [round(1 / 3, 6)] * 2
    assert toxicity.score(docs.limit(0), toxicity.train(docs, rows("doc_id long, toxic int"))).count() == 0


def languages(count=400):
    rng = random.Random(6)
    stems = {"aa": "bal kor min tes dov", "bb": "chü fez gra hul jöp", "cc": "ñar quo rív sta tué"}
    for i in range(count):
        lang = rng.choice(sorted(stems))
        parts = stems[lang].split()
        words = ["".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(rng.randint(4, 60))]
        yield i, " ".join(words), lang


def test_languages_of_held_out_rows(rows):
    data = list(languages())
    odd = [(1001, None, "aa"), (1002, "123 456 !", "aa"), (1003, "中", "bb"), (1004, "bal kor", None), (None, "bal kor", "aa")]
    docs = rows("doc_id long, text string, lang string, score int", *[(*d, 0) for d in data + odd])
    found = {r["doc_id"]: r for r in langid.identify(docs, langid.train(docs)).collect()}
    lang = {i: name for i, _, name in data}
    held = [r for i, r in found.items() if r["held_out"] and i in lang]
    assert len(held) > 50 and all(r["lang_pred"] == lang[r["doc_id"]] for r in held)
    assert found[1001]["lang_pred"] == found[1002]["lang_pred"] == "und" and found[1002]["score"] == 0
    assert found[1003]["lang_pred"] in {"aa", "bb", "cc"} and found[1003]["score"] == 0
    assert found[None]["lang_pred"] == "aa" and not found[None]["held_out"]


def test_no_language_learned(rows):
    docs = rows("doc_id long, text string, lang string", (1, "some words", None))
    assert [r["lang_pred"] for r in langid.identify(docs, langid.train(docs)).collect()] == ["und"]


def test_languages_of_two_documents_are_learned(rows):
    rng = random.Random(12)
    words = {
        "en": "the of and with from this that which their there would about people water under never house".split(),
        "de": "der die und mit von dieser nicht welche durch immer zwischen haus wasser leute unter schon".split(),
    }
    ids = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 4 != 2]
    text = lambda lang: " ".join(rng.choices(words[lang], k=80))
    docs = [(ids[n], text("en"), "en") for n in range(59)] + [(ids[59 + n], text("de"), "de") for n in range(2)]
    new = [(5000 + n, text(lang), None) for n, lang in enumerate(["de", "en"] * 10)]
    model = langid.train(rows("doc_id long, text string, lang string", *docs))
    found = {r["doc_id"]: r["lang_pred"] for r in langid.identify(rows("doc_id long, text string, lang string", *docs, *new), model).collect()}
    assert [found[i] for i, _, _ in new] == ["de", "en"] * 10
    assert sum(found[i] == lang for i, _, lang in docs) == 61


def test_filters_of_many_languages():
    rng = np.random.default_rng(3)
    codes = [np.unique(rng.integers(0, 2**32, 500, dtype=np.uint32)) for _ in range(70)]
    filters = langid.Filters.build([f"l{i:02}" for i in range(70)], "l00", codes)
    for number, own in enumerate(codes):
        word, bit = divmod(number, 64)
        assert ((filters.containing(own)[word] >> np.uint64(bit)) & np.uint64(1)).all()
    other = rng.integers(0, 2**32, 100_000, dtype=np.uint32)
    hits = ((filters.containing(other)[1] >> np.uint64(5)) & np.uint64(1)).mean()
    assert abs(hits - filters.false_rate[69]) < 0.002


def test_licences(rows):
    rng = random.Random(8)
    prose = lambda n: " ".join(rng.choices(["the", "of", "work", "is", "free", "version", "under", "a", "licensed"], k=n))
    data = [(i, "\n".join(prose(12) for _ in range(4))) for i in range(200)]
    notices = [
        "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.",
        "This work is licensed under the GNU General Public License, version 3", "licensed under CC BY-NC 4.0",
    ]
    named = ["apache", "mit", "gpl", "creative-commons"]
    data += [(300 + i, f"{prose(10)}\n\n{notices[i % 4]}\n{prose(9)}") for i in range(20)]
    data += [(400, None), (401, ""), (None, notices[0]), (402, f"{notices[1]}\n{notices[0]}")]
    docs = rows("doc_id long, text string, license string", *[(*d, "x") for d in data])
    found = {r["doc_id"]: r for r in licenses.scan(docs, licenses.train(docs)).collect()}
    assert len(found) == len(data)
    for i in range(20):
        assert found[300 + i]["license"] == named[i % 4] and found[300 + i]["paragraph"] == 2
    assert all(found[i]["license"] == "none" and found[i]["n_licenses"] == 0 for i in [*range(200), 400, 401])
    assert found[None]["license"] == "apache" and found[402]["license"] == "mit" and found[402]["n_licenses"] == 2
    assert licenses.scan(docs.limit(0), licenses.train(docs)).count() == 0


def test_licence_titles_and_families(rows):
    """Short lines and further families are found, each as its own."""
    rng = random.Random(9)
    prose = lambda n: " ".join(rng.choices(["the", "of", "work", "is", "free", "version", "under", "a", "licensed"], k=n))
    lines = {
        "MIT License": "mit", "License: MIT": "mit", "ISC License": "isc", "BSD 3-Clause License": "bsd",
        "GNU Lesser General Public License": "lgpl", "GNU Affero General Public License": "agpl",
        "GNU General Public License": "gpl", "Apache License": "apache", "The Unlicense": "unlicense",
        "CC0 1.0 Universal": "cc0", "zlib License": "zlib", "Eclipse Public License": "epl", "Boost Software License": "boost",
        "This work is licensed under the GNU Lesser General Public License, version 3": "lgpl",
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED": "mit",
        "the license": "none", "public": "none", "under the": "none", "software is": "none",
    }
    data = [(i, f"{prose(12)}\n{line}\n{prose(9)}") for i, line in enumerate(lines)]
    data += [(100 + i, "\n".join(prose(12) for _ in range(4))) for i in range(300)]
    docs = rows("doc_id long, text string", *data)
    found = {r["doc_id"]: r["license"] for r in licenses.scan(docs, licenses.train(docs)).collect()}
    assert {line: found[i] for i, line in enumerate(lines)} == lines
    assert all(found[100 + i] == "none" for i in range(300))


def test_pseudo_likelihood_prefers_natural_order(rows):
    rng = random.Random(2)
    follow = {f"v{i}": [f"v{(3 * i + k) % 40}" for k in (1, 2)] for i in range(40)}

    def sentence(n):
        words = [f"v{rng.randrange(40)}"]
        while len(words) < n:
            words.append(rng.choice(follow[words[-1]]))
        return words

    plain = [sentence(60) for _ in range(400)]
    mixed = [rng.sample(s, len(s)) for s in plain[:60]]
    data = [(i, " ".join(s)) for i, s in enumerate(plain)] + [(1000 + i, " ".join(s)) for i, s in enumerate(mixed)]
    docs = rows("doc_id long, text string, n_words string", *[(*d, "x") for d in data + ODD])
    model = pseudo_likelihood.train(docs, rounds=20)  # a small table, learned from five times
    found = {r["doc_id"]: r for r in pseudo_likelihood.score(docs, model).collect()}
    better = [found[i]["mean_log_likelihood"] > found[1000 + i]["mean_log_likelihood"] for i in range(60)]
    assert np.mean(better) > 0.95
    assert found[901]["n_words"] == 0 and found[901]["pseudo_log_likelihood"] == 0
    assert found[902]["mean_log_likelihood"] is None
    # Every word's probabilities over all entries sum to one for any context.
    ids = np.arange(len(model.vocabulary))
    context = np.tile(ids[:4], (len(ids), 1))
    total = np.exp(model.log_probabilities(context, ids)).sum()
    rare = np.exp(model.log_probabilities(context[:1], np.array([len(ids)])))[0] / np.exp(model.log_share[-1])
    assert abs(total + rare - 1) < 0.01 or total <= 1


def test_pseudo_likelihood_counts(rows):
    docs = rows("doc_id long, text string", (1, "A b a"), (2, "b c"), (3, None))
    counted = {r["word"]: r["n"] for r in pseudo_likelihood.word_counts(docs).collect()}
    batch = pa.RecordBatch.from_arrays([pa.array(["a b c"])], ["text"])
    (_, part), = text.slices(batch, "text")
    names = part.hashes(*part.words(), fold=True).view(np.int64).tolist()
    assert [counted[name] for name in names] == [2, 2, 1]
    empty = docs.limit(0)
    assert pseudo_likelihood.score(empty, pseudo_likelihood.train(empty)).count() == 0


def test_pseudo_likelihood_counts_every_word(rows, monkeypatch):
    """Words beyond the vocabulary and the head keep their own share, and all words' chances sum to one."""
    monkeypatch.setattr(pseudo_likelihood, "VOCABULARY", 60)
    data = [(i, " ".join(f"v{j}" for j in range(60))) for i in range(40)]
    data += [(200 + i, " ".join(f"r{j} r{j}" for j in range(i, 12))) for i in range(9)]
    data += [(301, "v1 r0 v2"), (302, "v1 r11 v2"), (302, "v1 r11 v2"), (303, "v1 once v2")]
    docs = rows("doc_id long, text string", *data)
    found = {}
    for head in (60, 66, 100_000):
        monkeypatch.setattr(pseudo_likelihood, "HEAD", head)
        model = pseudo_likelihood.train(docs)
        scored = pseudo_likelihood.score(docs, model).collect()
        assert len(scored) == len(data)
        found[head] = sorted((r["doc_id"], r["n_words"], round(r["pseudo_log_likelihood"], 6)) for r in scored)
    assert found[60] == found[66] == found[100_000]
    by_id = {i: value for i, _, value in found[60]}
    assert len({by_id[301], by_id[302], by_id[303]}) == 3  # three rare words in one place
    counted = {r["word"]: r["n"] for r in pseudo_likelihood.word_counts(docs).collect()}
    words = np.array(sorted(counted))
    at, inside = pseudo_likelihood.lookup(model.vocabulary, words)
    ids = np.where(inside, model.order[at], len(model.vocabulary) + words % pseudo_likelihood.BUCKETS)
    chance = np.exp(model.log_probabilities(np.tile([[3, 1, 2, 0]], (len(ids), 1)), ids))
    assert abs((chance * np.where(inside, 1, [counted[w] for w in words.tolist()])).sum() - 1) < 1e-4


def small_network(entries=11, classes=5):
    rng = np.random.default_rng(6)
    return pseudo_likelihood.Network(
        rng.normal(0, 0.5, (4, entries, pseudo_likelihood.HIDDEN)), rng.normal(0, 0.5, (classes, pseudo_likelihood.HIDDEN))
    )


def test_network_slopes_are_the_loss_gradient():
    net, rng = small_network(), np.random.default_rng(7)
    context, own = rng.integers(0, 11, (9, 4)), rng.integers(0, 5, 9)

    def loss(net):
        return -np.log(net.chances(net.hidden(context))[own, np.arange(9)]).sum()

    inner, outer = net.slopes(context, own)
    tables = np.zeros_like(net.tables)
    for i in range(4):
        np.add.at(tables[i], context[:, i], inner)
    for weights, slopes in ((net.tables, tables), (net.output, outer)):
        for at in zip(*[rng.integers(0, n, 40) for n in weights.shape]):
            kept = weights[at]
            weights[at] = kept + 1e-5
            above = loss(net)
            weights[at] = kept - 1e-5
            slope = (above - loss(net)) / 2e-5
            weights[at] = kept
            assert abs(slope - slopes[at]) < 1e-4


def test_network_learns_by_adagrad():
    """One step over repeated entries equals plain sums; use is counted; untouched vectors do not move."""
    net, rng = small_network(), np.random.default_rng(8)
    context, own = rng.integers(0, 6, (50, 4)), rng.integers(0, 5, 50)
    learner = pseudo_likelihood.Learner(net)
    inner, outer = net.slopes(context, own)
    learner.learn(context, own)
    want = net.tables.copy()
    for i in range(4):
        slope = np.zeros_like(want[i])
        np.add.at(slope, context[:, i], inner)
        want[i] -= pseudo_likelihood.RATE * slope / np.sqrt(pseudo_likelihood.DAMPING + slope**2)
        assert learner.used[i].tolist() == np.bincount(context[:, i], minlength=11).tolist()
    assert np.allclose(learner.net.tables, want) and not np.allclose(learner.net.output, net.output)
    rows, weight, moved = learner.moves()
    assert set(rows.tolist()) == {i * 11 + e for i in range(4) for e in range(6)} | {44 + c for c in range(5)}
    assert weight[-5:].tolist() == [50] * 5 and moved.shape == (len(rows), pseudo_likelihood.HIDDEN)


def test_round_averages_the_moves_of_all_tasks(rows):
    """A round over several tasks equals the mean of their moves, weighted by use."""
    data = [(i, " ".join(f"v{(i * j) % 17}" for j in range(1, 30 + i))) for i in range(60)] + [(99, None), (98, "")]
    docs = rows("doc_id long, text string", *data).repartition(3, "doc_id")
    model = pseudo_likelihood.train(docs, rounds=0)
    net, outside = model.net, pseudo_likelihood.edge(model.vocabulary)
    after = pseudo_likelihood.trained(docs, "text", model.vocabulary, model.order, model.word_class, net)
    used, moved = np.zeros(net.tables.shape[:2]), np.zeros(net.tables.shape)
    for task in docs.rdd.glom().collect():
        learner, rng = pseudo_likelihood.Learner(net), np.random.default_rng(1)
        batch = pa.RecordBatch.from_arrays([pa.array([r["text"] for r in task], pa.string())], ["text"])
        for _, part in text.slices(batch, "text"):
            ids, n, _ = pseudo_likelihood.word_ids(part, model.vocabulary, model.order)
            around, own = pseudo_likelihood.contexts(ids, n, outside), model.word_class[ids]
            mixed = rng.permutation(len(ids))
            for low in range(0, len(ids), pseudo_likelihood.MINIBATCH):
                some = mixed[low : low + pseudo_likelihood.MINIBATCH]
                learner.learn(around[some], own[some])
        used += learner.used
        moved += (learner.net.tables - net.tables) * learner.used[:, :, None]
    want = net.tables + moved / np.maximum(used, 1)[:, :, None]
    assert used.sum() == 4 * sum(len((t or "").split()) for _, t in data)
    assert np.allclose(after.tables, want, atol=1e-5)
    assert (after.tables == net.tables)[used == 0].all()


def test_network_predicts_held_out_documents_better_than_shares(rows):
    rng = random.Random(3)

    def sentence():
        words = [rng.randrange(40)]
        while len(words) < 60:
            words.append((3 * words[-1] + rng.choice((1, 2))) % 40)
        return " ".join(f"v{w}" for w in words)

    docs = rows("doc_id long, text string", *[(i, sentence()) for i in range(400)])
    held = rows("doc_id long, text string", *[(i, sentence()) for i in range(50)])

    def mean(model):
        found = pseudo_likelihood.score(held, model).collect()
        return sum(r["pseudo_log_likelihood"] for r in found) / sum(r["n_words"] for r in found)

    trained = pseudo_likelihood.train(docs, rounds=20)
    assert mean(trained) > mean(pseudo_likelihood.train(docs, rounds=0)) + 1.0


def test_vocabulary_grows_with_the_words():
    sizes = [pseudo_likelihood.vocabulary_size(n) for n in (0, 100, 250_000, 1_000_000, 10**8)]
    assert sizes == [4_096, 4_096, 4_096, 8_192, 65_536]


def test_licence_classes_and_thresholds_come_from_all_paragraphs(spark):
    """Finding F8: about 8,000 sampled paragraphs stood for all of them."""
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("the work goes on\nred leaf "), F.col("id").cast("string"), F.lit("\n\nMIT License\nthis software was ever so new"))
        .alias("text"),
    )
    counted = licenses._unknown(docs, "doc_id", "text", ["", "the", "work", "software", "this", "this software"]).collect()
    halves = {side: sum(r["n"] for r in counted if r["calibrates"] == side) for side in (False, True)}
    assert sum(halves.values()) == 9000 and min(halves.values()) > 4200
    assert {tuple(r["features"]) for r in counted} == {("", "the", "work"), ("",), ("", "software", "this", "this software")}
    scored = spark.createDataFrame([(0.9, 2), (0.8, 5), (0.6, 1), (0.5, 900)], "probability DOUBLE, n LONG")
    got = [licenses.least_probability(scored, passing) for passing in (0, 1, 2, 6, 7, 8)]
    assert got == [0.9, 0.9, 0.8, 0.8, 0.6, None]
