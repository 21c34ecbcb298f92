"""The pipeline stage by stage against plain versions, and the registry with and without the text part."""

import random

import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from lapwise.llm import mixing, toxicity
from lapwise.operators.staging import stage
from test_groups import grouped
from test_models import toxic_docs
from test_text_rules import plain


def folder(spark, base):
    rng = random.Random(11)
    docs = [(i, t, rng.choice(["en", "fr", None]), f"s{i % 4}", len(t)) for i, t, _ in toxic_docs(240)]
    docs += [(500 + i, docs[i][1], "en", "s0", 0) for i in range(30)]  # copies
    docs += [(600 + i, docs[i][1] + " end", "en", "s1", 0) for i in range(40, 60)]  # near copies
    docs += [(700, "again and again it goes " * 20, "en", "s1", 0), (701, None, "en", None, 0), (702, "", "en", "s2", 0)]
    docs += [(703, "short text", "en", "s2", 0), (None, " ".join(f"u{i}" for i in range(30)), "en", "s3", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, schema).write.parquet(f"{base}/documents.parquet")
    labels = [(i, 1, y) for i, _, y in toxic_docs(240)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    return base


def test_stages_equal_plain_versions(spark, tmp_path):
    base = folder(spark, str(tmp_path))
    docs = spark.read.parquet(f"{base}/documents.parquet")
    labels = spark.read.parquet(f"{base}/labels.parquet")
    results = []
    for name, function in corpus_pipeline.STAGES:
        results.append((name, docs.collect()))
        docs = stage(function(spark, docs, base))
    packed = docs.collect()
    (_, first), (_, clean), (_, good), (_, unique), (_, mixed) = results

    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(list(rows[0].asDict()) == columns for _, rows in results)
    given = spark.createDataFrame(first, "doc_id long, text string, lang string, source string, n_chars long")
    scores = toxicity.score(given, toxicity.train(given, labels)).collect()
    assert sorted(str(r["doc_id"]) for r in clean) == sorted(str(r["doc_id"]) for r in scores if r["score"] < 0.5)
    assert len(clean) < len(first)

    def keeps(text):
        words, _, _, _, repeated, longest = plain(text)
        return words >= 10 and 100 * repeated <= 20 * words and longest <= 100

    assert sorted(map(str, good)) == sorted(str(r) for r in clean if keeps(r["text"]))
    groups = grouped([(r["doc_id"], r["text"]) for r in good], 5)
    assert sorted(map(str, unique)) == sorted(
        str(r) for r in good if r["doc_id"] is None or groups[r["doc_id"]] == r["doc_id"]
    )
    assert len(unique) < len(good)
    left = spark.createDataFrame(unique, "doc_id long, text string, lang string, source string, n_chars long")
    chosen = {str(r["doc_id"]) for r in mixing.weigh(left).collect() if r["kept"]}
    assert {str(r["doc_id"]) for r in mixed} == chosen and 0 < len(mixed) < len(unique)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sum(len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1 for r in mixed)
    assert sum(r["length"] for r in packed) == want
    assert {str(r["doc_id"]) for r in packed} == chosen


def test_repeated_ids_leave_one_row(spark, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    text = " ".join(f"w{i}" for i in range(20))
    docs = rows(schema, *[(1, text, "en", "s", 1)] * 3, (2, text + " x", "en", "s", 1), (3, "other words here", "en", "s", 1))
    found = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    assert sorted(r["doc_id"] for r in found) == [1, 3]


def test_unlike_rows_of_one_id_stay(spark, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    a, b, c = (" ".join(f"{name}{i}" for i in range(20)) for name in "abc")
    docs = rows(schema, (1, a, "en", "s", 1), (1, b, "en", "s", 1), (2, a, "en", "s", 1), (2, c, "en", "s", 1))
    found = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    assert sorted((r["doc_id"], r["text"]) for r in found) == [(1, a), (1, b), (2, c)]
    docs = rows(schema, (None, a, "en", "s", 1), (None, a + " x", "en", "s", 1), (None, "", "en", "s", 1), (None, None, "", "s", 1))
    found = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    assert sorted(str(r["text"])[:2] for r in found) == ["", "No", "a0"]


def test_pipeline_of_nothing(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))
    assert {"op2_pivot_table", "op9_raked_mixture"} <= __spark_entry__.oracle_sql().keys()
