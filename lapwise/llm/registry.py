"""Queries of this subpackage over the given tables, and the SQL they are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapwise.llm import (
    filter_audit, langid, lexical, licenses, line_dedup, minhash, mixing, packing, pivots, pseudo_likelihood, repetition,
    sharding, toxicity,
)
from lapwise.llm.shipping import ship


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_suffix_repetition(spark: SparkSession, folder: str) -> DataFrame:
    return repetition.score(_table(spark, folder, "documents"))


def op2_pivot_table(spark: SparkSession, folder: str) -> DataFrame:
    return pivots.top_k(_table(spark, folder, "embeddings"), F.col("id") % 100 == 0)


def op3_fast_similarity_sketch(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, folder, "documents"), size=4)


def op10_dominance_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"))


def op4_ftrl_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.train(docs, _table(spark, folder, "labels")))


def op5_license_paragraphs(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return licenses.scan(docs, licenses.train(docs))


def op6_masked_pseudo_likelihood(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return pseudo_likelihood.score(docs, pseudo_likelihood.train(docs))


def op7_bitmask_filters(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return langid.identify(docs, langid.train(docs))


def op8_bounded_ring(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign(_table(spark, folder, "documents"))


def op9_raked_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.weigh(_table(spark, folder, "documents"))


def op11_line_bitmaps(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.digest(_table(spark, folder, "documents"))


def op12_pair_maxscore(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op13_packed_counters(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.report(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def _op9_sql() -> str:
    """The same raking as a chain of window sums."""
    steps = [f"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '{mixing.NONE}') AS source, coalesce(lang, '{mixing.NONE}') AS lang, text,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS n_tokens
  FROM documents
), rows_ AS (
  SELECT doc_id, source, lang, n_tokens,
    CASE WHEN 20 * (length(text) - length(translate(text, '#*$%&|<>', ''))) >= greatest(length(text), 1) THEN 'data'
      WHEN n_tokens < 100 THEN 'note' WHEN n_tokens < 800 THEN 'article' ELSE 'book' END AS topic
  FROM docs
), cells AS (
  SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS n FROM rows_ GROUP BY ALL HAVING sum(n_tokens) > 0
)"""]
    for name in ("source", "lang", "topic"):
        steps.append(f"""t_{name} AS (
  SELECT {name}, pow(sum(n), {mixing.FLATTEN}) / sum(pow(sum(n), {mixing.FLATTEN})) OVER () AS goal
  FROM cells GROUP BY {name}
)""")
    last, value = "cells", f"n * {mixing.KEEP}"
    for number in range(mixing.ROUNDS):
        for name in ("source", "lang", "topic"):
            here = f"w{number}_{name}"
            steps.append(f"""{here} AS (
  SELECT source, lang, topic, n, CASE WHEN total >= wanted THEN w * wanted / total
    WHEN w < n AND free > 0 THEN least(n, w * (wanted - fixed) / free) ELSE w END AS w
  FROM (
    SELECT c.*, goal * {mixing.KEEP} * whole AS wanted, sum(w) OVER here AS total,
      sum(CASE WHEN w >= n THEN w ELSE 0 END) OVER here AS fixed, sum(CASE WHEN w >= n THEN 0 ELSE w END) OVER here AS free
    FROM (SELECT source, lang, topic, n, {value} AS w FROM {last}) c JOIN t_{name} t ON c.{name} = t.{name},
      (SELECT sum(n) AS whole FROM cells)
    WINDOW here AS (PARTITION BY c.{name})
  )
)""")
            last, value = here, "w"
    return ",\n".join(steps) + f"""
SELECT r.doc_id, r.source, r.lang, r.topic, r.n_tokens, round(coalesce(share, 0), 9) AS cell_weight,
  round(coalesce(p, {mixing.KEEP}), 9) AS probability,
  ('0x' || substr(md5('{mixing.SEED}#' || coalesce(r.doc_id::VARCHAR, '')), 1, 13))::BIGINT / pow(2, 52)
    < coalesce(p, {mixing.KEEP}) AS kept
FROM rows_ r LEFT JOIN (SELECT *, w / n AS p, w / sum(w) OVER () AS share FROM {last}) f
  ON r.source = f.source AND r.lang = f.lang AND r.topic = f.topic"""


QUERIES = {
    "op1_suffix_repetition": op1_suffix_repetition,
    "op2_pivot_table": op2_pivot_table,
    "op3_fast_similarity_sketch": op3_fast_similarity_sketch,
    "op4_ftrl_toxicity": op4_ftrl_toxicity,
    "op5_license_paragraphs": op5_license_paragraphs,
    "op6_masked_pseudo_likelihood": op6_masked_pseudo_likelihood,
    "op7_bitmask_filters": op7_bitmask_filters,
    "op8_bounded_ring": op8_bounded_ring,
    "op9_raked_mixture": op9_raked_mixture,
    "op10_dominance_packing": op10_dominance_packing,
    "op11_line_bitmaps": op11_line_bitmaps,
    "op12_pair_maxscore": op12_pair_maxscore,
    "op13_packed_counters": op13_packed_counters,
}

SQL: dict[str, str] = {
    "op2_pivot_table": f"""
WITH v AS (
  SELECT vec_id, [floor({pivots.SCALE} * x::DOUBLE) for x in embedding] AS vec FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.vec, c.vec)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
  vec_id, score
FROM s QUALIFY rank <= 10""",
    "op9_raked_mixture": _op9_sql(),
    "op11_line_bitmaps": r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), rows_ AS (
  SELECT r, unnest(range(len(lines))) AS place, unnest(lines) AS line FROM docs
), keyed AS (
  SELECT r, place, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM rows_
), frequent AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10
), told AS (
  SELECT k.*, f.key IS NOT NULL AS gone FROM keyed k LEFT JOIN frequent f ON k.key = f.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM told JOIN docs USING (r) GROUP BY r, doc_id""",
    "op12_pair_maxscore": r"""
WITH tokens AS (
  SELECT r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)
), lengths AS (
  SELECT r, doc_id, count(*) AS n FROM tokens GROUP BY ALL
), whole AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS length FROM lengths
), counted AS (
  SELECT r, term, count(*) AS tf FROM tokens GROUP BY ALL
), wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), weighed AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM counted, whole GROUP BY term, docs
), scored AS (
  SELECT item_id, doc_id, r,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // length))))::BIGINT AS score
  FROM wanted JOIN weighed USING (term) JOIN counted USING (term) JOIN lengths USING (r), whole GROUP BY ALL
)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10""",
    "op13_packed_counters": r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
), counted AS (
  SELECT doc_id, part, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS upper,
    min(doc_id) OVER (PARTITION BY text) AS earliest
  FROM texts
), marks AS (
  SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), judged AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    {'A': len(words) < 200, 'B': 100 * len(list_distinct(words)) < 50 * len(words), 'C': 100 * upper > 3 * length(text),
      'D': regexp_matches(text, '[#$%&*|]'), 'E': coalesce(doc_id > earliest, false)} AS fails
  FROM counted LEFT JOIN marks USING (doc_id)
), masks AS (
  SELECT part, good, toxic, [x for x in ['A', 'B', 'C', 'D', 'E'] if CASE x WHEN 'A' THEN fails.A WHEN 'B' THEN fails.B
    WHEN 'C' THEN fails.C WHEN 'D' THEN fails.D ELSE fails.E END] AS failed, count(*) AS n
  FROM judged GROUP BY ALL
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x)
    JOIN letters d ON d.x NOT IN (a.x, b.x, c.x) JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)
), steps AS (
  SELECT filter_order, step, filter_order[step] AS x FROM orders, (SELECT unnest(range(1, 6)) AS step)
), met AS (
  SELECT part, good, toxic, n, filter_order, step, x, list_contains(failed, x) AS bad, failed = [x] AS only_bad,
    coalesce(list_min([instr(filter_order, y) for y in failed]), 9) AS leaves
  FROM masks, steps
), sums AS (
  SELECT part, filter_order, step, x, coalesce(sum(n) FILTER (leaves > step), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (leaves = step), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (bad AND leaves < step), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (only_bad), 0)::BIGINT AS unique_fails,
    coalesce(sum(n) FILTER (leaves = step AND good), 0)::BIGINT AS good_lost,
    coalesce(sum(n) FILTER (leaves = step AND toxic), 0)::BIGINT AS toxic_lost
  FROM met GROUP BY ALL
)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley
FROM sums""",
}
