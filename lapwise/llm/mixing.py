"""Mixing sources to target weights by iterative proportional fitting, with calibrated sampling.

Token counts are summed per cell (source, language, topic). A mix of ``KEEP`` of all tokens is fitted to the target share of
every source, language and topic in turn: the cells of a value are scaled to its target. A cell cannot give more tokens than
it has: one that would is kept whole, and what it lacks is raked over the value's other cells. So a small cell, or a single
stray document, never shrinks the others; only where a value's documents all together hold too few tokens is its
target missed, and ``marginals`` reports wanted and reached shares. A document is kept with the probability of its cell,
what the mix takes over what the cell has, decided by a hash of its id.

Only the cells are raked, as many as there are combinations; documents are read twice and never sorted. The targets
are the observed shares raised to ``FLATTEN`` unless given.

Rules for odd input: null source or language is a value of its own; a null or empty text has no tokens, weighs
nothing and is kept like its cell; a cell without any tokens is kept with the probability ``KEEP``; repeated rows are kept
or left together; a target for a value that does not occur is left out and the others are scaled up; an empty table gives
an empty result; other columns pass through whatever their names.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapwise.operators.staging import stage

ROUNDS = 12
# Share of all tokens that the mix takes.
KEEP = 0.5
FLATTEN = 0.85
SEED = "mix"
NONE = "(none)"
DIMENSIONS = ("_source", "_lang", "_topic")

Targets = dict[str, dict[str, float]]


def n_tokens(text: str = "text") -> Column:
    """Words of a text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def topic(text: str = "text", tokens: Column | None = None) -> Column:
    """Kind of text: data (a twentieth symbols), note, article or book by length."""
    count = n_tokens(text) if tokens is None else tokens
    symbols = F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))
    return (
        F.when(20 * symbols >= F.greatest(F.length(text), F.lit(1)), "data")
        .when(count < 100, "note")
        .when(count < 800, "article")
        .otherwise("book")
    )


def _labelled(df: DataFrame) -> DataFrame:
    """The documents as one column ``_doc``, so that their names clash with nothing, and their cells."""
    return df.select(
        F.struct(*[F.col(f"`{name}`") for name in df.columns]).alias("_doc"),
        F.coalesce(F.col("source").cast("string"), F.lit(NONE)).alias("_source"),
        F.coalesce(F.col("lang").cast("string"), F.lit(NONE)).alias("_lang"),
        n_tokens().alias("_tokens"),
    ).withColumn("_topic", topic("_doc.text", F.col("_tokens")))


def _with_targets(cells: DataFrame, given: Targets) -> DataFrame:
    """Add the target share of each cell's value in every dimension."""
    for name in DIMENSIONS:
        found = cells.groupBy(name).agg(F.sum("_sum").cast("double").alias("_n"))
        if name in given:
            share = F.element_at(F.from_json(F.lit(json.dumps(given[name])), "map<string,double>"), F.col(name))
            found = found.withColumn("_share", F.coalesce(share, F.lit(0.0)))
        else:
            found = found.withColumn("_share", F.pow("_n", F.lit(FLATTEN)))
        whole = found.agg(F.sum("_share")).first()[0] or 1.0
        cells = cells.join(found.select(name, (F.col("_share") / F.lit(whole)).alias(f"{name}_target")), name)
    return cells


def rake(cells: DataFrame, given: Targets | None = None, rounds: int = ROUNDS, keep: float = KEEP) -> DataFrame:
    """Cells with the tokens ``_weight`` that the mix takes of them, at most ``_sum``, and their ``_probability``.

    ``keep`` is the share of all tokens that is taken.
    """
    found = stage(_with_targets(cells.filter("_sum > 0"), given or {}))
    whole = float(found.agg(F.sum("_sum")).first()[0] or 0)
    found = found.withColumn("_weight", F.col("_sum") * F.lit(keep))
    full = F.col("_weight") >= F.col("_sum")
    for number in range(1, rounds + 1):
        for name in DIMENSIONS:
            value = Window.partitionBy(name)
            goal = F.col(f"{name}_target") * F.lit(keep * whole)
            total = F.sum("_weight").over(value)
            fixed = F.sum(F.when(full, F.col("_weight")).otherwise(F.lit(0.0))).over(value)
            free = F.sum(F.when(full, F.lit(0.0)).otherwise(F.col("_weight"))).over(value)
            grown = F.least(F.col("_sum").cast("double"), F.col("_weight") * (goal - fixed) / free)
            fitted = (
                F.when(total >= goal, F.when(total > 0, F.col("_weight") * goal / total).otherwise(F.lit(0.0)))
                .when(~full & (free > 0), grown)
                .otherwise(F.col("_weight"))
            )
            found = found.withColumn("_weight", fitted)
        if number % 3 == 0 and number < rounds:  # keeps plans short; cells only
            found = stage(found)
    return stage(found).withColumn("_probability", F.col("_weight") / F.col("_sum"))


def marginals(raked: DataFrame) -> DataFrame:
    """Per dimension and value the wanted and the reached share of the mix."""
    total = raked.agg(F.sum("_weight")).first()[0] or 1.0
    sides = F.array(*[
        F.struct(F.lit(name[1:]).alias("dimension"), F.col(name).alias("value"), F.col(f"{name}_target").alias("wanted"))
        for name in DIMENSIONS
    ])
    return (
        raked.select(F.explode(sides).alias("side"), "_weight").select("side.*", "_weight")
        .groupBy("dimension", "value").agg(F.max("wanted").alias("wanted"), (F.sum("_weight") / total).alias("reached"))
    )


def _mixed(df: DataFrame, given: Targets | None, key: str) -> DataFrame:
    rows = _labelled(df)
    cells = stage(rows.groupBy(*DIMENSIONS).agg(F.sum("_tokens").alias("_sum")))
    raked = stage(rake(cells, given).select(*DIMENSIONS, "_weight", "_probability"))
    total = raked.agg(F.sum("_weight")).first()[0] or 1.0
    name = F.concat_ws("#", F.lit(SEED), F.coalesce(F.col(f"_doc.{key}").cast("string"), F.lit("")))
    chance = F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("double") / float(1 << 52)
    return (
        rows.join(raked, list(DIMENSIONS), "left")
        .withColumn("_weight", F.coalesce(F.col("_weight") / F.lit(total), F.lit(0.0)))
        .withColumn("_probability", F.coalesce("_probability", F.lit(KEEP)))
        .withColumn("_kept", chance < F.col("_probability"))
    )


def weigh(df: DataFrame, given: Targets | None = None, key: str = "doc_id") -> DataFrame:
    """One row per row of ``df``: its cell, tokens, the cell's share of the mix, probability and verdict."""
    return _mixed(df, given, key).select(
        F.col(f"_doc.{key}"), F.col("_source").alias("source"), F.col("_lang").alias("lang"), F.col("_topic").alias("topic"),
        F.col("_tokens").alias("n_tokens"), F.round("_weight", 9).alias("cell_weight"),
        F.round("_probability", 9).alias("probability"), F.col("_kept").alias("kept"),
    )


def sample(df: DataFrame, given: Targets | None = None, key: str = "doc_id") -> DataFrame:
    """The rows of ``df`` that the mix keeps, with all their columns."""
    return _mixed(df, given, key).filter("_kept").select("_doc.*")
