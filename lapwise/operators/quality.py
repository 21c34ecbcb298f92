"""Data quality as set operations: check specifications in, one row per check out.

All checks of a table but those of its schema read it once. Null, range, freshness and row-count checks are one global
aggregation. With duplicate checks every row is expanded to one row per set of key columns, as GROUPING SETS do, plus one
that carries the measures; one shuffle counts all sets together. Nothing is collected; the result is a DataFrame.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class CheckSpec:
    """``threshold`` is a percentage for null, duplicate and range checks, hours for freshness, rows for counts."""

    name: str
    kind: str
    columns: list[str] = field(default_factory=list)
    condition: str | None = None
    threshold: float | None = None
    expected: T.StructType | None = None


RESULT_SCHEMA = (
    "check_name STRING, check_type STRING, column STRING, status STRING, total_rows BIGINT, bad_rows BIGINT, "
    "bad_pct DOUBLE, message STRING"
)

STALE_HOURS = 24
ONE_PASS = ("null_check", "range_check", "freshness_check", "row_count_check")
KINDS = (*ONE_PASS, "duplicate_check", "schema_check")


def _status(bad: Column, limit: float | None, warn: Column) -> Column:
    fails = F.lit(False) if limit is None else bad > F.lit(float(limit))
    return F.when(fails, "FAIL").when(warn, "WARNING").otherwise("PASS")


def _row(spec: CheckSpec, total: Column, bad: Column, pct: Column, status: Column, message: Column) -> Column:
    return F.struct(
        F.lit(spec.name).alias("check_name"),
        F.lit(spec.kind).alias("check_type"),
        F.lit(",".join(spec.columns)).alias("column"),
        status.alias("status"),
        total.cast("long").alias("total_rows"),
        bad.cast("long").alias("bad_rows"),
        pct.cast("double").alias("bad_pct"),
        F.when(status != "PASS", message).otherwise("").alias("message"),
    )


def _percent_row(spec: CheckSpec, total: Column, bad: Column, warn_pct: float, what: str) -> Column:
    pct = F.coalesce(F.try_divide(bad * 100.0, total.cast("double")), F.lit(0.0))
    status = _status(pct, spec.threshold, pct > warn_pct)
    return _row(spec, total, bad, pct, status, F.format_string(f"%d {what} in %d rows", bad.cast("long"), total))


def _problem(df: DataFrame, spec: CheckSpec) -> str | None:
    """Why a check cannot run; such a check fails instead of stopping the others."""
    if spec.kind not in KINDS:
        return f"unsupported check {spec.kind}"
    if spec.kind in ("null_check", "freshness_check") and not spec.columns:
        return "no column given"
    if spec.kind == "range_check" and not spec.condition:
        return "no condition given"
    if spec.kind == "schema_check":
        return None if spec.expected is not None else "no schema given"
    missing = [c for c in spec.columns if c not in df.columns]
    if missing:
        return f"missing column {','.join(missing)}"
    return _invalid(df, spec.condition) if spec.kind == "range_check" else None


def _invalid(df: DataFrame, condition: str) -> str | None:
    """Why a condition cannot be evaluated on ``df``, found by analysing it alone."""
    try:
        kind = df.select(F.expr(condition).alias("c")).schema["c"].dataType
    except AnalysisException as error:
        return f"invalid condition: {error.getCondition() or 'error'}"
    return None if kind == T.BooleanType() else f"condition is {kind.simpleString()}, not boolean"


def _input(spec: CheckSpec) -> Column:
    """What a row adds to the measure of a one-pass check."""
    if spec.kind == "null_check":
        return reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in spec.columns]).cast("long")
    if spec.kind == "range_check":
        return (~F.coalesce(F.expr(spec.condition), F.lit(False))).cast("long")
    if spec.kind == "freshness_check":
        return F.col(f"`{spec.columns[0]}`").cast("timestamp_ntz")
    return F.lit(1).cast("long")


def _merge(spec: CheckSpec, name: str) -> Column:
    """The measure of many rows, or of many partial measures."""
    return (F.max(name) if spec.kind == "freshness_check" else F.sum(name)).alias(name)


def _verdict(spec: CheckSpec, i: int, warn_pct: float, as_of: Column) -> Column:
    total, m = F.col("total"), F.col(f"m{i}")
    if spec.kind == "null_check":
        return _percent_row(spec, total, m, warn_pct, "null values")
    if spec.kind == "range_check":
        return _percent_row(spec, total, m, warn_pct, "invalid values")
    if spec.kind == "freshness_check":
        age = F.timestamp_diff("SECOND", m, as_of) / 3600.0
        limit = F.lit(False) if spec.threshold is None else age > F.lit(float(spec.threshold))
        status = F.when(m.isNull() | limit, "FAIL").when(age > STALE_HOURS, "WARNING").otherwise("PASS")
        text = F.coalesce(F.format_string("%.2f hours old", age), F.lit("no timestamps"))
        return _row(spec, total, F.when(status == "PASS", 0).otherwise(total), F.lit(0.0), status,
                    F.when(m.isNull(), "no timestamps").otherwise(text))
    short = F.lit(False) if spec.threshold is None else total < F.lit(spec.threshold)
    status = F.when(short, "FAIL").otherwise("PASS")
    return _row(spec, total, F.lit(0), F.lit(0.0), status, F.format_string("%d rows", total))


def _one_pass(df: DataFrame, specs: list[CheckSpec], warn_pct: float, as_of: Column) -> DataFrame:
    inputs = df.select(*[_input(s).alias(f"m{i}") for i, s in enumerate(specs)])
    measures = inputs.agg(F.count(F.lit(1)).alias("total"), *[_merge(s, f"m{i}") for i, s in enumerate(specs)])
    filled = {f"m{i}": F.coalesce(f"m{i}", F.lit(0)) for i, s in enumerate(specs) if s.kind != "freshness_check"}
    verdicts = [_verdict(s, i, warn_pct, as_of) for i, s in enumerate(specs)]
    return measures.withColumns(filled).select(F.inline(F.array(*verdicts)))


def _expanded(
    df: DataFrame, single: list[CheckSpec], repeats: list[CheckSpec], warn_pct: float, as_of: Column
) -> DataFrame:
    """Duplicate checks and one-pass checks together.

    Set 0 has no key columns and carries the inputs of the measures; set i has the key columns of the i-th duplicate
    check (all columns if it names none). A column outside a set is null in its rows, and the set's number keeps
    such nulls apart from real ones. Copies of a key are counted before they are shuffled.
    """
    keys = {i: list(dict.fromkeys(s.columns or df.columns)) for i, s in enumerate(repeats, 1)}
    used = list(dict.fromkeys(name for own in keys.values() for name in own))
    named = {name: f"k{n}" for n, name in enumerate(used)}
    inputs = df.select(
        *[F.col(f"`{name}`").alias(named[name]) for name in used],
        *[_input(s).alias(f"m{i}") for i, s in enumerate(single)],
        F.explode(F.array(*[F.lit(i) for i in range(len(repeats) + 1)])).alias("set"),
    )
    at = F.col("set")
    expanded = inputs.select(
        "set",
        *[F.when(at.isin([i for i, own in keys.items() if name in own]), F.col(named[name])).alias(named[name]) for name in used],
        *[F.when(at == 0, F.col(f"m{i}")).alias(f"m{i}") for i in range(len(single))],
    )
    sizes = expanded.groupBy("set", *named.values()).agg(
        F.count(F.lit(1)).alias("n"), *[_merge(s, f"m{i}") for i, s in enumerate(single)]
    )
    counts = sizes.agg(
        F.coalesce(F.sum(F.when(at == 0, F.col("n"))), F.lit(0)).alias("total"),
        *[_merge(s, f"m{i}") for i, s in enumerate(single)],
        *[F.coalesce(F.sum(F.when(at == i, F.col("n") - 1)), F.lit(0)).alias(f"bad{i}") for i in keys],
    )
    # Counts of an empty table are 0, not null.
    filled = counts.withColumns(
        {f"m{i}": F.coalesce(f"m{i}", F.lit(0)) for i, s in enumerate(single) if s.kind != "freshness_check"}
    ) if single else counts
    verdicts = [_verdict(s, i, warn_pct, as_of) for i, s in enumerate(single)]
    verdicts += [
        _percent_row(s, F.col("total"), F.col(f"bad{i}"), warn_pct, "duplicate records") for i, s in enumerate(repeats, 1)
    ]
    return filled.select(F.inline(F.array(*verdicts)))


def schema_differences(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Missing, extra and type-changed columns, from a full outer join of both field lists."""
    spark = df.sparkSession

    def fields(schema: T.StructType, name: str) -> DataFrame:
        return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in schema], f"field STRING, {name} STRING")

    difference = (
        F.when(F.col("actual").isNull(), "missing").when(F.col("expected").isNull(), "extra").otherwise("type")
    )
    return (
        fields(expected, "expected")
        .join(fields(df.schema, "actual"), "field", "full_outer")
        .filter(~F.col("expected").eqNullSafe(F.col("actual")))
        .withColumn("difference", difference)
    )


def _schema(df: DataFrame, spec: CheckSpec) -> DataFrame:
    found = schema_differences(df, spec.expected).agg(
        F.count_if(F.col("difference") == "missing").alias("missing"),
        F.count(F.lit(1)).alias("bad"),
        F.concat_ws(
            "; ", F.array_sort(F.collect_list(F.concat_ws(" ", "difference", "field")))
        ).alias("text"),
    )
    status = F.when(F.col("missing") > 0, "FAIL").when(F.col("bad") > 0, "WARNING").otherwise("PASS")
    fields = F.lit(len(spec.expected))
    pct = F.col("bad") * 100.0 / F.greatest(fields, F.lit(1))
    return found.select(F.inline(F.array(_row(spec, fields, F.col("bad"), pct, status, F.col("text")))))


def run_checks(
    df: DataFrame, specs: list[CheckSpec], as_of: dt.datetime | None = None, warn_pct: float = 0.0
) -> DataFrame:
    """One row per check: PASS, WARNING or FAIL with counts and a message.

    ``warn_pct`` is the share of bad rows a layer tolerates before it warns; ``as_of`` is the clock of freshness.
    """
    now = F.lit(as_of.isoformat(" ")).cast("timestamp_ntz") if as_of else F.localtimestamp()
    broken = {s.name: _problem(df, s) for s in specs}
    sound = [s for s in specs if broken[s.name] is None]
    parts: list[DataFrame] = []
    single = [s for s in sound if s.kind in ONE_PASS]
    repeats = [s for s in sound if s.kind == "duplicate_check"]
    if repeats:
        parts.append(_expanded(df, single, repeats, warn_pct, now))
    elif single:
        parts.append(_one_pass(df, single, warn_pct, now))
    parts += [_schema(df, s) for s in sound if s.kind == "schema_check"]
    unsound = [s for s in specs if broken[s.name] is not None]
    if unsound:
        rows = [(s.name, s.kind, ",".join(s.columns), "FAIL", None, None, None, broken[s.name]) for s in unsound]
        parts.append(df.sparkSession.createDataFrame(rows, RESULT_SCHEMA))
    return reduce(DataFrame.unionByName, parts)


def orphans(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Foreign keys without a dimension row and how many fact rows use them.

    Facts are counted per key before the anti join, so a hot key joins as one row.
    """
    used = facts.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return used.join(dimension.select(key), key, "left_anti")


# Size of a key filter and how many of its bits a key sets. 8 million bits are 1 MB, with 1 % of false hits at 850,000 keys.
FILTER_BITS = 1 << 23
FILTER_HASHES = 7
_BITMAP_BITS = 32_768  # of one bitmap aggregate


def _positions(key: Column, bits: int) -> Column:
    return F.array(*[F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits)) for i in range(FILTER_HASHES)])


def key_filter(dimension: DataFrame, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """A Bloom filter of the non-null keys: rows (part, bitmap), parts without a key left out.

    Filters of the same size merge by OR of equal parts, so a stored one takes new keys without a scan of the old ones.
    """
    at = dimension.filter(F.col(key).isNotNull()).select(F.explode(_positions(F.col(key), bits)).alias("at"))
    return at.groupBy(F.expr(f"at div {_BITMAP_BITS}").alias("part")).agg(
        F.bitmap_construct_agg(F.col("at") % _BITMAP_BITS).alias("bitmap")
    )


def merged_filters(*filters: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, filters).groupBy("part").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def possible(df: DataFrame, filter_rows: DataFrame, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """``df`` with a column ``possible``: false only if the key is certainly not in the filter.

    The filter enters as one value of ``bits`` / 8 bytes at most, so rows are tested where they are read.
    """
    parts = F.map_from_entries(F.collect_list(F.struct("part", "bitmap")))
    empty = F.lit(bytes(_BITMAP_BITS // 8))
    whole = filter_rows.agg(parts.alias("parts")).select(
        F.transform(
            F.sequence(F.lit(0).cast("long"), F.lit((bits - 1) // _BITMAP_BITS).cast("long")),
            lambda i: F.coalesce(F.try_element_at("parts", i), empty),
        ).alias("parts")
    )

    def is_set(at: Column) -> Column:
        inside = at % _BITMAP_BITS
        part = F.get("_filter", F.floor(at / _BITMAP_BITS).cast("int"))
        byte = F.conv(F.hex(F.substring(part, (F.floor(inside / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return byte.bitwiseAND(F.pow(F.lit(2), inside % 8).cast("int")) != 0

    tested = F.forall(_positions(F.col(key), bits), is_set)
    return df.withColumn("_filter", whole.scalar()).withColumn("possible", F.col(key).isNotNull() & tested).drop("_filter")


def filtered_orphans(facts: DataFrame, dimension: DataFrame, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """As ``orphans``: keys that miss the filter are certain, and only the others meet the dimension.

    Any ``bits`` gives the same rows; a filter too small for the dimension only leaves more keys to the join.
    """
    used = facts.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    tested = possible(used, key_filter(dimension, key, bits), key, bits)
    certain = tested.filter(~F.col("possible")).drop("possible")
    open_ = tested.filter("possible").drop("possible").join(dimension.select(key), key, "left_anti")
    return certain.unionByName(open_)


def referential_check(facts: DataFrame, dimension: DataFrame, key: str, name: str) -> DataFrame:
    used = facts.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    known = dimension.select(key).distinct().withColumn("known", F.lit(True))
    counts = used.join(known, key, "left").agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("rows"))), F.lit(0)).alias("bad"),
    )
    spec = CheckSpec(name, "referential_integrity", [key], threshold=0.0)
    verdict = _percent_row(spec, F.col("total"), F.col("bad"), 0.0, "orphan rows")
    return counts.select(F.inline(F.array(verdict)))


def summary(results: DataFrame) -> DataFrame:
    """Totals per status and the pass rate in percent."""
    counted = results.agg(
        F.count(F.lit(1)).alias("total_checks"),
        *[
            F.count_if(F.col("status") == s).alias(f"{n}_checks")
            for s, n in [("PASS", "passed"), ("WARNING", "warning"), ("FAIL", "failed")]
        ],
    )
    rate = F.try_divide(F.col("passed_checks") * 100.0, F.col("total_checks").cast("double"))
    return counted.withColumn("pass_rate", F.coalesce(rate, F.lit(0.0)))


def accepted(results: DataFrame) -> bool:
    """The gate: a table passes unless a check failed; warnings pass."""
    return results.filter("status = 'FAIL'").isEmpty()


# Suites by table. Dimension keys must be unique, or joins would multiply facts.
SUITES: dict[str, list[CheckSpec]] = {
    "bronze.races": [
        CheckSpec("races_null_check", "null_check", ["raceId"], threshold=0.0),
        CheckSpec("races_row_count", "row_count_check", threshold=100),
        CheckSpec("races_unique", "duplicate_check", ["raceId"], threshold=0.0),
    ],
    "bronze.drivers": [
        CheckSpec("drivers_null_check", "null_check", ["driverId"], threshold=0.0),
        CheckSpec("drivers_unique", "duplicate_check", ["driverId"], threshold=0.0),
    ],
    "bronze.constructors": [CheckSpec("constructors_unique", "duplicate_check", ["constructorId"], threshold=0.0)],
    "bronze.circuits": [CheckSpec("circuits_unique", "duplicate_check", ["circuitId"], threshold=0.0)],
    "bronze.lap_times": [
        CheckSpec("lap_times_range_check", "range_check", ["milliseconds"], "milliseconds > 0", 1.0)
    ],
    "bronze.results": [
        CheckSpec("results_keys", "null_check", ["raceId", "driverId", "constructorId"], threshold=0.0),
        CheckSpec("results_row_count", "row_count_check", threshold=1),
        CheckSpec("results_duplicates", "duplicate_check", ["raceId", "driverId"], threshold=1.0),
    ],
    "silver.performance": [
        CheckSpec("performance_null_check", "null_check", ["driverId"], threshold=0.0),
        CheckSpec("performance_keys", "null_check", ["raceId", "driverId", "constructorId"], threshold=0.0),
        CheckSpec("performance_position", "range_check", ["position"], "position >= 1 OR position IS NULL", 0.0),
        CheckSpec("performance_freshness", "freshness_check", ["ingestion_timestamp"], threshold=48),
    ],
    "silver.pit_analysis": [
        CheckSpec("pit_duration_positive", "range_check", ["milliseconds"], "milliseconds > 0", 0.0)
    ],
    "gold.driver_statistics": [
        CheckSpec("driver_statistics_null_check", "null_check", ["driverId"], threshold=0.0),
        CheckSpec("driver_statistics_complete", "null_check", ["driverId", "year", "total_points"], threshold=0.0),
        CheckSpec("races_cover_wins", "range_check", ["total_races"], "total_races >= total_wins", 0.0),
    ],
    "gold.constructor_rankings": [
        CheckSpec("points_not_negative", "range_check", ["total_points"], "total_points >= 0", 0.0)
    ],
    "gold.championship_standings": [
        # A season may have more than 50 drivers, so this one warns.
        CheckSpec(
            "rankings_range_check", "range_check", ["championship_position"],
            "championship_position >= 1 AND championship_position <= 50",
        )
    ],
}
