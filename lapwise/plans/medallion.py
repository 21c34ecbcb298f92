"""Raw files to bronze, silver and gold tables: a short loop in dependency order, with checks and ledgers.

A table is computed once: it is written under its batch, checked as stored, and only the ledger row written after
its checks passed makes it visible. So a failed check leaves the last good batch in place, and the tables after it go
on from that. Ledgers are appended under ``<lake>/monitoring``.

An incremental run reads only raw files it has not loaded. Of the growing tables (results, laps, stops, qualifying) a bronze
batch then holds the new rows alone and names the batch it adds to; the table is all of them together. Silver tables of
results and stops take the new rows: those of a key replace its rows of before. Small tables are loaded whole, and gold
tables are built from silver as always.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapwise import constants as C
from lapwise.operators import monitoring as mon
from lapwise.operators import quality as dq
from lapwise.operators.staging import stage
from lapwise.plans import gold, silver
from lapwise.schemas import BRONZE, SPECS, TableSpec
from lapwise.sinks import writers
from lapwise.sources import readers


class Lake:
    """Tables by full name below one folder; each reads its last accepted batch."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")
        self._partials: DataFrame | None = None

    def season_partials(self) -> DataFrame:
        """The sums behind all season tables, computed once per run from the accepted performance table."""
        if self._partials is None:
            self._partials = stage(gold.season_partials(self.table("silver.performance")))
        return self._partials

    def path(self, name: str, batch_id: int) -> str:
        return f"{SPECS[name].path(self.base)}/batch={batch_id}"

    def batches(self, name: str) -> list[int]:
        """The last accepted batch and those it adds to, newest first; none before the first load."""
        rows = self.ledger("tables").filter(F.col("table_name") == name).groupBy("batch_id").agg(
            F.max(F.struct("recorded", "base_batch")).alias("last")
        ).select("batch_id", "last.*").collect()  # one row a load
        bases = {r["batch_id"]: r["base_batch"] for r in rows}
        found = [max(rows, key=lambda r: (r["recorded"], r["batch_id"]))["batch_id"]] if rows else []
        while found and bases[found[-1]] is not None:
            found.append(bases[found[-1]])
        return found

    def table(self, name: str) -> DataFrame:
        batches = self.batches(name)
        if not batches:
            raise LookupError(f"no accepted batch of {name}")
        parts = [readers.read_table(self.spark, self.path(name, batch)) for batch in batches]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    def increment(self, name: str, batch_id: int) -> DataFrame | None:
        """The rows that a batch added to the ones before; None if it added none or was a whole load."""
        batches = self.batches(name)
        if len(batches) < 2 or batches[0] != batch_id:
            return None
        return readers.read_table(self.spark, self.path(name, batch_id))

    def ledger(self, name: str) -> DataFrame:
        schema = LEDGERS[name]
        try:
            return self.spark.read.schema(schema).parquet(f"{self.base}/monitoring/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def note(self, name: str, df: DataFrame) -> None:
        df.write.mode("append").parquet(f"{self.base}/monitoring/{name}")


LEDGERS = {
    "runs": mon.RUN_SCHEMA,
    "tables": mon.TABLE_SCHEMA + ", batch_id BIGINT, base_batch BIGINT",
    "checks": dq.RESULT_SCHEMA + ", table STRING, batch_id BIGINT, checked TIMESTAMP",
}


def _teams(lake: Lake) -> DataFrame:
    return lake.table("bronze.constructors").select(
        "constructorId", F.col("name").alias("constructorName"), F.col("nationality").alias("constructorNationality")
    )


def _performance(lake: Lake, results: DataFrame) -> DataFrame:
    return silver.performance(results, lake.table("bronze.races"), lake.table("bronze.drivers"), _teams(lake))


def _pit_analysis(lake: Lake, stops: DataFrame) -> DataFrame:
    return silver.pit_analysis(
        stops, lake.table("bronze.races"), lake.table("bronze.drivers"), lake.table("bronze.results")
    )


# Raw tables that grow by files, and the silver tables that take their new rows: source, builder and keys.
GROWING = ["bronze.results", "bronze.lap_times", "bronze.pit_stops", "bronze.qualifying"]
ADVANCED = {
    "silver.performance": ("bronze.results", _performance, C.RESULT_MERGE_KEYS),
    "silver.pit_analysis": ("bronze.pit_stops", _pit_analysis, ["raceId", "driverId", "stop"]),
}


def _unread(lake: Lake, name: str, raw: DataFrame) -> DataFrame:
    """The rows of raw files that no accepted batch of a table holds; the scan skips all other files."""
    loaded = lake.table(name)
    mark = loaded.agg(F.max("source_file_modified")).first()[0]
    if mark is None:
        return raw
    modified = F.col("_metadata.file_modification_time")
    # Files of the very same time as the newest one are told apart by name.
    same = [r[0] for r in loaded.filter(F.col("source_file_modified") == F.lit(mark)).select("source_file_name").distinct().collect()]
    return raw.filter((modified > F.lit(mark)) | ((modified == F.lit(mark)) & ~F.col("_metadata.file_name").isin(same)))


def _advance(lake: Lake, name: str, batch_id: int) -> DataFrame | None:
    """A silver table after the new rows of its source; None if there are none."""
    source, build, keys = ADVANCED[name]
    fresh = lake.increment(source, batch_id)
    if fresh is None:
        return None
    new = build(lake, fresh)
    return lake.table(name).join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


SILVER_BUILDERS = {
    "silver.races": lambda k: silver.races(k.table("bronze.races")),
    "silver.drivers": lambda k: silver.drivers(k.table("bronze.drivers")),
    "silver.constructors": lambda k: silver.constructors(k.table("bronze.constructors")),
    "silver.circuits": lambda k: silver.circuits(k.table("bronze.circuits")),
    "silver.performance": lambda k: _performance(k, k.table("bronze.results")),
    "silver.pit_analysis": lambda k: _pit_analysis(k, k.table("bronze.pit_stops")),
}

GOLD_BUILDERS = {
    "gold.driver_statistics": lambda k: gold.driver_statistics(k.season_partials(), k.table("bronze.drivers"), _teams(k)),
    "gold.constructor_rankings": lambda k: gold.constructor_rankings(
        k.season_partials(), k.table("bronze.drivers"), _teams(k)
    ),
    "gold.lap_time_trends": lambda k: gold.lap_time_trends(
        k.table("bronze.lap_times"), k.table("bronze.races"), silver.race_teams(k.table("bronze.results"))
    ),
    "gold.pit_stop_efficiency": lambda k: gold.pit_stop_efficiency(k.table("silver.pit_analysis"), _teams(k)),
    "gold.race_pace_analysis": lambda k: gold.race_pace_analysis(
        k.table("silver.performance"), k.table("bronze.lap_times")
    ),
    "gold.championship_standings": lambda k: gold.championship_standings(
        gold.driver_seasons(k.season_partials(), k.table("bronze.drivers"))
    ),
    "gold.qualifying_vs_race": lambda k: gold.qualifying_vs_race(
        k.table("bronze.qualifying"), k.table("silver.performance")
    ),
    "gold.driver_consistency": lambda k: gold.driver_consistency(k.table("gold.driver_statistics")),
}


# Raw rows that a silver table leaves out, with the rules they break.
REJECTS = {
    "silver.performance": ("bronze.results", silver.result_rules()),
    "silver.pit_analysis": ("bronze.pit_stops", silver.pit_stop_rules()),
}


def _set_aside(lake: Lake, name: str, batch_id: int) -> None:
    """Write the rows that the rules of a silver table reject, with their reasons, under ``<lake>/quarantine``."""
    source, rules = REJECTS[name]
    fresh = lake.increment(source, batch_id)
    rejected = writers.checked(lake.table(source) if fresh is None else fresh, rules).filter("reject_reason <> ''")
    rejected.write.mode("overwrite").parquet(f"{lake.base}/quarantine/{name}/batch={batch_id}")


def _publish(
    lake: Lake, spec: TableSpec, df: DataFrame, batch_id: int, at: dt.datetime, base: int | None = None
) -> bool:
    """Write one table, check it as stored and record it; False when a check failed and it stays invisible.

    With ``base`` the rows add to that batch: they alone are checked, and none at all leave the table as it is.
    """
    name, path = spec.full_name, lake.path(spec.full_name, batch_id)
    if name in REJECTS:
        _set_aside(lake, name, batch_id)
    writers.write_table(df, path, spec.partition_by, spec.cluster_by)
    stored = readers.read_table(lake.spark, path)
    if base is not None and stored.isEmpty():
        return True
    quality = None
    if name in dq.SUITES:
        results = dq.run_checks(stored, dq.SUITES[name], at, C.WARNING_PERCENT[spec.layer])
        marked = results.withColumns(
            {"table": F.lit(name), "batch_id": F.lit(batch_id).cast("long"), "checked": F.lit(at)}
        )
        lake.note("checks", marked)
        noted = lake.ledger("checks").filter(
            (F.col("table") == name) & (F.col("batch_id") == batch_id) & (F.col("checked") == F.lit(at))
        )
        if not dq.accepted(noted):
            return False
        quality = dq.summary(noted)
    partition = spec.partition_by[0] if spec.partition_by else None
    whole = stored if base is None else lake.table(name).unionByName(stored, allowMissingColumns=True)
    record = mon.table_record(whole, name, at, quality, partition)
    lake.note(
        "tables", record.withColumns({"batch_id": F.lit(batch_id).cast("long"), "base_batch": F.lit(base).cast("long")})
    )
    return True


def run(
    spark: SparkSession,
    raw_base: str,
    lake_base: str,
    batch_id: int,
    at: dt.datetime,
    tables: list[str] | None = None,
    incremental: bool = False,
) -> dict[str, str]:
    """Build all tables (or the named ones) and return SUCCESS, PARTIAL or FAILED per layer.

    ``incremental`` loads what was added since the last accepted batch; a table without one is loaded whole. Batch ids
    of incremental runs are new ones.
    """
    lake = Lake(spark, lake_base)
    bases: dict[str, int] = {}
    if incremental:
        for name in GROWING:
            known = lake.batches(name)
            if batch_id in known:
                raise ValueError(f"batch {batch_id} of {name} was loaded already")
            if known:
                bases[name] = known[0]

    def bronze(spec: TableSpec) -> DataFrame:
        raw = readers.read_raw(spark, spec, raw_base)
        if spec.full_name in bases:
            raw = _unread(lake, spec.full_name, raw)
        return readers.audited(readers.with_source_file(raw), batch_id, at)

    def built(name: str, make) -> DataFrame | None:
        if incremental and name in ADVANCED and ADVANCED[name][0] in bases and lake.batches(name):
            df = _advance(lake, name, batch_id)
            return None if df is None else readers.updated(df, at)
        return readers.updated(make(lake), at)

    layers = {
        "bronze": [(spec, lambda spec=spec: bronze(spec)) for spec in BRONZE],
        "silver": [(SPECS[n], lambda n=n, make=make: built(n, make)) for n, make in SILVER_BUILDERS.items()],
        "gold": [(SPECS[n], lambda make=make: readers.updated(make(lake), at)) for n, make in GOLD_BUILDERS.items()],
    }
    states: dict[str, str] = {}
    for layer, steps in layers.items():
        wanted = [(spec, make) for spec, make in steps if tables is None or spec.full_name in tables]
        if not wanted:
            continue
        states[layer] = _run_layer(lake, layer, wanted, batch_id, at, bases)
    return states


def _run_layer(
    lake: Lake, layer: str, wanted: list, batch_id: int, at: dt.datetime, bases: dict[str, int]
) -> str:
    """Publish the tables of one layer. The ledger has the start of the run at once, and its end also after a crash."""
    started, done, problems = dt.datetime.now(), [], []
    run_id = f"{layer}-{batch_id}-{started.isoformat()}"
    lake.note("runs", mon.run_record(lake.spark, run_id, layer, started, None, "RUNNING"))

    def close(status: str) -> None:
        written = lake.ledger("tables").filter((F.col("batch_id") == batch_id) & F.col("table_name").isin(done))
        rows = mon.latest_per_table(written).agg(F.sum("row_count")).first()[0] or 0
        error = "; ".join(problems) or None
        lake.note("runs", mon.run_record(lake.spark, run_id, layer, started, dt.datetime.now(), status, rows, done, error))

    for spec, make in wanted:
        try:
            df = make()
            if df is None or _publish(lake, spec, df, batch_id, at, bases.get(spec.full_name)):
                done.append(spec.full_name)
            else:
                problems.append(f"{spec.full_name}: failed checks")
        except (AnalysisException, LookupError) as error:
            problems.append(f"{spec.full_name}: {error}")
        except Exception as error:
            problems.append(f"{spec.full_name}: {error}")
            close("FAILED")
            raise
    status = mon.final_status(len(done), len(wanted))
    close(status)
    return status
