"""Sources, sinks, audit columns, upserts and incremental loads over the given data.

Round trips write Spark-derived data to shared scratch storage and read it back.
"""

from __future__ import annotations

import uuid

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwise import constants as C
from lapwise.operators import maintenance, monitoring
from lapwise.operators.staging import scratch, stage
from lapwise.plans import gold, season, silver
from lapwise.queries import quality as ledgers
from lapwise.queries.common import sql
from lapwise.queries.gold import bound, performance, standings
from lapwise.schemas import RAW, SPECS
from lapwise.sinks import merge, writers
from lapwise.sources import readers
from lapwise.sources.binding import Binding
from lapwise.streaming import incremental, trailing

AS_OF = dt.datetime(2001, 8, 1)


def _raw_results(b: Binding) -> DataFrame:
    return b.results().select(
        "raceId", "driverId", "constructorId", "position", "positionText", "positionOrder",
        F.col("points").cast("string").alias("points"),
        F.col("laps").cast("string").alias("laps"),
        "fastestLap",
    )


def _csv_races(b: Binding) -> DataFrame:
    folder = scratch(b.spark, "races-csv")
    races = b.raw_races()
    races.write.option("header", True).option("nullValue", "\\N").csv(folder)
    read = readers.read_csv(b.spark, folder, races.schema)
    return read.groupBy("year", "round").agg(
        F.count(F.lit(1)).alias("races"), F.count("time").alias("timed"), F.max("date").alias("last_date")
    )


def _json_results(b: Binding) -> DataFrame:
    folder = scratch(b.spark, "results-json")
    raw = _raw_results(b)
    raw.write.json(folder)
    read = silver.cleaned_results(readers.read_json(b.spark, folder, raw.schema))
    return read.groupBy("constructorId").agg(
        F.count(F.lit(1)).alias("results"), F.count("position").alias("placed"), F.sum("points").alias("points")
    )


def _directory(b: Binding) -> DataFrame:
    """Laps written as many CSV files, found to be CSV by peeking into the directory."""
    folder = scratch(b.spark, "lap-times")
    columns = RAW["lap_times"].names
    laps = b.lap_times().select(*columns)
    laps.repartition(6, "raceId").write.option("header", True).csv(folder)
    read = readers.read_source(b.spark, folder, schema=laps.schema)
    return read.groupBy("raceId").agg(
        F.count(F.lit(1)).alias("laps"), F.min("milliseconds").alias("fastest"), F.max("lap").alias("last_lap")
    )


def _lower_names(b: Binding) -> DataFrame:
    stem = scratch(b.spark, "drivers")
    b.drivers().write.json(f"{stem}.json")
    return readers.read_csv_or_json(b.spark, stem)


def _probe(b: Binding) -> DataFrame:
    base = scratch(b.spark, "raw")
    b.raw_races().select(*RAW["races"].names).write.option(
        "header", True
    ).csv(f"{base}/races.csv")
    _raw_results(b).write.json(f"{base}/results.json")
    specs = [SPECS["bronze.races"], SPECS["bronze.results"], SPECS["bronze.circuits"]]
    return readers.probe(b.spark, specs, base).select(
        "table", "file_exists", (F.col("bytes") > 0).alias("has_bytes"), "rows"
    )


def _partitioned(b: Binding) -> DataFrame:
    path = scratch(b.spark, "performance")
    writers.write_table(performance(b), path, ["year"], ["raceId", "driverId"])
    return (
        readers.read_table(b.spark, path)
        .filter("year = 1999")
        .groupBy("year", "driverId")
        .agg(F.count(F.lit(1)).alias("results"), F.sum("points").alias("points"))
    )


def _appended(b: Binding) -> DataFrame:
    path = scratch(b.spark, "races")
    races = b.races().select("raceId", "year", "round")
    writers.write_table(races.filter("year < 1998"), path, cluster_by=["raceId"])
    writers.append(races.filter("year >= 1998"), path, cluster_by=["raceId"])
    return readers.read_table(b.spark, path).groupBy("year").agg(
        F.count(F.lit(1)).alias("races"), F.sum("raceId").alias("id_sum")
    )


def _evolved(b: Binding) -> DataFrame:
    races = b.races()
    old = races.filter("year < 1998").select("raceId", "year")
    new = races.filter("year >= 1998").select("raceId", "year", "round")
    return readers.evolve(old, new).groupBy("year").agg(
        F.count(F.lit(1)).alias("races"), F.count("round").alias("with_round")
    )


def _clustered(b: Binding) -> DataFrame:
    path = scratch(b.spark, "laps-clustered")
    writers.clustered(b.lap_times(), ["raceId", "driverId", "lap"]).write.parquet(path)
    return readers.read_table(b.spark, path).groupBy("raceId").agg(
        F.count(F.lit(1)).alias("laps"), F.sum("milliseconds").alias("milliseconds")
    )


def _on_curve(b: Binding) -> DataFrame:
    """Laps clustered along a curve through three columns, filtered on the second and third."""
    path = scratch(b.spark, "laps-on-curve")
    writers.write_table(b.lap_times(), path, curve_by=["raceId", "driverId", "milliseconds"])
    return (
        readers.read_table(b.spark, path)
        .filter("driverId BETWEEN 5 AND 60 AND milliseconds >= 20000")
        .groupBy("raceId")
        .agg(F.count(F.lit(1)).alias("laps"), F.sum("milliseconds").alias("milliseconds"))
    )


def _compacted(b: Binding) -> DataFrame:
    path, new_path = scratch(b.spark, "small-files"), scratch(b.spark, "compact")
    b.races().repartition(16).write.parquet(path)
    writers.compact(b.spark, path, new_path)
    return readers.read_table(b.spark, new_path).groupBy("circuitId").agg(
        F.count(F.lit(1)).alias("races"), F.min("date").cast("string").alias("first_date")
    )


def _keyed(df: DataFrame) -> DataFrame:
    """One row per merge key."""
    keys = C.RESULT_MERGE_KEYS
    return df.groupBy(*keys, "year").agg(
        F.min("position").alias("position"),
        F.sum("points").alias("points"),
        F.max("laps").alias("laps"),
        F.min("positionText").alias("positionText"),
        F.max("fastestLap").alias("fastestLap"),
    )


def _old_and_new(b: Binding) -> tuple[DataFrame, DataFrame]:
    """A target of the seasons up to 1999 and a correction of all from 1999 on."""
    rows = stage(_keyed(silver.race_facts(b.results(), b.races())))
    changed = rows.filter("year >= 1999").withColumns({"points": F.col("points") + 1, "fastestLap": F.lit(-1)})
    return rows.filter("year <= 1999"), changed


def _upserted(b: Binding) -> DataFrame:
    old, changed = _old_and_new(b)
    first, second = scratch(b.spark, "results-1"), scratch(b.spark, "results-2")
    old.write.parquet(first)
    return merge.upsert(b.spark, first, second, changed, C.RESULT_MERGE_KEYS, C.RESULT_UPDATE_COLUMNS)


def _merge_join(b: Binding) -> DataFrame:
    old, changed = _old_and_new(b)
    return merge.merged(old, changed, C.RESULT_MERGE_KEYS)


def _upserted_partitions(b: Binding) -> DataFrame:
    old, changed = _old_and_new(b)
    path = scratch(b.spark, "results-by-year")
    writers.write_table(old, path, ["year"], ["raceId"])
    merge.upsert_partitions(b.spark, path, changed, C.RESULT_MERGE_KEYS, "year", C.RESULT_UPDATE_COLUMNS)
    return (
        readers.read_table(b.spark, path)
        .groupBy("year")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("points").alias("points"), F.sum("fastestLap").alias("fastest"))
    )


def _changes(b: Binding) -> DataFrame:
    """Order status changes: every lineitem touches its order at its ship date."""
    return b.given("lineitem").select(
        F.col("l_orderkey").alias("raceId"),
        F.col("l_suppkey").alias("driverId"),
        F.col("l_quantity").alias("points"),
        F.col("l_linenumber").alias("position"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_shipdate").alias("ingestion_timestamp"),
        F.year("l_shipdate").alias("year"),
    )


_CHANGE_ORDER = ["ingestion_timestamp", "position", "points", "price"]


def _high_water(b: Binding) -> DataFrame:
    changes = _changes(b).drop("year")
    target = incremental.newest_per_key(
        changes.filter("ingestion_timestamp < '1998-01-01'"), ["raceId", "driverId"], _CHANGE_ORDER
    )
    return incremental.incremental_merge(
        target, changes, "ingestion_timestamp", ["raceId", "driverId"], ordering=_CHANGE_ORDER
    ).select("raceId", "driverId", "points", "position", "price")


# Batches of the upserting stream, and about how many rows a task deals into one of their files at most.
BATCHES = 3
FILE_ROWS = 1_000_000


def _streamed(b: Binding) -> DataFrame:
    """The change rows as files, upserted by a stream in three batches into a table of the first year."""
    source, target = scratch(b.spark, "changes"), scratch(b.spark, "streamed")
    changes = _changes(b)
    keys = ["year", "raceId", "driverId"]
    incremental.newest_per_key(changes.filter("year = 1996"), keys, _CHANGE_ORDER).write.partitionBy("year").parquet(
        target
    )
    files = max(1, -(-changes.count() // (BATCHES * FILE_ROWS)))
    changes.repartition(BATCHES * files).write.parquet(source)
    incremental.stream_upsert(
        b.spark, source, changes.schema, target, scratch(b.spark, "stream-state"), keys,
        "ingestion_timestamp", "year", ordering=_CHANGE_ORDER, files_per_batch=files,
    )
    return readers.read_table(b.spark, target).select("raceId", "driverId", "points", "position", "price", "year")


def _trailing(b: Binding) -> DataFrame:
    """All laps through the stateful stream; a last row of no driver, much later, lets the watermark pass them all."""
    source, target = scratch(b.spark, "timed-laps"), scratch(b.spark, "trailing-laps")
    rows = b.timed_laps()
    end = rows.agg(F.timestamp_add("DAY", F.lit(100), F.max("at")).alias("at")).select(
        F.lit(-1).cast("long").alias("driverId"), F.lit(0).cast("long").alias("raceId"), F.lit(1).alias("lap"),
        F.lit(0).cast("long").alias("milliseconds"), "at",
    )
    rows.unionByName(end).write.parquet(source)
    trailing.stream_trailing_means(b.spark, source, rows.schema, target, scratch(b.spark, "trailing-state"))
    return (
        b.spark.read.schema(trailing.OUTPUT).parquet(target).withColumn("recent", F.round("recent", 6))
    )


def _audit(b: Binding) -> DataFrame:
    races = readers.updated(readers.audited(b.races(), 7, AS_OF), AS_OF)
    return races.groupBy("processing_batch_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("ingestion_date").cast("string").alias("ingestion_date"),
        F.date_format(F.max("ingestion_timestamp"), "yyyy-MM-dd HH:mm:ss").alias("ingestion_timestamp"),
        F.max("last_updated_date").cast("string").alias("last_updated_date"),
    )


def _source_file(b: Binding) -> DataFrame:
    return (
        readers.with_source_file(b.given("orders").select("o_orderkey"))
        .groupBy("source_file_name")
        .agg(F.count(F.lit(1)).alias("rows"), (F.min("source_file_size") > 0).alias("has_size"))
    )


RULES = {
    "position": "position BETWEEN 1 AND 6",
    "points": "points >= 10",
    "laps": "laps <= 45",
}


def _quarantined(b: Binding) -> DataFrame:
    good, bad = writers.quarantine(silver.cleaned_results(b.results()), RULES)
    parts = good.withColumn("reject_reason", F.lit("")).unionByName(bad)
    return parts.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("rows"), F.sum("points").alias("points"))


def _dead_letters(b: Binding) -> DataFrame:
    good, bad = writers.write_with_quarantine(
        silver.cleaned_results(b.results()), RULES, scratch(b.spark, "checked-results")
    )
    return (
        good.withColumn("valid", F.lit(True))
        .unionByName(bad.drop("reject_reason").withColumn("valid", F.lit(False)))
        .groupBy("valid", "constructorId")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("points").alias("points"))
    )


def _season_tables(b: Binding) -> DataFrame:
    """The one-season variant from files to files; its constructor table."""
    raw, out = scratch(b.spark, "season-raw"), scratch(b.spark, "season")
    teams = b.constructors().select(
        "constructorId", F.col("constructorName").alias("name"), F.col("constructorNationality").alias("nationality")
    )
    for name, df in {"drivers": b.drivers(), "results": b.results(), "races": b.races()}.items():
        df.write.option("header", True).csv(f"{raw}/{name}.csv")
    teams.write.json(f"{raw}/constructors.json")
    season.run(b.spark, raw, out)
    return readers.read_table(b.spark, f"{out}/gold/constructor_rankings")


def _exported(b: Binding) -> DataFrame:
    """Both ledgers written as JSON and read back."""
    out = scratch(b.spark, "metrics")
    monitoring.export(ledgers.runs(b), ledgers.tables(b), out)
    runs = readers.read_json(b.spark, f"{out}/runs", ledgers.runs(b).schema)
    tables = readers.read_json(b.spark, f"{out}/tables", ledgers.tables(b).schema)
    return (
        runs.select(F.lit("runs").alias("ledger"), F.col("rows_processed").alias("n"))
        .unionByName(tables.select(F.lit("tables").alias("ledger"), F.col("row_count").alias("n")))
        .groupBy("ledger")
        .agg(F.count(F.lit(1)).alias("records"), F.sum("n").alias("rows"))
    )


def _refreshed(b: Binding) -> DataFrame:
    current = standings(b).filter("year = 2001").select("driverId", "year", "championship_position", "total_points")
    return writers.refresh(current, scratch(b.spark, "current-standings"))


def _maintained(b: Binding) -> DataFrame:
    """Stored season sums moved by a correction: a season arrives late, one gets new points, retirements since 2000 go."""
    stored = gold.stored_seasons()
    facts = stage(silver.race_facts(b.results(), b.races()))
    before = facts.filter("year <> 1992")
    corrected = facts.filter("year = 1999").withColumn("points", F.col("points") + 1)
    removed = before.filter("year = 1999 OR (year >= 2000 AND dnf_status)")
    added = corrected.unionByName(facts.filter("year = 1992"))
    current = before.filter("year <> 1999 AND NOT (year >= 2000 AND dnf_status)").unionByName(added)
    first, second = scratch(b.spark, "seasons-1"), scratch(b.spark, "seasons-2")
    stored.compute(before).write.partitionBy("year").parquet(first)
    maintenance.refresh_stored(b.spark, stored, first, second, removed, added, current, "year")
    return stored.visible(readers.read_table(b.spark, second))


def _registered(b: Binding) -> DataFrame:
    """A partitioned table known to the catalog, read by its name; only the entry is dropped afterwards."""
    name = f"registered_{uuid.uuid4().hex}"
    path = scratch(b.spark, name)
    writers.write_table(b.races().select("raceId", "year", "round"), path, ["year"])
    writers.register(b.spark, name, path)
    return b.spark.table(name).groupBy("year").agg(
        F.count(F.lit(1)).alias("races"), F.sum("raceId").cast("long").alias("id_sum")
    )


def _given_rows(b: Binding) -> DataFrame:
    """Scoring inputs given as rows, joined to the stored table they refer to, which is cut to one row a year before."""
    wanted = readers.from_rows(b.spark, [(year, f"season {year}") for year in range(1992, 1999)], "year INT, label STRING")
    seasons = b.races().groupBy("year").agg(F.count(F.lit(1)).alias("races"))
    return seasons.join(wanted, "year").groupBy("year", "label").agg(F.sum("races").alias("races"))


QUERIES = {
    "src8_given_rows": bound(_given_rows),
    "snk2_registered_table": bound(_registered),
    "src1_csv_races": bound(_csv_races),
    "src2_json_results": bound(_json_results),
    "src3_directory_scan": bound(_directory),
    "src5_table_scan": bound(
        lambda b: b.given("lineitem").groupBy("l_returnflag", "l_linestatus").agg(
            F.count(F.lit(1)).alias("rows"), F.sum("l_quantity").alias("quantity")
        )
    ),
    "src7_lower_case_names": bound(_lower_names),
    "src9_source_probe": bound(_probe),
    "snk1_partitioned_table": bound(_partitioned),
    "snk3_append": bound(_appended),
    "snk3_schema_evolution": bound(_evolved),
    "snk4_upsert": bound(_upserted),
    "snk4_upsert_partitions": bound(_upserted_partitions),
    "snk6_clustered_table": bound(_clustered),
    "snk6_curve_clustered": bound(_on_curve),
    "snk7_compacted_table": bound(_compacted),
    "snk8_season_tables": bound(_season_tables),
    "snk9_metrics_export": bound(_exported),
    "snk10_quarantine_reasons": bound(_quarantined),
    "snk10_dead_letters": bound(_dead_letters),
    "snk11_refreshed_standings": bound(_refreshed),
    "snk11_maintained_seasons": bound(_maintained),
    "snk12_retention": bound(
        lambda b: writers.retained(b.races(), "date", C.RETENTION_DAYS["silver"], AS_OF.date())
        .groupBy("year", "round")
        .agg(F.count(F.lit(1)).alias("races"))
    ),
    "join10_merge": bound(_merge_join),
    "inc1_high_water_mark": bound(_high_water),
    "inc3_stream_upsert": bound(_streamed),
    "inc3_trailing_laps": bound(_trailing),
    "aud1_audit_columns": bound(_audit),
    "aud3_source_file": bound(_source_file),
}

_KEYED = """SELECT raceId, driverId, constructorId, year, min(position) AS position, sum(points) AS points,
    max(laps) AS laps, min(positionText) AS positionText, max(fastestLap) AS fastestLap
    FROM facts GROUP BY raceId, driverId, constructorId, year"""

_FAILS = """CASE WHEN coalesce(position BETWEEN 1 AND 6, false) THEN NULL ELSE 'position' END,
    CASE WHEN coalesce(points >= 10, false) THEN NULL ELSE 'points' END,
    CASE WHEN coalesce(laps <= 45, false) THEN NULL ELSE 'laps' END"""

_NEWEST = """SELECT {columns} FROM (SELECT l_orderkey AS raceId, l_suppkey AS driverId, l_quantity AS points,
    l_linenumber AS position, l_extendedprice AS price, CAST(year(l_shipdate) AS INTEGER) AS year,
    row_number() OVER (PARTITION BY {keys} ORDER BY l_shipdate DESC, l_linenumber DESC, l_quantity DESC,
      l_extendedprice DESC) AS n FROM lineitem) WHERE n = 1"""

SQL = {
    "src1_csv_races": sql(
        """SELECT year, round, count(*) AS races, count(h) AS timed, max(date) AS last_date
        FROM raw_races GROUP BY year, round""",
        "raw_races",
    ),
    "src2_json_results": sql(
        """SELECT constructorId, count(*) AS results, count(position) AS placed, sum(points) AS points
        FROM facts GROUP BY constructorId""",
        "facts",
    ),
    "src3_directory_scan": sql(
        """SELECT raceId, count(*) AS laps, min(milliseconds) AS fastest, max(lap) AS last_lap
        FROM laps GROUP BY raceId""",
        "laps",
    ),
    "src5_table_scan": """SELECT l_returnflag, l_linestatus, count(*) AS "rows", sum(l_quantity) AS quantity
        FROM lineitem GROUP BY ALL""",
    "src7_lower_case_names": sql(
        "SELECT driverId AS driverid, forename, surname, nationality FROM drivers", "drivers"
    ),
    "src9_source_probe": """SELECT 'races' AS "table", true AS file_exists, true AS has_bytes, count(*) AS "rows" FROM orders
        UNION ALL SELECT 'results', true, true, count(*) FROM lineitem UNION ALL SELECT 'circuits', false, false, NULL""",
    "snk1_partitioned_table": sql(
        """SELECT year, driverId, count(*) AS results, sum(points) AS points FROM performance WHERE year = 1999
        GROUP BY ALL""",
        "performance",
    ),
    "snk3_append": sql(
        "SELECT year, count(*) AS races, CAST(sum(raceId) AS BIGINT) AS id_sum FROM races GROUP BY year", "races"
    ),
    "snk3_schema_evolution": sql(
        "SELECT year, count(*) AS races, count(*) FILTER (WHERE year >= 1998) AS with_round FROM races GROUP BY year",
        "races",
    ),
    "snk4_upsert": sql(
        """SELECT raceId, driverId, constructorId, year, position, points + CAST(year >= 1999 AS INTEGER) AS points, laps,
        positionText, CASE WHEN year > 1999 THEN -1 ELSE fastestLap END AS fastestLap FROM keyed""",
        "facts",
        keyed=_KEYED,
    ),
    "snk4_upsert_partitions": sql(
        """SELECT year, count(*) AS "rows", sum(points + CAST(year >= 1999 AS INTEGER)) AS points,
        CAST(sum(CASE WHEN year > 1999 THEN -1 ELSE fastestLap END) AS BIGINT) AS fastest FROM keyed GROUP BY year""",
        "facts",
        keyed=_KEYED,
    ),
    "src8_given_rows": sql(
        """SELECT year, 'season ' || year AS label, count(*) AS races FROM races WHERE year BETWEEN 1992 AND 1998
        GROUP BY year""",
        "races",
    ),
    "snk2_registered_table": sql(
        "SELECT year, count(*) AS races, CAST(sum(raceId) AS BIGINT) AS id_sum FROM races GROUP BY year", "races"
    ),
    "snk6_clustered_table": sql(
        """SELECT raceId, count(*) AS laps, CAST(sum(milliseconds) AS BIGINT) AS milliseconds FROM laps
        GROUP BY raceId""",
        "laps",
    ),
    "snk6_curve_clustered": sql(
        """SELECT raceId, count(*) AS laps, CAST(sum(milliseconds) AS BIGINT) AS milliseconds FROM laps
        WHERE driverId BETWEEN 5 AND 60 AND milliseconds >= 20000 GROUP BY raceId""",
        "laps",
    ),
    "snk7_compacted_table": sql(
        """SELECT circuitId, count(*) AS races, strftime(min(date), '%Y-%m-%d') AS first_date FROM races
        GROUP BY circuitId""",
        "races",
    ),
    "snk8_season_tables": sql(
        """SELECT constructorName, y.year, sum(points) AS total_points, count(DISTINCT r.raceId) AS total_races,
        count(*) FILTER (WHERE positionOrder = 1) AS total_wins,
        count(*) FILTER (WHERE positionOrder = 1) / count(DISTINCT r.raceId) AS team_win_rate
        FROM results r JOIN races y ON r.raceId = y.raceId JOIN constructors c ON r.constructorId = c.constructorId
        WHERE y.year = (SELECT max(s.year) FROM races s JOIN results t ON s.raceId = t.raceId) GROUP BY ALL""",
        "results", "races", "constructors",
    ),
    "snk9_metrics_export": """SELECT 'runs' AS ledger, count(*) AS records, CAST(sum(user_id) AS BIGINT) AS "rows"
        FROM events UNION ALL SELECT 'tables', count(*), CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT)
        FROM events""",
    "snk10_quarantine_reasons": sql(
        f"""SELECT concat_ws(',', {_FAILS}) AS reject_reason, count(*) AS "rows", sum(points) AS points
        FROM facts GROUP BY 1""",
        "facts",
    ),
    "snk10_dead_letters": sql(
        f"""SELECT concat_ws(',', {_FAILS}) = '' AS valid, constructorId, count(*) AS "rows", sum(points) AS points
        FROM facts GROUP BY ALL""",
        "facts",
    ),
    "snk11_refreshed_standings": sql(
        "SELECT driverId, year, championship_position, total_points FROM standings WHERE year = 2001", "standings"
    ),
    "snk11_maintained_seasons": sql(
        """SELECT driverId, constructorId, year, count(raceId) AS total_races,
        count(*) FILTER (WHERE position = 1) AS total_wins, count(*) FILTER (WHERE podium_finish) AS total_podiums,
        count(*) FILTER (WHERE dnf_status) AS dnf_count, count(*) FILTER (WHERE fastestLap = 1) AS fastest_laps,
        count(position) FILTER (WHERE finished_race) AS finishes,
        sum(points + CASE WHEN year = 1999 THEN 1 ELSE 0 END) AS total_points,
        CAST(sum(position) FILTER (WHERE finished_race) AS BIGINT) AS finish_sum,
        CAST(sum(position * position) FILTER (WHERE finished_race) AS BIGINT) AS finish_squares,
        min(position) AS career_best_position, max(position) AS career_worst_position
        FROM facts WHERE NOT (year >= 2000 AND dnf_status) GROUP BY ALL""",
        "facts",
    ),
    "snk12_retention": sql(
        """SELECT year, round, count(*) AS races FROM races WHERE date >= DATE '2001-08-01' - INTERVAL 730 DAY
        GROUP BY ALL""",
        "races",
    ),
    "join10_merge": sql(
        """SELECT raceId, driverId, constructorId, year, position, points + CAST(year >= 1999 AS INTEGER) AS points, laps,
        positionText, CASE WHEN year >= 1999 THEN -1 ELSE fastestLap END AS fastestLap FROM keyed""",
        "facts",
        keyed=_KEYED,
    ),
    "inc1_high_water_mark": _NEWEST.format(
        columns="raceId, driverId, points, position, price", keys="l_orderkey, l_suppkey"
    ),
    "inc3_stream_upsert": _NEWEST.format(
        columns="raceId, driverId, points, position, price, year", keys="l_orderkey, l_suppkey, year(l_shipdate)"
    ),
    "inc3_trailing_laps": sql(
        """SELECT driverId, raceId, lap, milliseconds, round(avg(milliseconds) OVER (PARTITION BY driverId
          ORDER BY raceId, lap ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), 6) AS recent FROM laps""",
        "laps",
    ),
    "aud1_audit_columns": """SELECT CAST(7 AS BIGINT) AS processing_batch_id, count(*) AS "rows",
        '2001-08-01' AS ingestion_date, '2001-08-01 00:00:00' AS ingestion_timestamp,
        '2001-08-01' AS last_updated_date FROM orders""",
    "aud3_source_file": """SELECT 'orders.parquet' AS source_file_name, count(*) AS "rows", true AS has_size
        FROM orders""",
}
