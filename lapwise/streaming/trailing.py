"""Trailing means over a stream of laps, with keyed state and event-time timers.

A driver's laps may arrive late, repeated and out of order. They wait in the driver's state until the watermark has passed
them, and leave it in the order of race and lap with the mean of the laps before. The state holds the waiting laps, the last
``size`` laps that left, and how far it has come; a timer wakes it when its next lap is due, and when nothing has come for
``idle`` it is removed. What leaves equals the batch window over the same rows: each lap once, later copies dropped.

Rows later than the watermark are dropped, as ``delay`` says. Of different rows for one lap the first by event time and then
the shorter one counts. Rows without driver, race, lap or time are left out. A restart goes on from the checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

SIZE = 5
OUTPUT = "driverId LONG, raceId LONG, lap INT, milliseconds LONG, recent DOUBLE"
KINDS = [("driverId", "int64"), ("raceId", "int64"), ("lap", "int32"), ("milliseconds", "int64"), ("recent", "float64")]
# Waiting laps, laps that left last (oldest first), the last lap that left, and the latest event time in milliseconds.
STATE = (
    "waiting ARRAY<STRUCT<race: LONG, lap: LONG, at: LONG, ms: LONG>>, recent ARRAY<LONG>, race LONG, lap LONG, latest LONG"
)
Lap = tuple[int, int, int, int]


def admitted(waiting: list[Lap], fresh: list[Lap], done: tuple[int, int]) -> list[Lap]:
    """Waiting laps after new ones came: one row a lap, none that already left, in order of race and lap."""
    best: dict[tuple[int, int], Lap] = {}
    for row in [*waiting, *fresh]:
        place = row[:2]
        if place > done and (place not in best or row[2:] < best[place][2:]):
            best[place] = row
    return [best[place] for place in sorted(best)]


def due(waiting: list[Lap], watermark: int) -> int:
    """How many waiting laps, from the first, the watermark has passed; one that is not due holds up those behind it."""
    for number, row in enumerate(waiting):
        if row[2] > watermark:
            return number
    return len(waiting)


def trailing_means(laps: DataFrame, size: int = SIZE, delay: str = "1 hour", idle_ms: int = 86_400_000) -> DataFrame:
    """A stream of laps (driverId, raceId, lap, milliseconds, at) with the mean of each driver's ``size`` laps before."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        waiting, recent, race, lap, latest = state.get if state.exists else ([], [], -(2**63), -(2**63), 0)
        waiting = [tuple(row) for row in waiting]
        recent, fresh = list(recent), []
        for batch in batches:
            fresh += zip(*(batch[n].to_numpy("int64").tolist() for n in ("raceId", "lap", "at_ms", "milliseconds")))
        latest = max([latest, *(row[2] for row in fresh)])
        waiting = admitted(waiting, fresh, (race, lap))
        watermark = state.getCurrentWatermarkMs()
        ready = due(waiting, watermark)
        out = []
        for row in waiting[:ready]:
            out.append((key[0], row[0], row[1], row[3], sum(recent) / len(recent) if recent else None))
            recent = [*recent, row[3]][-size:]
            race, lap = row[:2]
        waiting = waiting[ready:]
        if not waiting and latest + idle_ms <= watermark:
            state.remove()
        else:
            state.update((waiting, recent, race, lap, latest))
            wake = min(row[2] for row in waiting) if waiting else latest + idle_ms
            state.setTimeoutTimestamp(max(wake, watermark) + 1)
        # Most calls come for drivers whose laps still wait: no frame is made for them.
        if out:
            yield pd.DataFrame({name: np.array(column, kind) for (name, kind), column in zip(KINDS, zip(*out))})

    timed = (
        laps.dropna(subset=["driverId", "raceId", "lap", "milliseconds", "at"])
        .withColumn("at", F.col("at").cast("timestamp"))
        .withWatermark("at", delay)
        .select(
            F.col("driverId").cast("long"), F.col("raceId").cast("long"), F.col("lap").cast("long"),
            F.col("milliseconds").cast("long"), "at", F.unix_millis("at").alias("at_ms"),
        )
    )
    return timed.groupBy("driverId").applyInPandasWithState(
        step, OUTPUT, STATE, "append", GroupStateTimeout.EventTimeTimeout
    )


def stream_trailing_means(
    spark: SparkSession, source_path: str, schema: T.StructType, target_path: str, checkpoint: str, delay: str = "1 hour",
    files_per_batch: int | None = None, idle_ms: int = 86_400_000,
) -> None:
    """Take in all files now under ``source_path``, append what is due to ``target_path`` and stop.

    A later call goes on where this one ended; laps not yet passed by the watermark wait in the checkpointed state.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (
        trailing_means(reader.parquet(source_path), delay=delay, idle_ms=idle_ms)
        .writeStream.format("parquet").option("path", target_path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
