"""Stateful trailing means and in-place upserts at their edges."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lapwise.queries import storage
from lapwise.sinks import merge
from lapwise.sources.binding import Binding
from lapwise.streaming import trailing

T0 = dt.datetime(2024, 1, 1)
LAPS = "driverId long, raceId long, lap int, milliseconds long, at timestamp"


def lap(driver, race, number, ms, minute):
    return driver, race, number, ms, T0 + dt.timedelta(minutes=minute)


def plain(rows, size=5):
    """Means of the laps before, each lap once."""
    best = {}
    for driver, race, number, ms, at in rows:
        place = (driver, race, number)
        if place not in best or (at, ms) < best[place]:
            best[place] = (at, ms)
    found = {}
    for driver in {p[0] for p in best}:
        own = sorted(p for p in best if p[0] == driver)
        times = [best[p][1] for p in own]
        for i, place in enumerate(own):
            before = times[max(0, i - size) : i]
            found[place] = (times[i], sum(before) / len(before) if before else None)
    return found


def collected(spark, path):
    rows = spark.read.schema(trailing.OUTPUT).parquet(path).collect()
    found = {(r["driverId"], r["raceId"], r["lap"]): (r["milliseconds"], r["recent"]) for r in rows}
    assert len(found) == len(rows)  # every lap once
    return found


def test_late_and_repeated_laps_over_restarts(spark, rows, tmp_path):
    source, target, state = (f"{tmp_path}/{n}" for n in ("in", "out", "state"))
    rng = random.Random(2)
    laps = [lap(d, r, n, rng.randint(70, 90), r * 500 + n * 2 + d) for d in (1, 2) for r in (1, 2) for n in range(1, 15)]
    schema = rows(LAPS).schema

    def feed(batch):
        rows(LAPS, *batch).coalesce(1).write.mode("append").parquet(source)
        trailing.stream_trailing_means(spark, source, schema, target, state, delay="30 minutes")

    first = [x for x in laps if x[1] == 1]
    rng.shuffle(first)
    feed(first[:14] + first[:3])
    feed(first[14:] + first[5:9])  # late within the delay, and repeated
    early = collected(spark, target)
    assert all(plain(laps)[k] == pytest.approx(v) for k, v in early.items()) and len(early) < 28
    second = [x for x in laps if x[1] == 2]
    feed(second)
    assert len(collected(spark, target)) >= 28
    too_late = [lap(1, 1, 99, 1, 1)]
    feed([lap(9, 0, 1, 1, 100_000), *second[:4]])  # the watermark passes everything
    feed(too_late)
    found = collected(spark, target)
    assert found == {k: pytest.approx(v) for k, v in plain(laps).items()}


def test_state_expires(spark, rows, tmp_path):
    source, target, state = (f"{tmp_path}/{n}" for n in ("in", "out", "state"))
    schema = rows(LAPS).schema

    def feed(*batch):
        rows(LAPS, *batch).coalesce(1).write.mode("append").parquet(source)
        trailing.stream_trailing_means(spark, source, schema, target, state, delay="1 minute", idle_ms=60_000)

    feed(lap(1, 1, 1, 80, 0), lap(1, 1, 2, 82, 1))
    feed(lap(2, 1, 1, 70, 100))
    feed(lap(2, 1, 2, 70, 200))  # driver 1 was idle for long and its state is gone
    feed(lap(1, 1, 3, 90, 300), lap(None, 1, 3, 90, 300), lap(1, None, 3, 90, 300))
    feed(lap(2, 1, 3, 70, 900))
    found = collected(spark, target)
    assert found[1, 1, 2] == (82, 80.0) and found[1, 1, 3] == (90, None)


def test_waiting_laps_keep_their_order():
    rows = [(1, 3, 50, 7), (1, 1, 30, 5), (1, 1, 20, 9), (1, 2, 90, 6)]
    waiting = trailing.admitted([], rows, (0, 9))
    assert waiting == [(1, 1, 20, 9), (1, 2, 90, 6), (1, 3, 50, 7)]
    assert [trailing.due(waiting, w) for w in (10, 20, 60, 90)] == [0, 1, 1, 3]
    assert trailing.admitted(waiting, [(1, 2, 1, 1)], (1, 2)) == [(1, 3, 50, 7)]


DDL = "k INT, v STRING, year INT"


def test_repeated_keys_of_a_target_are_refused_or_left(spark, rows, values, tmp_path):
    path = str(tmp_path / "p")
    rows(DDL, (1, "a", 2000), (1, "b", 2000), (2, "a", 2000), (3, "a", 2001)).write.partitionBy("year").parquet(path)
    with pytest.raises(merge.DuplicateKeys, match="1"):
        merge.upsert_partitions(spark, path, rows(DDL, (1, "n", 2001)), ["k"], "year")
    merge.upsert_partitions(spark, path, rows(DDL, (2, "n", 2000)), ["k"], "year")
    assert values(spark.read.parquet(path)) == [(1, "a", 2000), (1, "b", 2000), (2, "n", 2000), (3, "a", 2001)]


def test_a_key_left_in_two_partitions_is_mended(spark, rows, values, tmp_path):
    path = str(tmp_path / "p")
    rows(DDL, (1, "new", 2001), (1, "old", 2000), (2, "x", 2000)).write.partitionBy("year").parquet(path)
    merge.upsert_partitions(spark, path, rows(DDL, (1, "new", 2001)), ["k"], "year")
    assert values(spark.read.parquet(path)) == [(1, "new", 2001), (2, "x", 2000)]


def test_many_partitions_are_rewritten_in_turns(spark, rows, values, tmp_path, monkeypatch):
    monkeypatch.setattr(merge, "MAX_TOUCHED", 3)
    path = str(tmp_path / "p")
    rows(DDL, *[(i, "o", 2000 + i % 8) for i in range(24)]).write.partitionBy("year").parquet(path)
    # Every key moves one year on, so rows cross the turns.
    moved = [(i, "n", 2001 + i % 8) for i in range(20)]
    merge.upsert_partitions(spark, path, rows(DDL, *moved), ["k"], "year")
    want = sorted(moved + [(i, "o", 2000 + i % 8) for i in range(20, 24)])
    assert sorted(map(tuple, spark.read.parquet(path).select("k", "v", "year").collect())) == want


def test_changes_are_dealt_to_files_of_bounded_rows(spark, monkeypatch):
    """More rows make more files in as many batches, not larger files."""
    seen = []

    def look(session, source, schema, *rest, files_per_batch, **more):
        name = F.input_file_name().alias("name")
        sizes = [r["count"] for r in session.read.parquet(source).groupBy(name).count().collect()]
        seen.append((len(sizes), max(sizes), sum(sizes), files_per_batch))

    monkeypatch.setattr(storage, "FILE_ROWS", 500, raising=False)
    monkeypatch.setattr(storage.incremental, "stream_upsert", look)
    b = Binding(spark, "/root/testdata/sf0.001")
    storage._streamed(b)
    rows = b.given("lineitem").count()
    per_batch = -(-rows // 1500)
    files, largest, total, taken = seen[0]
    assert (files, total, taken) == (3 * per_batch, rows, per_batch) and largest <= 550


def test_no_frame_is_made_for_laps_that_wait(spark, rows, monkeypatch):
    laps = rows(LAPS, lap(1, 1, 1, 10, 0))
    monkeypatch.setattr(type(laps.groupBy("lap")), "applyInPandasWithState", lambda _, step, *more: step)
    step = trailing.trailing_means(laps)

    class State:
        exists, watermark, kept = False, 0, None

        def getCurrentWatermarkMs(self):
            return self.watermark

        def setTimeoutTimestamp(self, at):
            pass

        def update(self, value):
            self.exists, self.get = True, value

    state = State()
    batch = pd.DataFrame({"raceId": [1, 1], "lap": [2, 1], "milliseconds": [30, 10], "at_ms": [7, 5]})
    assert list(step((1,), iter([batch]), state)) == []
    state.watermark = 8
    (out,) = step((1,), iter([]), state)
    assert out.drop(columns="recent").values.tolist() == [[1, 1, 1, 10], [1, 1, 2, 30]]
    assert out["recent"].isna().tolist() == [True, False] and out["recent"][1] == 10.0
    assert list(map(str, out.dtypes)) == ["int64", "int64", "int32", "int64", "float64"]
