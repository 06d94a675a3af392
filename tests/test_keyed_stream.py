"""The stream with state by asset gives the batch result, and costs what a batch's assets cost."""

from __future__ import annotations

import datetime as dt
import os
import random
from pathlib import Path

import pytest

from coldloop.config import TwinConfig
from coldloop.operators import days as D
from coldloop.plans.twin import controlled, forecast
from coldloop.session import scratch_path
from coldloop.sources.readings import normalise
from coldloop.streaming.controller import OUTPUT_COLUMNS
from coldloop.streaming.keyed import KeyedTwin, run_available
from tests.test_stream import random_feed

CFG = TwinConfig()
LATER = 2_000_000_000


def expected(readings):
    rows = controlled(forecast(D.frames_by_asset(readings, CFG), CFG), CFG)
    return sorted(rows.select(*OUTPUT_COLUMNS).collect(), key=str)


def got(twin):
    return sorted(twin.results().select(*OUTPUT_COLUMNS).collect(), key=str)


@pytest.fixture
def feed(spark):
    """Adds readings as the next file of a folder."""
    class Feed:
        path, files = scratch_path(spark, "feed"), 0

        def add(self, readings):
            readings.drop("d").coalesce(1).write.mode("append").parquet(self.path)
            for entry in os.scandir(self.path):
                if entry.name.endswith(".parquet") and entry.stat().st_mtime < LATER:
                    os.utime(entry.path, (LATER + self.files, LATER + self.files))
            self.files += 1

        def stream(self, schema):
            return normalise(spark.readStream.schema(schema)
                             .option("maxFilesPerTrigger", 1).parquet(self.path))
    return Feed()


def with_gaps(rows, seed):
    """Some temperatures and states unknown."""
    rng = random.Random(seed)
    return [(a, ts, None if rng.random() < .15 else t, None if rng.random() < .1 else s)
            for a, ts, t, s in rows]


@pytest.mark.parametrize("seed", [4, 11])
def test_five_unordered_files_and_a_restart(spark, make_readings, feed, seed):
    readings = make_readings(with_gaps(random_feed(seed, dates=5), seed)).persist()
    schema = readings.drop("d").schema
    # Deal each half over its files, so every file has rows of all times of its half.
    middle = "timestamp_ntz'2026-03-03 12:00:00'"
    early, rest = readings.where(f"timestamp < {middle}"), readings.where(f"timestamp >= {middle}")
    for i in range(3):
        feed.add(early.where(f"reading_id % 3 = {i}"))
    path = scratch_path(spark, "keyed")
    twin = KeyedTwin(spark, path, CFG, allowance=dt.timedelta(days=4))
    run_available(feed.stream(schema), twin)
    assert got(twin) == expected(early)  # all of it waits and is provisional
    for i in range(2):
        feed.add(rest.where(f"reading_id % 2 = {i}"))
    resumed = KeyedTwin(spark, path, CFG, allowance=twin.allowance)
    run_available(feed.stream(schema), resumed)
    assert got(resumed) == expected(readings)
    assert resumed.rejected().isEmpty()
    assert {p.name for p in Path(path, "out").iterdir()} >= {"batch=4", "batch=waiting"}


def test_a_batch_that_fails_is_repeated(spark, make_readings, feed):
    readings = make_readings(random_feed(6, dates=4)).persist()
    total = readings.count()
    for i in range(3):
        feed.add(readings.where(f"reading_id >= {total * i // 3} AND reading_id < {total * (i + 1) // 3}"))
    schema, path = readings.drop("d").schema, scratch_path(spark, "keyed")

    class Failing(KeyedTwin):
        def _write(self, batch, batch_id):
            super()._write(batch, batch_id)
            if batch_id == 1:
                raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        Failing(spark, path, CFG).start(feed.stream(schema)).awaitTermination()
    twin = KeyedTwin(spark, path, CFG)
    run_available(feed.stream(schema), twin)
    assert got(twin) == expected(readings)
    assert twin.rejected().isEmpty()


def test_late_rows_are_rejected_by_asset(spark, make_readings, feed):
    """A reading from the future makes no other asset's rows late."""
    rows = random_feed(5, dates=3)
    future = [(9, dt.datetime(2099, 1, 1), 7.0, 1.0)]
    readings = make_readings(rows + future).persist()
    total = len(rows)
    first = readings.where(f"reading_id < {total // 2}")
    again = first.where("reading_id % 5 = 0")
    feed.add(first.unionByName(readings.where("asset_id = 9")))
    feed.add(readings.where(f"reading_id >= {total // 2} AND asset_id <> 9").unionByName(again))
    twin = KeyedTwin(spark, scratch_path(spark, "keyed"), CFG)
    run_available(feed.stream(readings.drop("d").schema), twin)
    assert got(twin) == expected(readings)
    rejected = twin.rejected()
    assert {r.batch for r in rejected.collect()} == {"1"}
    columns = ["asset_id", "reading_id", "timestamp", "T_int", "Etat_Compresseur", "d"]
    assert sorted(rejected.select(*columns).collect()) == sorted(again.select(*columns).collect())


def test_a_silent_asset_is_processed_by_its_timer(spark, make_readings, feed):
    day = dt.datetime(2026, 3, 1)
    stamps = [day + dt.timedelta(minutes=10 * i) for i in range(60)]
    silent = [(1, ts, 6.0 + i % 3, i % 2 * 1.0) for i, ts in enumerate(stamps[:30])]
    busy = [(2, ts + dt.timedelta(days=j), 7.0, 0.0) for j in range(6) for ts in stamps[:20]]
    readings = make_readings(silent + busy).persist()
    feed.add(readings.where("timestamp < timestamp_ntz'2026-03-02 00:00:00'"))
    for j in range(1, 6):
        feed.add(readings.where(f"d = date'2026-03-0{j + 1}'"))
    feed.add(readings.where("asset_id = 1 AND reading_id < 3"))  # behind the fleet's clock
    path = scratch_path(spark, "keyed")
    twin = KeyedTwin(spark, path, CFG, allowance=dt.timedelta(days=1), idle=dt.timedelta(days=2))
    twin.start(feed.stream(readings.drop("d").schema)).awaitTermination()
    want = [r for r in expected(readings) if r.asset_id == 1]
    assert len(want) == 18
    assert [r for r in got(twin) if r.asset_id == 1] == want  # no flush was needed
    assert any(r.asset_id == 2 for r in got(twin))
    assert sorted(r.reading_id for r in twin.rejected().collect()) == [0, 1, 2]


def test_a_batch_writes_what_its_assets_need(spark, make_readings, feed):
    day = dt.datetime(2026, 3, 1)
    fleet = [(a, day + dt.timedelta(minutes=10 * i), 7.0 + a % 2, 0.0) for a in range(300) for i in range(20)]
    few = [(a, day + dt.timedelta(hours=9, minutes=10 * i), 7.0, 1.0) for a in (5, 77) for i in range(20)]
    readings = make_readings(fleet + few).persist()
    feed.add(readings.where(f"reading_id < {len(fleet)}"))
    feed.add(readings.where(f"reading_id >= {len(fleet)}"))
    path = scratch_path(spark, "keyed")
    twin = KeyedTwin(spark, path, CFG)
    query = twin.start(feed.stream(readings.drop("d").schema))
    query.awaitTermination()
    updated = [p["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress
               if p["numInputRows"]]
    size = {label: sum(f.stat().st_size for f in Path(path, "out", f"batch={label}").rglob("*.parquet"))
            for label in (0, 1)}
    state = {v: sum(f.stat().st_size for f in Path(path, "checkpoint", "state").rglob(f"{v}.changelog"))
             for v in (1, 2)}
    assert updated[1] <= updated[0] / 50
    assert size[1] < size[0] / 2 and 0 < state[2] < state[1] / 10
    assert twin.results().where("asset_id in (5, 77)").count() == 2 * 28


def test_nothing_to_do(spark, make_readings, feed):
    readings = make_readings([(1, dt.datetime(2026, 3, 1), 7.0, 0.0)])
    feed.add(readings.limit(0))
    twin = KeyedTwin(spark, scratch_path(spark, "keyed"), CFG)
    twin.start(feed.stream(readings.drop("d").schema)).awaitTermination()
    twin.flush()
