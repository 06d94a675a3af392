"""The streaming twin gives the batch result, batch by batch."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest

from coldloop.config import TwinConfig
from coldloop.operators import days as D
from coldloop.plans.twin import controlled, forecast
from coldloop.session import scratch_path
from coldloop.sources.readings import normalise
from coldloop.streaming.controller import OUTPUT_COLUMNS, StreamingTwin, run_available

CFG = TwinConfig()
LATER = 2_000_000_000  # file times beyond the present, to set the order of the files


def random_feed(seed, dates=6):
    """Dense, sparse and gappy assets, in time order."""
    rng = random.Random(seed)
    rows = []
    for asset, sizes in enumerate([(160, 200), (1, 2, 5), (14, 30)]):
        for date in range(dates):
            if asset and rng.random() < 0.3:
                continue
            for _ in range(rng.choice(sizes)):
                ts = dt.datetime(2026, 3, 1) + dt.timedelta(
                    days=date, seconds=rng.randrange(86_400))
                rows.append((asset, ts, round(rng.uniform(5.5, 8.5), 2),
                             float(rng.random() < 0.4)))
    return sorted(rows, key=lambda r: r[1])


def expected(readings):
    rows = controlled(forecast(D.frames_by_asset(readings, CFG), CFG), CFG)
    return sorted(rows.select(*OUTPUT_COLUMNS).collect())


def pieces(readings, cuts):
    """Micro-batches of consecutive readings, given by reading id."""
    bounds = [0, *cuts, 10**9]
    return [readings.where(f"reading_id >= {a} AND reading_id < {b}")
            for a, b in zip(bounds, bounds[1:], strict=False)]


def test_micro_batches_equal_one_batch(spark, make_readings):
    readings = make_readings(random_feed(4)).persist()
    total = readings.count()
    rng = random.Random(9)
    cuts = sorted(rng.sample(range(1, total), 4)) + [total - 3]
    twin = StreamingTwin(spark, scratch_path(spark, "twin"), CFG)
    for i, piece in enumerate(pieces(readings, cuts)):
        twin(piece, i)
        if i == 2:
            twin(piece, i)  # the same batch again, as after a failure
    assert sorted(twin.results().select(*OUTPUT_COLUMNS).collect()) == expected(readings)


def test_late_rows_go_to_the_rejected_table(spark, make_readings):
    readings = make_readings(random_feed(5, dates=3))
    total = readings.count()
    twin = StreamingTwin(spark, scratch_path(spark, "twin"), CFG)
    first, second = pieces(readings, [total // 2])
    twin(first, 0)
    again = first.where("reading_id % 5 = 0")
    twin(second.unionByName(again), 1)
    assert sorted(twin.results().select(*OUTPUT_COLUMNS).collect()) == expected(readings)
    rejected = twin.rejected()
    assert {r.batch for r in rejected.collect()} == {"1"}
    assert sorted(rejected.select("reading_id").collect()) == sorted(
        again.select("reading_id").collect())


def test_rows_out_of_order_within_the_allowance(spark, make_readings):
    """Interleaved batches, a flush, and batches after it: each reading counts once."""
    readings = make_readings(random_feed(8, dates=3)).persist()
    twin = StreamingTwin(spark, scratch_path(spark, "twin"), CFG, allowance=dt.timedelta(days=2))
    first = readings.where("timestamp < timestamp_ntz'2026-03-02 12:00:00'")
    for i in range(2):
        twin(first.where(f"reading_id % 2 = {i}"), i)
    twin.flush()
    assert sorted(twin.results().select(*OUTPUT_COLUMNS).collect()) == expected(first)
    resumed = StreamingTwin(spark, twin.path, CFG, allowance=twin.allowance)
    rest = readings.where("timestamp >= timestamp_ntz'2026-03-02 12:00:00'")
    for i in range(2):
        resumed(rest.where(f"reading_id % 2 = {1 - i}"), 2 + i)
    resumed.flush()
    assert sorted(resumed.results().select(*OUTPUT_COLUMNS).collect()) == expected(readings)
    assert resumed.rejected().isEmpty()


@pytest.mark.parametrize("files", [3])
def test_file_stream(spark, make_readings, files):
    """Files become micro-batches in order of their time stamp."""
    readings = make_readings(random_feed(6, dates=4))
    path = scratch_path(spark, "feed")
    total = readings.count()
    for i, piece in enumerate(pieces(readings, [total * j // files for j in range(1, files)])):
        piece.drop("d").coalesce(1).write.mode("append").parquet(path)
        for entry in os.scandir(path):
            if entry.name.endswith(".parquet") and entry.stat().st_mtime < LATER:
                os.utime(entry.path, (LATER + i, LATER + i))
    stream = (spark.readStream.schema(readings.drop("d").schema)
              .option("maxFilesPerTrigger", 1).parquet(path))
    twin = StreamingTwin(spark, scratch_path(spark, "twin"), CFG)
    got = run_available(normalise(stream), twin)
    assert len(os.listdir(f"{twin.path}/results")) >= files
    assert sorted(got.select(*OUTPUT_COLUMNS).collect()) == expected(readings)
