"""Measured model calls: exact counts, forecasts as without measuring, histogram of the times."""

from __future__ import annotations

import datetime as dt
from bisect import bisect_left

import pytest
from pyspark.sql import functions as F

from coldloop.config import TwinConfig
from coldloop.operators import calls
from coldloop.operators import days as D
from coldloop.operators.artifacts import MeanArtifact, to_bytes
from coldloop.operators.scorers import lookback_mean
from coldloop.plans.twin import forecast
from coldloop.session import scratch_path

CFG = TwinConfig()


@pytest.fixture
def frames(make_readings, day_of):
    rows = [(asset, ts, None if (i + asset) % 11 == 0 else 5 + (i * (asset + 1)) % 7 / 3, float(i % 2))
            for asset in (1, 2) for day in range(1, 4)
            for i, ts in enumerate(day_of(dt.date(2024, 3, day), 30))]
    return D.day_frames(make_readings(rows), CFG)


@pytest.fixture
def scored(spark, frames):
    models = {"long": to_bytes(MeanArtifact([1] * 12)), "short": to_bytes(MeanArtifact([1] * 6))}
    found = calls.measured(spark, frames, models, CFG)
    path = scratch_path(spark, "measured")
    found.write.parquet(path)
    return spark.read.schema(found.schema).parquet(path)


def test_forecasts_equal_the_plain_scorers(scored, frames):
    for name, steps in (("long", 12), ("short", 6)):
        got = {(r.asset_id, r.d, r.k): r.t_int_pred for r in scored.where(F.col("model") == name).collect()}
        want = {(r.asset_id, r.d, r.k): r.t_int_pred
                for r in forecast(frames, CFG, lookback_mean(steps)).collect()}
        assert got == want and len(got) > 100


def test_each_model_is_called_once_a_day(scored):
    found = calls.day_calls(scored).collect()
    assert len(found) == 2 * 2 * 3 and all(r.calls == 1 and r.seconds > 0 for r in found)
    first = [r for r in found if r.d == dt.date(2024, 3, 1)]
    assert {r.rows_asked for r in first} == {18} and {r.rows_asked for r in found} == {18, 30}
    assert all(r.loaded_at is not None and r.rows_scored == r.rows_asked for r in found)


def test_histogram_counts_the_measured_times(scored):
    bounds = (1e-6, 1e-4, 1e-3)
    times = {}
    for r in scored.where("call_seconds is not null").collect():
        times.setdefault(r.model, []).append(r.call_seconds)
    got = {}
    for r in calls.latency_histogram(scored, bounds).collect():
        got[r.model, r.le] = r.calls
        assert r.seconds == pytest.approx(sum(times[r.model]))
    assert got == {(m, le): sum(t <= le for t in ts)
                   for m, ts in times.items() for le in (*bounds, float("inf"))}
    assert all(bisect_left(sorted(ts), float("inf")) == 6 for ts in times.values())


def test_no_models_and_no_days(spark, frames, make_readings):
    assert calls.measured(spark, frames, {}, CFG).count() == 0
    empty = D.day_frames(make_readings([(1, dt.datetime(2024, 1, 1), 5.0, 0.0)]), CFG)
    found = calls.measured(spark, empty, {"m": to_bytes(MeanArtifact([1] * 12))}, CFG)
    assert calls.day_calls(found).collect() == []
