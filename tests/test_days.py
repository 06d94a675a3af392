"""Positions, day index and slices against brute force, in every layout."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from coldloop.config import TwinConfig
from coldloop.operators import days as D
from coldloop.operators import ordering
from coldloop.operators.layout import Layout, measure
from coldloop.operators.routed import summarise
from coldloop.operators.scorers import PowerLine, lookback_mean
from coldloop.plans.twin import forecast, twin_date, twin_days, twin_from_frames
from tests import brute

CFG = TwinConfig()
D1, D2, D9 = dt.date(2026, 5, 1), dt.date(2026, 5, 2), dt.date(2026, 5, 9)


def routed(readings, target):
    """Frames of an even fleet by its stored summary; a target of 20 makes its days crowded."""
    frames, = summarise(readings, target).frames(readings, CFG)
    return frames


LAYOUTS = {
    "routed_whole": lambda r: routed(r, 10**6),
    "routed_split": lambda r: routed(r, 1) if r.count() < 20 else routed(r, 19),
    "routed_crowded": lambda r: routed(r, min(8, r.count() - 1)),
    "by_asset": lambda r: D.frames_by_asset(r, CFG),
    "by_day": lambda r: D.frames_by_day(r, CFG),
    "by_crowded_day": lambda r: D.frames_by_day(r, CFG, measure(r, target_rows=20)),
}


def wave(i):
    return 5.5 + (i * 37 % 300) / 100


def history(day_of, counts):
    rows = []
    for date, n in counts:
        step = 10.0 if n <= 144 else 1400 / n
        rows += [(0, ts, wave(len(rows) + i), float(i % 3 == 0))
                 for i, ts in enumerate(day_of(date, n, step))]
    return rows


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("counts, want", [
    ([(D1, 144), (D2, 144)], {D1: 132, D2: 144}),
    ([(D1, 144), (D2, 200)], {D1: 132, D2: 144}),
    ([(D1, 5), (D2, 144)], {D2: 137}),
    ([(D1, 12)], {}),
    ([(D1, 30), (D9, 20)], {D1: 18, D9: 20}),
])
def test_slice_sizes(make_readings, day_of, layout, counts, want):
    frames = LAYOUTS[layout](make_readings(history(day_of, counts)))
    rows = frames.slices(CFG).groupBy("d").agg(
        F.count("*").alias("n"), F.min("k"), F.max("k")).collect()
    assert {r.d: r.n for r in rows} == want
    assert all(r["min(k)"] == 0 and r["max(k)"] == r.n - 1 for r in rows)


@pytest.mark.parametrize("layout", LAYOUTS)
def test_after_a_gap_seed_and_lookback_are_the_last_rows(make_readings, day_of, layout):
    rows = history(day_of, [(D1, 30), (D9, 20)])
    frames = D.with_seed(LAYOUTS[layout](make_readings(rows)))
    first = lookback_mean(12)(frames).slices(CFG).where((F.col("k") == 0) & (F.col("d") == D9))
    row = first.first()
    assert (row.t_init, row.etat_init) == (rows[29][2], rows[29][3])
    units = [round(r[2] * 1e9) for r in rows[18:30]]
    assert row.t_int_pred == round(sum(units) / 12) / 1e9


def random_rows(seed, assets=4, dates=12):
    """Uneven days with empty dates, equal timestamps and one asset with most rows."""
    rng = random.Random(seed)
    rows = []
    for asset in range(assets):
        for date in range(dates):
            if rng.random() < 0.25:
                continue
            n = rng.choice([1, 2, 3, 5, 13, 40]) if asset else rng.choice([90, 170, 260])
            for _ in range(n):
                minute = rng.choice([0, 5, 5, 600]) if rng.random() < 0.2 else rng.uniform(0, 1439)
                ts = dt.datetime(2026, 2, 1) + dt.timedelta(days=date, minutes=minute)
                rows.append((asset, ts, round(rng.uniform(5.5, 8.5), 2),
                             float(rng.random() < 0.4)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_forecast_matches_brute_force_in_every_layout(make_readings, seed):
    readings = make_readings(random_rows(seed))
    want = {}
    for (asset, date), (positions, rows) in brute.slices(readings.collect()).items():
        for k, pos in enumerate(positions):
            before = rows[pos - 1]
            want[asset, date, k] = (rows[pos]["reading_id"], before["T_int"],
                                    before["Etat_Compresseur"], brute.mean_before(rows, pos))
    for name, layout in LAYOUTS.items():
        got = {(r.asset_id, r.d, r.k): (r.reading_id, r.t_init, r.etat_init, r.t_int_pred)
               for r in forecast(layout(readings), CFG).collect()}
        assert got == want, name


@pytest.mark.parametrize("seed", [3])
def test_positions_and_lags_agree(make_readings, seed):
    readings = make_readings(random_rows(seed))
    want = {}
    for rows in brute.ordered(readings.collect()).values():
        for pos, row in enumerate(rows):
            want[row["reading_id"]] = (pos, rows[pos - 1]["T_int"] if pos else None)
    ways = [ordering.positions_by_asset(readings), ordering.positions_by_range(readings)]
    ways += [ordering.positions_by_segment(readings, w) for w in (86_400, 3_600, 1)]
    for df in ways:
        got = {r.reading_id: (r.pos, r.T_int_lag_1) for r in df.collect()}
        assert got == want


def test_layout_follows_measured_sizes(make_readings, day_of):
    readings = make_readings(history(day_of, [(D1, 100), (D2, 60)]))
    assert measure(readings) == Layout(160, 100)
    assert measure(readings).by_asset and measure(readings).day_salts == 1
    large = measure(readings, target_rows=20)
    assert not large.by_asset and large.day_salts == 5 and large.segment_seconds == 3_600
    assert Layout(10**13, 10**12).segment_seconds == 1


def test_crowded_second_is_range_partitioned(make_readings):
    """A third of all rows in one second: no time segment can split it."""
    moment = dt.datetime(2026, 2, 1, 12)
    rows = [(0, moment, wave(i), 0.0) for i in range(600)]
    rows += [(0, dt.datetime(2026, 2, 1) + dt.timedelta(seconds=60 * i), wave(i), 1.0)
             for i in range(1_200)]
    readings = make_readings(rows)
    layout = measure(readings, target_rows=30)
    assert ordering._crowded(readings, layout)
    got = ordering.with_positions(readings, layout)
    assert "parquet" in got._jdf.queryExecution().analyzed().toString()
    assert sorted(r.pos for r in got.collect()) == list(range(1_800))
    want = {r.reading_id: r.pos for r in ordering.positions_by_asset(readings).collect()}
    assert {r.reading_id: r.pos for r in got.collect()} == want


def test_lookup_and_rejects_cover_all_requests(make_readings, day_of, spark):
    days = D.day_index(make_readings(history(day_of, [(D1, 20), (D2, 30)])))
    requests = spark.createDataFrame([(0, D1), (0, D9), (7, D1)], "asset_id long, d date")
    assert [tuple(r) for r in D.lookup_days(requests, days).collect()] == [(0, D1, 0, 19)]
    assert sorted(tuple(r) for r in D.reject_days(requests, days).collect()) == [(0, D9), (7, D1)]


def test_one_date_and_wanted_days_equal_the_full_run(make_readings):
    readings = make_readings(random_rows(5))
    power = PowerLine.fit(readings)
    columns = ("asset_id", "d", "k", "t_int_opt", "etat_opt", "pwr_opt", "pwr_pred_ia")
    full = twin_days(readings, CFG, power=power).select(*columns).collect()
    date = max(r.d for r in full)
    part = twin_date(readings, date, power, CFG).select(*columns).collect()
    assert sorted(part) == sorted(r for r in full if r.d == date)
    assert twin_date(readings, dt.date(1999, 1, 1), power, CFG).isEmpty()
    wanted = D.day_index(readings).where("asset_id = 1").select(*D.KEY)
    some = twin_days(readings, CFG, power=power, wanted=wanted).select(*columns).collect()
    assert sorted(some) == sorted(r for r in full if r.asset_id == 1)


def test_full_run_is_the_same_in_both_layouts(make_readings):
    readings = make_readings(random_rows(8))
    power = PowerLine.fit(readings)
    columns = ("asset_id", "d", "k", "t_int_opt", "etat_opt", "pente_chauffe", "pente_froid")
    results = [sorted(twin_from_frames(layout(readings), power, CFG).select(*columns).collect())
               for layout in LAYOUTS.values()]
    assert results[0] == results[1] == results[2] and results[0]
