"""Slopes and the controller on golden vectors, edge cases and random days."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from coldloop.config import TwinConfig
from coldloop.operators.control import replay, replay_long_days
from coldloop.operators.slopes import slope_degrees, with_rolling_slopes, with_slopes
from tests import brute

DAY = dt.date(2026, 5, 15)
SCHEMA = ("asset_id long, d date, k int, t_int_pred double, Etat_Compresseur double, "
          "t_init double, etat_init double")


def scored(spark, preds, recorded, t_init, etat_init, asset=0):
    rows = [(asset, DAY, k, p, s, t_init, etat_init)
            for k, (p, s) in enumerate(zip(preds, recorded, strict=True))]
    return spark.createDataFrame(rows, SCHEMA)


def run(df, cfg=TwinConfig(), how=replay):
    return how(with_rolling_slopes(with_slopes(df), cfg), cfg).orderBy("asset_id", "k").collect()


def test_published_vector(spark):
    df = scored(spark, [4.0, 3.8, 3.5, 3.2, 3.0], [0.0] * 5, 3.0, 0.0)
    rows = run(df)
    assert len(rows) == 5 and rows[0].etat_opt == 0.0
    got = [r.slope for r in slope_degrees(with_slopes(df)).orderBy("k").collect()]
    assert got == pytest.approx([1.0, -0.2, -0.3, -0.3, -0.2], abs=1e-9)
    assert [r.pente_chauffe for r in rows] == pytest.approx([1.0, 0.4, 1 / 6, 0.05, 0.0], abs=1e-9)
    assert [r.pente_froid for r in rows] == [-0.12] * 5
    sixth = 4.4 + 1 / 6
    assert [r.t_int_opt for r in rows] == pytest.approx([3.0, 4.0, 4.4, sixth, sixth + 0.05],
                                                        abs=1e-9)
    assert [r.etat_opt for r in rows] == [0.0] * 5


@pytest.mark.parametrize("start", [7.5, 6.7])
@pytest.mark.parametrize("state", [0.0, 1.0])
def test_thresholds_are_strict(spark, start, state):
    assert run(scored(spark, [7.0], [0.0], start, state))[0].etat_opt == state


def test_beyond_thresholds_switch(spark):
    assert run(scored(spark, [7.0], [0.0], 7.51, 0.0))[0].etat_opt == 1.0
    assert run(scored(spark, [7.0], [0.0], 6.69, 1.0))[0].etat_opt == 0.0


def test_memory_counts_qualifying_rows_only(spark):
    preds = [7.0 + 0.01 * k * k for k in range(30)]
    recorded = [float(k % 2) for k in range(30)]
    rows = run(scored(spark, preds, recorded, 7.0, 0.0))
    want = brute.control(preds, recorded, 7.0, 0.0)
    assert [r.pente_chauffe for r in rows] == pytest.approx([w[2] for w in want], abs=1e-9)
    assert [r.pente_froid for r in rows] == pytest.approx([w[3] for w in want], abs=1e-9)


def test_defaults_and_unknown_states(spark):
    cooling_only = run(scored(spark, [7.0, 7.1], [1.0, 2.0], 7.2, 0.0))
    assert [r.pente_chauffe for r in cooling_only] == [0.04, 0.04]
    assert cooling_only[1].pente_froid == pytest.approx((-0.2 + 0.1) / 2, abs=1e-9)
    heating_only = run(scored(spark, [7.0, 7.1], [0.0, 0.0], 7.2, 0.0))
    assert [r.pente_froid for r in heating_only] == [-0.12, -0.12]
    unknown = run(scored(spark, [7.0, 7.1], [None, None], 7.2, 0.0))
    assert [r.pente_chauffe for r in unknown] == [0.04, 0.04]


def test_missing_temperature_holds_the_state(spark):
    rows = run(scored(spark, [None, 7.0], [0.0, 0.0], None, 1.0))
    assert [r.etat_opt for r in rows] == [1.0, 1.0]
    assert [r.t_int_opt for r in rows] == [None, None]
    gap = run(scored(spark, [7.0, None, 7.2], [0.0] * 3, 7.0, 0.0))
    assert [r.pente_chauffe for r in gap] == [0.0, 0.0, 0.0]


def test_random_days_match_brute_force_both_ways(spark):
    rng = random.Random(3)
    days = None
    want = {}
    for asset in range(6):
        n = rng.choice([1, 2, 11, 40, 144])
        preds = [round(rng.uniform(5.5, 8.5), 2) for _ in range(n)]
        recorded = [float(rng.random() < 0.4) for _ in range(n)]
        start, state = round(rng.uniform(5, 9), 2), float(rng.random() < 0.5)
        want[asset] = brute.control(preds, recorded, start, state)
        df = scored(spark, preds, recorded, start, state, asset)
        days = df if days is None else days.unionAll(df)
    expected = [row for asset in sorted(want) for row in want[asset]]
    for how in (replay, replay_long_days):
        rows = run(days, how=how)
        got = [(r.t_int_opt, r.etat_opt, r.pente_chauffe, r.pente_froid) for r in rows]
        assert len(got) == len(expected)
        for g, w in zip(got, expected, strict=True):
            assert g == pytest.approx(w, abs=1e-9)


def test_long_days_take_the_linear_path(spark):
    cfg = TwinConfig(rows_per_day=5_000)
    n = 1_500
    preds = [7.0 + 0.5 * ((k * 37) % 11 - 5) / 5 for k in range(n)]
    recorded = [float(k % 3 == 0) for k in range(n)]
    out = replay(with_rolling_slopes(with_slopes(scored(spark, preds, recorded, 7.0, 0.0)), cfg),
                 cfg)
    assert "FlatMapGroupsInPandas" in out._jdf.queryExecution().executedPlan().toString()
    rows = out.orderBy("k").collect()
    want = brute.control(preds, recorded, 7.0, 0.0)
    assert [r.t_int_opt for r in rows] == pytest.approx([w[0] for w in want], abs=1e-6)
    assert out.where(~F.col("etat_opt").isin(0.0, 1.0)).isEmpty()
