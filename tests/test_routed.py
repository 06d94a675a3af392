"""Each asset by its own plan: one hot asset among small ones."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from coldloop.config import TwinConfig
from coldloop.operators import days as D
from coldloop.operators.routed import extended, summarise
from coldloop.operators.scorers import PowerLine
from coldloop.plans.twin import twin_date, twin_days, twin_from_frames, twin_routed

CFG = TwinConfig()
COLUMNS = ("asset_id", "d", "k", "timestamp", "t_int_pred", "pwr_pred_ia", "t_int_opt", "etat_opt", "pwr_opt")


@pytest.fixture
def fleet(make_readings):
    """Asset 0 has most rows, many of them in one second; the others are sparse, one a single row."""
    rng, rows = random.Random(4), []
    for date in range(4):
        day = dt.datetime(2026, 4, 1) + dt.timedelta(days=date)
        for _ in range(400):
            at = day + dt.timedelta(seconds=rng.choice([5, rng.randrange(86_400)]))
            rows.append((0, at, rng.uniform(5, 9), float(rng.random() < .4), rng.uniform(0, 40)))
        for asset in range(1, 6):
            for _ in range(rng.randrange(0, 30)):
                rows.append((asset, day + dt.timedelta(seconds=rng.randrange(86_400)), rng.uniform(5, 9),
                             rng.choice([0.0, 1.0, None]), rng.choice([None, rng.uniform(0, 40)])))
    rows.append((7, dt.datetime(2026, 4, 2), None, None, None))
    return make_readings(rows).persist()


def whole(readings):
    return sorted(twin_from_frames(D.frames_by_asset(readings, CFG), PowerLine.fit(readings), CFG)
                  .select(*COLUMNS).collect(), key=str)


@pytest.mark.parametrize("target", [1, 90, 300, 1_000, 10**6])
def test_any_target_gives_the_same_twin(fleet, target):
    got = sorted(twin_routed(fleet, summarise(fleet, target), CFG).select(*COLUMNS).collect(), key=str)
    assert got == whole(fleet)


def test_small_assets_keep_their_plan_beside_a_large_one(fleet):
    frames = summarise(fleet, 1_000).frames(fleet, CFG)
    assert [f.keys for f in frames] == [("asset_id",), D.KEY]
    assert {r[0] for r in frames[0].df.select("asset_id").distinct().collect()} == {1, 2, 3, 4, 5, 7}
    assert {r[0] for r in frames[1].df.select("asset_id").distinct().collect()} == {0}


def test_the_summary_holds_index_and_lines(fleet):
    summary = summarise(fleet, 50)
    assert sorted(summary.index().collect()) == sorted(D.day_index(fleet).collect())
    got = {r.line: r for r in summary.power_lines().lines.collect()}
    want = {r.line: r for r in PowerLine.fit(fleet).lines.collect()}
    assert got.keys() == want.keys() == {False, True}
    for line in want:
        assert got[line].slope == pytest.approx(want[line].slope, rel=1e-9)
        assert got[line].intercept == pytest.approx(want[line].intercept, rel=1e-9)


def test_lines_of_close_values_far_from_zero(make_readings):
    """Sums of squares would lose these digits; merged moments keep them."""
    rows = [(i % 2, dt.datetime(2026, 4, 1 + i % 3, i % 24), 1e5 + i % 7 * 1e-3, 1.0, 2e5 + i % 7 * 3e-3)
            for i in range(300)]
    readings = make_readings(rows)
    line = summarise(readings).power_lines().lines.collect()
    assert len(line) == 1 and line[0].slope == pytest.approx(3.0, rel=1e-6)


def test_no_readings(make_readings):
    empty = make_readings([(1, dt.datetime(2026, 4, 1), 7.0, 0.0)]).where("asset_id > 1")
    assert twin_days(empty).collect() == []
    one = make_readings([(1, dt.datetime(2026, 4, 1), 7.0, 0.0)])
    assert twin_days(one).select(F.count("*")).first()[0] == 0


@pytest.mark.parametrize("cut", ["reading_id % 3 = 0", "d < date'2026-04-03'", "asset_id = 0", "asset_id > 90"])
def test_readings_added_later_give_the_same_summary(fleet, cut):
    """Whole days, new assets, and days that were there already."""
    grown = extended(summarise(fleet.where(cut)), fleet.where(f"NOT ({cut})"))
    assert sorted(grown.index().collect()) == sorted(D.day_index(fleet).collect())
    got = {r.line: r for r in grown.power_lines().lines.collect()}
    for want in PowerLine.fit(fleet).lines.collect():
        assert got[want.line].slope == pytest.approx(want.slope, rel=1e-9)
        assert got[want.line].intercept == pytest.approx(want.intercept, rel=1e-9)
    again = extended(grown, fleet.where("asset_id > 90"))
    assert sorted(again.index().collect()) == sorted(grown.index().collect())


def test_a_stored_index_answers_a_date_as_counting_does(fleet):
    summary, day = summarise(fleet), dt.date(2026, 4, 3)
    columns = [c for c in COLUMNS if not c.startswith("pwr")]
    one = twin_date(fleet, day, summary.power_lines(), CFG, index=summary.index()).select(*columns)
    other = twin_date(fleet, day, summary.power_lines(), CFG).select(*columns)
    assert sorted(one.collect(), key=str) == sorted(other.collect(), key=str) != []
    unknown = dt.date(2030, 1, 1)
    assert twin_date(fleet, unknown, summary.power_lines(), CFG, index=summary.index()).isEmpty()
