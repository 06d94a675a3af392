"""Figures, labels, events, tables and rounding on small days."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from coldloop.config import TwinConfig
from coldloop.functions.numeric import half_even, finite_or_null
from coldloop.operators import kpi, tables
from coldloop.operators.scorers import LeafMeans, PowerLine
from coldloop.sources.readings import normalise

CFG = TwinConfig()
DAY = dt.date(2026, 5, 15)
SCHEMA = ("asset_id long, d date, k int, timestamp timestamp_ntz, T_ext double, T_int double, "
          "Etat_Compresseur double, Puissance_Elec_kW double, t_int_pred double, "
          "pwr_pred_ia double, t_int_opt double, etat_opt double, pwr_opt double, "
          "pente_chauffe double, pente_froid double")


@pytest.fixture
def day(spark):
    recorded = [0.0, 1.0, 1.0, 0.0, None]
    optimised = [1.0, 1.0, 0.0, 0.0, 1.0]
    power = [1.5, 30.0, None, 2.0, 1.0]
    rows = [(0, DAY, k, dt.datetime(2026, 5, 15, 0, 10 * k), 20.0, 7.0 + k / 10, recorded[k],
             power[k], 7.0, 10.0 + k, 6.9 + k / 10, optimised[k], 5.0 + k, 0.04, -0.12)
            for k in range(5)]
    return spark.createDataFrame(rows, SCHEMA)


def test_totals(day):
    row = kpi.kpis(day, cfg=CFG).first()
    assert row.real_kwh == pytest.approx(34.5 / 6) and row.pred_kwh == pytest.approx(60 / 6)
    assert row.opt_kwh == pytest.approx(35 / 6)
    assert (row.real_minutes, row.pred_minutes, row.opt_minutes) == (20, 20, 30)
    assert row.saving_kwh == pytest.approx(0.5 / 6)


def test_disabled_optimisation_saves_minus_the_recorded_energy(day):
    row = kpi.kpis(day, cfg=CFG, optimise=False).first()
    assert (row.opt_kwh, row.opt_minutes, row.saving_kwh) == (0.0, 0, -row.real_kwh)
    assert kpi.day_series(day, CFG, optimise=False).where("t_int_opt is not null").isEmpty()
    assert kpi.switch_events(day, optimise=False).where("series = 'opt'").isEmpty()


def test_running_totals_start_empty_and_end_at_the_day(day):
    rows = {r.n: r for r in kpi.running_kpis(day, CFG).collect()}
    assert sorted(rows) == [0, 1, 2, 3, 4, 5]
    assert (rows[0].real_kwh, rows[0].opt_minutes) == (0.0, 0)
    assert rows[1][3:] == rows[2][3:]
    assert tuple(rows[5][3:]) == tuple(kpi.kpis(day, cfg=CFG).first()[2:])
    alone = kpi.running_kpis(day.where("k = 0"), CFG).collect()
    assert {r.n: r.real_kwh for r in alone} == {0: 0.0, 1: pytest.approx(1.5 / 6)}


def test_no_rows_give_no_groups_and_null_power_counts_as_zero(day):
    assert kpi.kpis(day.where("k > 9"), cfg=CFG).isEmpty()
    assert kpi.kpis(day.where("k = 2"), cfg=CFG).first().real_kwh == 0.0


def test_switch_events(day):
    rows = kpi.switch_events(day).orderBy("series", "k").collect()
    assert [(r.series, r.k, r.event) for r in rows] == [
        ("opt", 2, "OFF"), ("opt", 4, "ON"), ("real", 1, "ON"), ("real", 3, "OFF")]
    assert rows[0].temperature == pytest.approx(7.1)
    assert rows[2].temperature == pytest.approx(7.1)


def test_labels(spark):
    df = spark.createDataFrame(
        [(0, DAY, 12.25, 1.0, 12.0, 70, 70, 0, -0.25), (1, DAY, 8.0, 8.0, 12.0, 0, 0, 10, 4.0),
         (2, DAY, 1.0, 1.0, 1.0, 0, 0, 0, 0.0)],
        "asset_id long, d date, real_kwh double, pred_kwh double, opt_kwh double, "
        "real_minutes long, pred_minutes long, opt_minutes long, saving_kwh double")
    rows = kpi.kpi_labels(df).orderBy("asset_id").collect()
    assert rows[0].real_energy == "12.2 kWh" and rows[0].real_time == "70 mn"
    assert [r.saving for r in rows] == ["-0.2 kWh", "+4.0 kWh", "+0.0 kWh"]
    label = tables.day_labels(df).first()
    assert (label.label, label.axis_start, label.axis_end) == (
        "15/05/2026", "2026-05-15 00:00:00", "2026-05-16 00:00:00")


def test_rounding_goes_to_even(spark):
    values = [0.125, 0.375, 7.245, -0.125, 2.675]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(half_even(F.col("x"), 2)).collect()]
    assert got == [round(v * 100) / 100 for v in values]


def test_nan_becomes_null_and_text_is_parsed(spark):
    df = spark.createDataFrame(
        [(0, 1, "2026-05-15 00:10:00", float("nan"), 7.0, 1.0, 2.0),
         (0, 2, None, 1.0, 7.0, 1.0, 2.0)],
        "asset_id long, reading_id long, timestamp string, T_ext double, T_int double, "
        "Etat_Compresseur double, Puissance_Elec_kW double")
    rows = normalise(df).collect()
    assert len(rows) == 1 and rows[0].T_ext is None
    assert rows[0].timestamp == dt.datetime(2026, 5, 15, 0, 10) and rows[0].d == DAY
    assert df.select(finite_or_null(F.col("T_ext"))).first()[0] is None


def test_table_is_newest_first_rounded_by_type_and_paged(day):
    stored = tables.optimisation_rows(
        day.withColumn("pente_chauffe", F.lit(0.123456)).withColumn("t_int_opt", F.lit(6.98765)))
    shown = tables.rounded(tables.newest_first(stored)).collect()
    assert [r.timestamp for r in shown] == sorted((r.timestamp for r in shown), reverse=True)
    assert shown[0].timestamp == "2026-05-15 00:40:00"
    assert (shown[0].t_int_opt, shown[0].pente_chauffe) == (6.99, 0.1235)
    assert [r.timestamp for r in tables.page(stored, 1, size=2).collect()] == [
        "2026-05-15 00:20:00", "2026-05-15 00:10:00"]


def test_records_round_trip(day):
    records = tables.to_records(day, ["asset_id", "d"])
    back = tables.from_records(records, day.schema)
    assert sorted(back.collect(), key=lambda r: r.k) == sorted(day.collect(), key=lambda r: r.k)


def test_power_line_and_leaf_means(make_readings):
    stamps = [dt.datetime(2026, 5, 15) + dt.timedelta(minutes=i) for i in range(40)]
    rows = [(0, ts, 6.0 + (i % 20) / 10, float(i >= 20), (3.0 if i >= 20 else 0.5) * (i % 20) + 1)
            for i, ts in enumerate(stamps)]
    readings = make_readings(rows)
    line = PowerLine.fit(readings).apply(readings, "T_int", "Etat_Compresseur", "p")
    assert line.where(F.abs(F.col("p") - F.col("Puissance_Elec_kW")) > 1e-6).isEmpty()
    leaves = LeafMeans.fit(readings, (1, 3))
    assert leaves.leaves.count() == 8
    got = leaves.apply(readings, "T_int", "Etat_Compresseur", "p").collect()
    for state in (0.0, 1.0):
        powers = [r.Puissance_Elec_kW for r in got if r.Etat_Compresseur == state]
        means = [r.p_1 for r in got if r.Etat_Compresseur == state]
        assert means == pytest.approx([sum(powers) / len(powers)] * len(means))
    # The range seen is 6.0 to 7.9, so the coldest of four bins ends at 6.475.
    coldest = [r for r in got if r.T_int < 6.475 and r.Etat_Compresseur == 1.0]
    assert coldest[0].p_3 == pytest.approx(
        sum(r.Puissance_Elec_kW for r in coldest) / len(coldest))
    beyond = readings.select(F.lit(99.0).alias("t"), F.lit(1.0).alias("s"), "reading_id").limit(1)
    assert leaves.apply(beyond, "t", "s", "p").first().p_3 is not None
