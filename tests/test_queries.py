"""Every registered query against its DuckDB statement, bit for bit, and the plans' shape."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry_point
from coldloop.plans import oracle
from coldloop.plans.queries import QUERIES
from tests.compare import difference, duckdb_tables

SF_DIR = "/root/testdata/sf0.001"
ORACLE = oracle.oracle_sql()
ROWS_ONLY = {"thermal_ml", "energy_ml"}
from coldloop.config import TwinConfig
from coldloop.operators import days as D
from coldloop.operators.routed import summarise
from coldloop.operators.scorers import PowerLine
from coldloop.plans.twin import twin_from_frames, twin_routed
from coldloop.sources.readings import read_events

CFG = TwinConfig()


@pytest.fixture(scope="module")
def tables():
    return duckdb_tables(SF_DIR)


def test_only_trained_models_lack_a_statement():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equal_results(spark, tables, name):
    df = QUERIES[name](spark, SF_DIR)
    assert difference(df.toPandas(), tables.execute(ORACLE[name]).df()) is None
    text = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|NestedLoop", text)


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).count() > 0


def plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_twin_shuffles_each_reading_once_and_stays_in_the_jvm(spark):
    text = plan(QUERIES["twin_day"](spark, SF_DIR))
    exchanges = re.findall(r"Exchange hashpartitioning\((\w+?)#", text)
    assert exchanges.count("asset_id") == 1 and len(exchanges) == 2  # readings; power lines
    assert not re.search("Python|Pandas|Cartesian|NestedLoop", text)
    schema = re.search(r"ReadSchema: (struct<\S+>)", text).group(1)
    assert "props" not in schema


def scans(text: str) -> list[str]:
    return re.findall(r"Scan parquet.*?ReadSchema: (struct<\S*>)", text, re.DOTALL)


def test_split_twin_finds_both_ends_of_days_in_one_scan(spark):
    source = read_events(spark, SF_DIR)
    summary = summarise(source)
    summary = summarise(source, summary.layout.busiest_day)  # large assets, days within a task
    now = plan(twin_routed(source, summary, CFG))
    before = plan(twin_from_frames(D.frames_by_day(source, CFG), PowerLine.fit(source), CFG))
    assert len(re.findall(r"WindowGroupLimit.*row_number\(\), 156, Partial", now)) == 1
    assert not re.search("Python|Pandas|Cartesian|NestedLoop", now)
    assert len(scans(before)) >= 4 and sum("event_type" in s for s in scans(now)) == 1

    def shuffles(text):
        return len(re.findall(r"(?<!Reused)Exchange hashpartitioning", text))
    assert shuffles(now) < shuffles(before)


def test_crowded_days_are_cut_before_the_shuffle(spark):
    text = plan(QUERIES["twin_day_split"](spark, SF_DIR))
    assert len(re.findall(r"WindowGroupLimit.*row_number\(\), 156, Partial", text)) == 2  # salted
    assert sum("event_type" in s for s in scans(text)) == 1  # the other one reads two columns
    assert not re.search("Python|Pandas|Cartesian|NestedLoop", text)


def test_latest_date_reads_a_bounded_time_range(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 3_000)  # show whole filter lists
    text = plan(QUERIES["twin_latest_date"](spark, SF_DIR))
    bounded = [s for s in re.findall(r"PushedFilters: (\[.*?\])", text)
               if "GreaterThanOrEqual(ts" in s and "LessThan(ts" in s]
    assert bounded and len(bounded) == sum("event_type" in s for s in scans(text))
