"""Pages by rank and by cursor against one sorted list."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import types as T

from coldloop.operators.pages import Cursor, PageIndex, following
from coldloop.operators.tables import newest_first
from coldloop.session import scratch_path

SCHEMA = "timestamp string, part long, value double"


@pytest.fixture
def table(spark):
    """Many rows of one timestamp, repeated rows, nulls and NaN; ``part`` clashes with the index."""
    rows = [("2024-01-02 00:00:00", i % 7, i % 5 + 0.5) for i in range(90)]
    rows += [(f"2024-01-{i % 9 + 1:02d} 00:00:00", i, -0.5 * i) for i in range(60)]
    rows += [(None, 1, 1.0), (None, None, None), (None, None, None), ("2024-01-05 00:00:00", 3, None),
             ("2024-01-05 00:00:00", 3, float("nan")), ("2024-01-05 00:00:00", 3, float("nan"))]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def plain(rows):
    return [str(tuple(row)) for row in rows]


@pytest.mark.parametrize("parts", [1, 6, None])
def test_pages_by_rank_are_the_sorted_table(spark, table, parts):
    index = PageIndex.build(table, scratch_path(spark, "pages"), parts)
    again = PageIndex(spark, index.path)
    want = plain(newest_first(table).collect())
    got = [plain(again.page(i, 7).collect()) for i in range(again.pages(7))]
    assert index.rows == again.rows == len(want) == 156
    assert got == [want[i:i + 7] for i in range(0, len(want), 7)]
    assert again.page(10_000, 7).collect() == [] and again.page(0, 7).columns == table.columns


def test_a_deep_page_reads_only_the_parts_that_hold_it(spark):
    rows = spark.range(0, 20_000, 1, 8).selectExpr("cast(id as string) AS timestamp", "id % 3 AS x")
    index = PageIndex.build(rows, scratch_path(spark, "pages"), 20)
    assert len(index.parts) == 20
    page = index.page(700, 20)
    want = sorted((str(i) for i in range(20_000)), reverse=True)[14_000:14_020]
    assert [row.timestamp for row in page.collect()] == want
    text = page._jdf.queryExecution().executedPlan().toString()
    read = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", text).group(1)
    assert re.search(r"part#\d+ (= \d+|IN \(\d+(,\d+)?\))", read), read


def test_an_empty_table_has_no_pages(spark):
    index = PageIndex.build(spark.createDataFrame([], SCHEMA), scratch_path(spark, "pages"))
    assert index.pages() == 0 and index.page(0).collect() == []


@pytest.mark.parametrize("size", [1, 7, 40])
def test_cursors_lose_and_repeat_nothing(spark, table, size):
    table = table.coalesce(1).persist()
    want, got, cursor = plain(newest_first(table).collect()), [], None
    want = want if size > 1 else want[-12:]
    if size == 1:  # the last rows only: nulls, with a repeated one
        table = table.where("timestamp is null or timestamp <= '2024-01-01 12'").persist()
        want = plain(newest_first(table).collect())
    for _ in range(200):
        shown = following(table, cursor, size).collect()
        if not shown:
            break
        got, cursor = got + plain(shown), Cursor.after(shown, cursor)
    assert got == want
    assert Cursor.after([], cursor) == cursor and Cursor.after([]) is None


def test_cursor_filter_can_reach_the_scan(spark, table):
    path = scratch_path(spark, "table")
    table.write.parquet(path)
    stored = spark.read.parquet(path)
    cursor = Cursor.after(following(stored, None, 30).collect())
    text = following(stored, cursor)._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(timestamp" in text


def test_one_column_is_a_table_too(spark):
    rows = spark.createDataFrame([("b",), ("a",), ("b",), ("c",)], T.StructType(
        [T.StructField("timestamp", T.StringType())]))
    first = following(rows, None, 2).collect()
    assert [r.timestamp for r in following(rows, Cursor.after(first), 5).collect()] == ["b", "a"]
