"""Position and previous value of every reading in its asset's time order.

Assets of a measured, moderate size take one window each. Where an asset is too large for
one task, rows are numbered inside small time segments, and each segment learns from
counts alone where it starts. Should a single segment still be too full (many rows in one second), the rows
are range-partitioned instead, which splits any run of rows, equal timestamps included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coldloop.operators.layout import DAY_SECONDS, Layout, measure, segment
from coldloop.session import scratch_path

# A segment may exceed the target by this factor before rows are range-partitioned.
CROWDED = 16


def with_positions(readings: DataFrame, layout: Layout | None = None) -> DataFrame:
    """Adds ``pos`` (from 0, per asset) and ``T_int_lag_1`` to every reading."""
    layout = layout or measure(readings)
    if layout.by_asset:
        return positions_by_asset(readings)
    if layout.segment_seconds < DAY_SECONDS and _crowded(readings, layout):
        return positions_by_range(readings)
    return positions_by_segment(readings, layout.segment_seconds)


def positions_by_asset(readings: DataFrame) -> DataFrame:
    order = Window.partitionBy("asset_id").orderBy("timestamp", "reading_id")
    return readings.withColumns({
        "pos": (F.row_number().over(order) - 1).cast("bigint"),
        "T_int_lag_1": F.lag("T_int").over(order)})


def _crowded(readings: DataFrame, layout: Layout) -> bool:
    segments = readings.groupBy("asset_id", "d", segment(layout.segment_seconds)).count()
    return segments.agg(F.max("count")).first()[0] > CROWDED * layout.target_rows


def positions_by_segment(readings: DataFrame, width: int) -> DataFrame:
    rows = readings.withColumn("segment", segment(width))
    segments = rows.groupBy("asset_id", "d", "segment").agg(
        F.count("*").alias("n"),
        F.max_by("T_int", F.struct("timestamp", "reading_id")).alias("last_value"),
    )
    days = segments.groupBy("asset_id", "d").agg(
        F.sum("n").alias("n"), F.max_by("last_value", "segment").alias("last_value"))

    by_date = Window.partitionBy("asset_id").orderBy("d")
    by_segment = Window.partitionBy("asset_id", "d").orderBy("segment")
    before = (Window.unboundedPreceding, -1)
    days = days.select(
        "asset_id", "d",
        F.coalesce(F.sum("n").over(by_date.rowsBetween(*before)), F.lit(0)).alias("day_start"),
        F.lag("last_value").over(by_date).alias("day_previous"),
    )
    starts = (
        segments
        .withColumn("offset", F.coalesce(
            F.sum("n").over(by_segment.rowsBetween(*before)), F.lit(0)))
        .withColumn("previous", F.lag("last_value").over(by_segment))
        .join(days, ["asset_id", "d"])
        .select(
            "asset_id", "d", "segment",
            (F.col("day_start") + F.col("offset")).alias("start"),
            F.when(F.col("offset") == 0, F.col("day_previous"))
            .otherwise(F.col("previous")).alias("before_start"),
        )
    )
    in_segment = Window.partitionBy("asset_id", "d", "segment").orderBy("timestamp", "reading_id")
    return (
        rows
        .withColumn("rank", F.row_number().over(in_segment))
        .withColumn("previous", F.lag("T_int").over(in_segment))
        .join(starts, ["asset_id", "d", "segment"])
        .withColumn("pos", F.col("start") + F.col("rank") - 1)
        .withColumn("T_int_lag_1", F.when(F.col("rank") == 1, F.col("before_start"))
                    .otherwise(F.col("previous")))
        .drop("segment", "rank", "previous", "start", "before_start")
    )


def positions_by_range(readings: DataFrame) -> DataFrame:
    """The same result by a global sort; the sorted rows are written once.

    Row ids of a sorted table are only meaningful for one physical layout, so both uses
    of it (counting and numbering) read the written copy.
    """
    order = ("asset_id", "timestamp", "reading_id")
    path = scratch_path(SparkSession.active(), "ordered-readings")
    (readings.repartitionByRange(*order).sortWithinPartitions(*order)
     .withColumn("row", F.monotonically_increasing_id())
     .write.parquet(path))
    rows = (
        readings.sparkSession.read.parquet(path)
        .withColumn("part", F.shiftright("row", 33))
    )
    runs = rows.groupBy("asset_id", "part").agg(
        F.min("row").alias("first_row"), F.count("*").alias("n"),
        F.max_by("T_int", "row").alias("last_value"))
    by_part = Window.partitionBy("asset_id").orderBy("part")
    runs = runs.select(
        "asset_id", "part", "first_row",
        F.coalesce(F.sum("n").over(by_part.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("start"),
        F.lag("last_value").over(by_part).alias("before_start"),
    )
    in_run = Window.partitionBy("asset_id", "part").orderBy("row")
    return (
        rows.withColumn("previous", F.lag("T_int").over(in_run))
        .join(runs, ["asset_id", "part"])
        .withColumn("pos", F.col("row") - F.col("first_row") + F.col("start"))
        .withColumn("T_int_lag_1", F.when(F.col("row") == F.col("first_row"),
                                          F.col("before_start")).otherwise(F.col("previous")))
        .drop("row", "part", "previous", "first_row", "start", "before_start")
    )
