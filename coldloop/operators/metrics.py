"""Counts and timings of a scoring run."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def run_counts(scored: DataFrame) -> DataFrame:
    """Rows and asset-days scored, and the model calls they took.

    A day is scored once for temperature and twice for power (forecast and controller).
    """
    return scored.agg(
        F.count("t_int_pred").alias("rows_scored"),
        F.count(F.when(F.col("k") == 0, 1)).alias("days_scored"),
    ).select("rows_scored", "days_scored", F.col("days_scored").alias("thermal_calls"),
             (2 * F.col("days_scored")).alias("power_calls"))


def timed_run(scored: DataFrame, variant: str) -> DataFrame:
    """Runs the scoring and reports its counts, elapsed seconds and a load stamp.

    ``loaded_at`` stamps the model pair that ``variant`` names, as the day cache does.
    """
    observation = Observation("scoring")
    observed = scored.observe(
        observation,
        F.count("t_int_pred").alias("rows_scored"),
        F.count(F.when(F.col("k") == 0, 1)).alias("days_scored"),
    )
    begin = time.perf_counter()
    observed.write.format("noop").mode("overwrite").save()
    elapsed = time.perf_counter() - begin
    seen = observation.get
    row = (variant, seen["rows_scored"], seen["days_scored"], elapsed)
    return scored.sparkSession.createDataFrame(
        [row], "variant string, rows_scored long, days_scored long, elapsed_seconds double"
    ).withColumn("loaded_at", F.current_timestamp())
