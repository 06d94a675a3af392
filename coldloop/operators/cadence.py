"""Readings finer than the assumed cadence, and what the day cap leaves out of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldloop.config import READINGS_SCHEMA, TwinConfig
from coldloop.functions.calendar import EPOCH, epoch_micros
from coldloop.functions.numeric import POWER_DIGITS, TEMPERATURE_DIGITS, from_fixed, to_fixed

MEASURED = (("T_ext", TEMPERATURE_DIGITS), ("T_int", TEMPERATURE_DIGITS),
            ("Puissance_Elec_kW", POWER_DIGITS))


def to_cadence(readings: DataFrame, minutes: int = 10) -> DataFrame:
    """One reading per asset and window of ``minutes``, from all readings in it.

    Temperatures and power are means of the values there are, in whole units and so independent
    of the order of tasks; the state is the newest known one; the timestamp is the window's
    start and the id the smallest. A day then holds no more readings than the day cap.
    The grouping is pre-aggregated, so a busy window costs one row per task.
    """
    width = minutes * 60_000_000
    opened = F.timestamp_add("MICROSECOND", F.floor(
        epoch_micros(F.col("timestamp")) / F.lit(width)) * F.lit(width), F.expr(EPOCH))
    windows = readings.withColumn("opened", opened)
    means = {}
    for name, digits in MEASURED:
        units = to_fixed(F.col(name), digits)
        mean = F.rint(F.try_divide(F.sum(units).cast("double"), F.count(units).cast("double")))
        means[name] = from_fixed(mean, digits)
    known = F.when(F.col("Etat_Compresseur").isNotNull(), F.struct("timestamp", "reading_id"))
    return (
        windows.groupBy("asset_id", "opened").agg(
            F.min("reading_id").alias("reading_id"),
            *(mean.alias(name) for name, mean in means.items()),
            F.max_by("Etat_Compresseur", known).alias("Etat_Compresseur"))
        .withColumnRenamed("opened", "timestamp").select(*READINGS_SCHEMA.names)
        .withColumn("d", F.to_date("timestamp")))


def day_overflow(days: DataFrame, cfg: TwinConfig = TwinConfig()) -> DataFrame:
    """Readings per asset-day, those in its slice, and those beyond the cap."""
    start = F.greatest("first_pos", F.lit(cfg.lookback))
    available = F.greatest(F.col("last_pos") + 1 - start, F.lit(0))
    return days.select(
        "asset_id", "d", (F.col("last_pos") - F.col("first_pos") + 1).alias("readings"),
        F.least(available, F.lit(cfg.rows_per_day)).alias("in_slice"),
        F.greatest(available - cfg.rows_per_day, F.lit(0)).alias("beyond_cap"))
