"""Observed slopes of the forecast and their rolling means per compressor state."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coldloop.config import TwinConfig
from coldloop.functions.numeric import TEMPERATURE_DIGITS, from_fixed, to_fixed
from coldloop.operators.days import KEY


def with_slopes(scored: DataFrame) -> DataFrame:
    """Adds ``slope_units`` and ``heating``; the first slope starts at the seed reading."""
    day = Window.partitionBy(*KEY).orderBy("k")
    forecast = to_fixed(F.col("t_int_pred"), TEMPERATURE_DIGITS)
    before = F.when(F.col("k") == 0, to_fixed(F.col("t_init"), TEMPERATURE_DIGITS)).otherwise(
        F.lag(forecast).over(day))
    return scored.withColumns({
        "slope_units": forecast - before,
        "heating": F.coalesce(F.col("Etat_Compresseur") == 0, F.lit(False)),
    })


def slope_degrees(df: DataFrame) -> DataFrame:
    return df.withColumn("slope", from_fixed(F.col("slope_units"), TEMPERATURE_DIGITS))


def with_rolling_slopes(df: DataFrame, cfg: TwinConfig = TwinConfig()) -> DataFrame:
    """Adds ``pente_chauffe`` and ``pente_froid``: means of the last qualifying slopes.

    The frame counts rows of one state only; the other state's rows carry the last mean
    forward, and the defaults stand in before the first qualifying row.
    """
    recent = (Window.partitionBy(*KEY, "heating").orderBy("k")
              .rowsBetween(1 - cfg.slope_memory, 0))
    so_far = (Window.partitionBy(*KEY).orderBy("k")
              .rowsBetween(Window.unboundedPreceding, 0))
    scale = 10 ** TEMPERATURE_DIGITS
    mean = F.try_divide(F.sum("slope_units").over(recent).cast("double"),
                        (F.count("slope_units").over(recent) * scale).cast("double"))

    def carried(condition, default):
        return F.coalesce(
            F.last(F.when(condition, F.col("mean_slope")), ignorenulls=True).over(so_far),
            F.lit(default))

    return df.withColumn("mean_slope", mean).withColumns({
        "pente_chauffe": carried(F.col("heating"), cfg.default_heating),
        "pente_froid": carried(~F.col("heating"), cfg.default_cooling),
    }).drop("mean_slope")
