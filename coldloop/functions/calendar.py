"""Time expressions on zone-less timestamps."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def to_naive_timestamp(col: Column) -> Column:
    return col.cast("timestamp_ntz")


def epoch_micros(col: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.expr(EPOCH), col)


def timestamp_text(col: Column) -> Column:
    """Date and time; a fraction of a second appears only where there is one."""
    return F.replace(F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit(".000000"), F.lit(""))


def date_text(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd")


def date_label(col: Column) -> Column:
    return F.date_format(col, "dd/MM/yyyy")


def cyclic_features(ts: Column) -> dict[str, Column]:
    """Sine and cosine of the time of day and of the day of the year."""
    day = F.lit(2 * math.pi) * F.dayofyear(ts) / F.lit(365)
    hour = F.lit(2 * math.pi) * (F.hour(ts) * 60 + F.minute(ts)) / F.lit(1440)
    return {
        "day_sin": F.sin(day), "day_cos": F.cos(day),
        "hour_sin": F.sin(hour), "hour_cos": F.cos(hour),
    }
