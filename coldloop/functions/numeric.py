"""Column helpers for order-independent arithmetic and half-even rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Slopes are summed in billionths of a degree and energy in millionths of a kW, as whole
# numbers, so no result depends on the order in which tasks add them up.
TEMPERATURE_DIGITS = 9
POWER_DIGITS = 6


def finite_or_null(col: Column) -> Column:
    """NaN and infinities are no measurements."""
    return F.when(~F.isnan(col) & (F.abs(col) < float("inf")), col)


def half_even(col: Column, digits: int) -> Column:
    scale = F.lit(float(10 ** digits))
    return F.rint(col * scale) / scale


def to_fixed(col: Column, digits: int) -> Column:
    """In whole units; null where they exceed 64 bits."""
    return F.rint(col * F.lit(float(10 ** digits))).try_cast("bigint")


def from_fixed(col: Column, digits: int) -> Column:
    return col.cast("double") / F.lit(float(10 ** digits))
