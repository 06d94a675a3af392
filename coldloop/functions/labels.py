"""Text labels for energy, runtime and saving."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from coldloop.functions.numeric import half_even


def energy_label(kwh: Column) -> Column:
    return F.format_string("%.1f kWh", half_even(kwh, 1))


def minutes_label(minutes: Column) -> Column:
    return F.format_string("%d mn", minutes)


def signed_energy_label(kwh: Column) -> Column:
    """Negative numbers carry their own sign; everything else gets a plus."""
    return F.concat(F.when(kwh < 0, F.lit("")).otherwise(F.lit("+")), energy_label(kwh))
