"""Measured sizes that decide how the ordered operators split their work."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldloop.functions.calendar import epoch_micros

DAY_SECONDS = 86_400
# Segment widths tried, widest first (day, quarter day, hour, ... second).
SEGMENT_WIDTHS = (86_400, 21_600, 3_600, 600, 60, 10, 1)
TARGET_ROWS = 1_000_000


@dataclass(frozen=True)
class Layout:
    """Rows of the fullest asset and asset-day, and the splits that follow from them."""

    busiest_asset: int
    busiest_day: int
    target_rows: int = TARGET_ROWS

    @property
    def by_asset(self) -> bool:
        """Whether every asset's whole history fits one task's share of rows."""
        return self.busiest_asset <= self.target_rows

    @property
    def segment_seconds(self) -> int:
        return self.width_for(self.target_rows)

    def width_for(self, rows: int) -> int:
        """Widest segment that holds at most ``rows`` on the fullest day, if evenly spread."""
        for width in SEGMENT_WIDTHS:
            if self.busiest_day * width <= rows * DAY_SECONDS:
                return width
        return SEGMENT_WIDTHS[-1]

    @property
    def day_salts(self) -> int:
        """Parts of a crowded day that are ranked on their own first; 1 if none is crowded."""
        return max(1, min(4096, -(-self.busiest_day // self.target_rows)))


def segment(width: int) -> Column:
    """Number of the ``width``-second segment of its day a timestamp falls into."""
    second = F.floor(epoch_micros(F.col("timestamp")) / F.lit(1_000_000))
    return F.floor(F.pmod(second, F.lit(DAY_SECONDS)) / F.lit(width)).alias("segment")


def measure(readings: DataFrame, target_rows: int = TARGET_ROWS) -> Layout:
    """Count rows per asset-day (two columns read, pre-aggregated) and keep the maxima."""
    per_asset = readings.groupBy("asset_id", "d").count().groupBy("asset_id").agg(
        F.sum("count").alias("rows"), F.max("count").alias("day_rows"))
    asset, day = per_asset.agg(F.max("rows"), F.max("day_rows")).first()
    return Layout(asset or 0, day or 0, target_rows)
