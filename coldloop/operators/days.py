"""Day index, day slices and the earlier rows each day borrows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from coldloop.config import TwinConfig
from coldloop.operators.layout import Layout, measure, segment

KEY = ("asset_id", "d")
# Ranges of dates that one scan is filtered by.
MAX_RANGES = 50


@dataclass(frozen=True)
class Frames:
    """Day slices together with the readings before them.

    ``k`` numbers a slice from 0; rows that only serve as context have a ``k`` outside
    it. ``keys`` are the columns within which ``pos`` has no gap before a slice row, so
    windows over earlier rows partition by them.
    """

    df: DataFrame
    keys: tuple[str, ...]
    #: Rows before a slice row that are sure to be there; None: all of the asset's.
    reach: int | None = None

    @property
    def order(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy("timestamp", "reading_id")

    def map(self, change: Callable[[DataFrame], DataFrame]) -> Frames:
        return Frames(change(self.df), self.keys, self.reach)

    def with_columns(self, columns: dict[str, Column]) -> Frames:
        return self.map(lambda df: df.withColumns(columns))

    def slices(self, cfg: TwinConfig) -> DataFrame:
        return self.df.where(F.col("k").between(0, cfg.rows_per_day - 1))


def day_index(readings: DataFrame) -> DataFrame:
    """First and last position per asset and date, from counts only."""
    by_date = Window.partitionBy("asset_id").orderBy("d")
    before = F.sum("n").over(by_date.rowsBetween(Window.unboundedPreceding, -1))
    return (
        readings.groupBy(*KEY).agg(F.count("*").alias("n"))
        .withColumn("first_pos", F.coalesce(before, F.lit(0)))
        .select(*KEY, "first_pos", (F.col("first_pos") + F.col("n") - 1).alias("last_pos"))
    )


def lookup_days(requests: DataFrame, days: DataFrame) -> DataFrame:
    """Requested asset-days that exist, with their positions."""
    return requests.join(days, list(KEY))


def reject_days(requests: DataFrame, days: DataFrame) -> DataFrame:
    """Requested asset-days that have no reading."""
    return requests.join(days, list(KEY), "left_anti")


def end_rows(readings: DataFrame, n: int, newest: bool = False, salts: int = 1) -> DataFrame:
    """The first (or last) ``n`` readings of each asset-day, ranked from 1.

    Spark applies the rank limit before the shuffle, so a map task sends at most ``n``
    rows per asset-day. ``salts`` > 1 adds a round that splits crowded days first.
    """
    order = [F.col("timestamp"), F.col("reading_id")]
    if newest:
        order = [c.desc() for c in order]
    if salts > 1:
        part = F.pmod(F.xxhash64("reading_id"), F.lit(salts))
        by_part = Window.partitionBy(*KEY, "part").orderBy(*order)
        readings = (
            readings.withColumn("part", part)
            .withColumn("rank", F.row_number().over(by_part))
            .where(F.col("rank") <= n).drop("part", "rank")
        )
    by_day = Window.partitionBy(*KEY).orderBy(*order)
    return readings.withColumn("rank", F.row_number().over(by_day)).where(F.col("rank") <= n)


def borrowed_days(days: DataFrame, rows: int) -> DataFrame:
    """For each day the earlier days that hold its ``rows`` preceding readings.

    Every date holds a reading at least, so ``rows`` earlier dates are enough.
    """
    earlier = Window.partitionBy("asset_id").orderBy("d").rowsBetween(-rows, -1)
    listed = days.withColumn("earlier", F.collect_list(F.struct(
        F.col("d").alias("source_d"), F.col("last_pos").alias("source_last"))).over(earlier))
    near = F.filter("earlier", lambda s: s["source_last"] >= F.col("first_pos") - rows)
    return listed.select(*KEY, "first_pos", F.inline(near))


def day_frames(readings: DataFrame, cfg: TwinConfig = TwinConfig(),
               layout: Layout | None = None, wanted: DataFrame | None = None) -> Frames:
    """Frames of every asset-day, or of those ``wanted``.

    Assets of moderate size are ordered as a whole, which shuffles each row once. Larger
    ones, and requests for some days, are split by day.
    """
    layout = layout or measure(readings)
    if layout.by_asset and wanted is None:
        return frames_by_asset(readings, cfg)
    return frames_by_day(readings, cfg, layout, wanted)


def frames_by_asset(readings: DataFrame, cfg: TwinConfig = TwinConfig()) -> Frames:
    """Every window here and in the scorers shares one sort by asset and time."""
    frames = Frames(readings, ("asset_id",))
    so_far = frames.order.rowsBetween(Window.unboundedPreceding, 0)
    frames = frames.with_columns({
        "pos": (F.row_number().over(frames.order) - 1).cast("bigint"),
        "same_day": F.col("d").eqNullSafe(F.lag("d").over(frames.order)),
    })
    first_pos = F.last(F.when(~F.col("same_day"), F.col("pos")), ignorenulls=True).over(so_far)
    k = F.col("pos") - F.greatest(first_pos, F.lit(cfg.lookback))
    return frames.with_columns({"k": k.cast("int")}).map(lambda df: df.drop("same_day"))


def frames_by_day(readings: DataFrame, cfg: TwinConfig = TwinConfig(),
                  layout: Layout | None = None, wanted: DataFrame | None = None) -> Frames:
    """Each day's slice with a copy of the readings before it, in one bounded group."""
    layout = layout or measure(readings)
    days = day_index(readings)
    sources = borrowed_days(days, cfg.context_rows)
    heads, tails = day_ends(readings, cfg, layout)
    if wanted is not None:
        sources = sources.join(wanted, list(KEY), "left_semi")
        heads = heads.join(wanted, list(KEY), "left_semi")
        tails = tails.join(
            sources.select("asset_id", F.col("source_d").alias("d")), list(KEY), "left_semi")
    heads = end_rows(heads, cfg.head_rows, salts=layout.day_salts)
    tails = end_rows(tails, cfg.context_rows, newest=True, salts=layout.day_salts)
    return assemble(heads, tails, days, sources, cfg)


def day_ends(readings: DataFrame, cfg: TwinConfig, layout: Layout) -> tuple[DataFrame, DataFrame]:
    """Rows that can be among a day's first or last ones, judged from counts.

    On days above the target size, counts per time segment tell which segments hold the
    ends, so the other rows are dropped in the scan's stage instead of being sorted there.
    Smaller days pass whole.
    """
    if layout.day_salts == 1:
        return readings, readings
    width, bounds = end_bounds(readings, cfg, layout)
    marked = readings.withColumn("segment", segment(width)).join(bounds, list(KEY), "left")
    whole = F.col("last_head").isNull()
    heads = marked.where(whole | (F.col("segment") <= F.col("last_head")))
    tails = marked.where(whole | (F.col("segment") >= F.col("first_tail")))
    extra = ("segment", "last_head", "first_tail")
    return heads.drop(*extra), tails.drop(*extra)


def end_bounds(readings: DataFrame, cfg: TwinConfig, layout: Layout) -> tuple[int, DataFrame]:
    """Per day above the target size the segments, of a common width, within which its ends lie."""
    width = layout.width_for(100 * cfg.head_rows)
    in_day = Window.partitionBy(*KEY)
    earlier = in_day.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    counts = readings.groupBy(*KEY, segment(width)).agg(F.count("*").alias("n")).withColumns({
        "before": F.coalesce(F.sum("n").over(earlier), F.lit(0)),
        "total": F.sum("n").over(in_day)})
    after = F.col("total") - F.col("before") - F.col("n")
    bounds = (
        counts.where(F.col("total") > layout.target_rows).groupBy(*KEY).agg(
            F.max(F.when(F.col("before") < cfg.head_rows, F.col("segment"))).alias("last_head"),
            F.min(F.when(after < cfg.context_rows, F.col("segment"))).alias("first_tail"))
    )
    return width, bounds


def assemble(heads: DataFrame, tails: DataFrame, days: DataFrame, sources: DataFrame,
             cfg: TwinConfig) -> Frames:
    own = (
        heads.join(days.drop("last_pos"), list(KEY))
        .withColumn("pos", F.col("first_pos") + F.col("rank") - 1)
        .drop("rank")
    )
    borrowed = (
        tails.withColumnRenamed("d", "source_d")
        .join(sources, ["asset_id", "source_d"])
        .withColumn("pos", F.col("source_last") - F.col("rank") + 1)
        .where(F.col("pos") >= F.col("first_pos") - cfg.context_rows)
        .drop("rank", "source_d", "source_last")
    )
    start = F.greatest(F.col("first_pos"), F.lit(cfg.lookback))
    rows = (
        own.unionByName(borrowed)
        .withColumn("k", (F.col("pos") - start).cast("int"))
        .drop("first_pos")
    )
    return Frames(rows, KEY, cfg.context_rows - 1)


def with_lag_feature(frames: Frames) -> Frames:
    return frames.with_columns({"T_int_lag_1": F.lag("T_int").over(frames.order)})


def with_seed(frames: Frames) -> Frames:
    """Recorded temperature and state of the reading before each row.

    On a slice's first row these are the values the controller starts from.
    """
    return frames.with_columns({
        "t_init": F.lag("T_int").over(frames.order),
        "etat_init": F.lag("Etat_Compresseur").over(frames.order)})


def frames_for_date(readings: DataFrame, day: dt.date, cfg: TwinConfig = TwinConfig(),
                    layout: Layout | None = None, index: DataFrame | None = None) -> Frames:
    """Frames of one date over all assets, reading only the dates they need.

    The borrowed dates come from the index of the dates up to this one, which is counted unless a
    stored ``index`` is given. The scan is bounded by
    literals that reach the Parquet reader: a range per run of borrowed dates, so one asset with
    very old readings does not open all the time between.
    """
    ts, opening, closing = F.col("timestamp"), _midnight(day), _midnight(day + dt.timedelta(days=1))
    days = (day_index(readings.where(ts < closing)) if index is None
            else index.where(F.col("d") <= F.lit(day)))
    is_day = F.col("d") == F.lit(day)
    sources = borrowed_days(days, cfg.context_rows).where(is_day)
    # One row per calendar date that some asset borrows from.
    dates = sorted(r.source_d for r in sources.select("source_d").distinct().collect())
    part = readings.where(_in_dates([*dates, day]))
    salts = (layout or measure(part)).day_salts
    heads = end_rows(part.where(ts >= opening), cfg.head_rows, salts=salts)
    borrowed = sources.select("asset_id", F.col("source_d").alias("d"))
    tails = part.where(ts < opening).join(borrowed, list(KEY), "left_semi")
    tails = end_rows(tails, cfg.context_rows, newest=True, salts=salts)
    return assemble(heads, tails, days.where(is_day), sources, cfg)


def _in_dates(dates: list[dt.date]) -> Column:
    """A filter on the timestamp for sorted dates, neighbours as one range.

    With more than ``MAX_RANGES`` ranges it is one range; it only prunes what is read.
    """
    one = dt.timedelta(days=1)
    ranges: list[list[dt.date]] = []
    for date in dates:
        if ranges and date <= ranges[-1][1]:
            ranges[-1][1] = max(ranges[-1][1], date + one)
        else:
            ranges.append([date, date + one])
    if len(ranges) > MAX_RANGES:
        ranges = [[ranges[0][0], ranges[-1][1]]]
    ts = F.col("timestamp")
    return reduce(Column.__or__, ((ts >= _midnight(a)) & (ts < _midnight(b)) for a, b in ranges))


def _midnight(day: dt.date) -> Column:
    """A zone-less literal; a datetime literal would pass through the session's zone."""
    return F.lit(f"{day} 00:00:00").cast("timestamp_ntz")
