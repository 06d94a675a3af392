"""One stored summary of a table of readings, and the plan that it chooses for each asset.

The summary has a row per asset-day: counts, positions and the moments that power lines are fitted
on. It is written once; the day index, the choice of plan and the lines are read from it. Assets
that fit one task's share are ordered as a whole. The days of larger ones are split: both ends of
a day are found in one scan and one exchange, in which a map task sends at most a day's opening
rows, and go to the days that hold or borrow them. A large asset changes nothing for the others.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coldloop.config import TwinConfig
from coldloop.functions.calendar import epoch_micros
from coldloop.operators.days import KEY, Frames, borrowed_days, end_bounds, frames_by_asset
from coldloop.operators.layout import TARGET_ROWS, Layout, segment
from coldloop.operators.scorers import PowerLine, running
from coldloop.session import scratch_path

LINES = (False, True)
LOWEST = -(2 ** 63) + 1


def moments(line: bool) -> list[Column]:
    """Count, means, spread and product of temperature and power of the readings of one line."""
    both = (F.col("T_int") + F.col("Puissance_Elec_kW")).isNotNull()
    mine = both & (running(F.col("Etat_Compresseur")) == line)
    x, y = (F.when(mine, F.col(name)) for name in ("T_int", "Puissance_Elec_kW"))
    n = F.count(x)
    return [part.alias(f"{name}_{int(line)}") for name, part in (
        ("n", n), ("x", F.avg(x)), ("y", F.avg(y)),
        ("xx", F.var_pop(x) * n), ("xy", F.covar_pop(x, y) * n))]


@dataclass(frozen=True)
class Summary:
    """Asset-days with ``n``, ``first_pos``, ``last_pos``, ``asset_rows`` and moments, stored."""

    days: DataFrame
    layout: Layout

    def routed(self, large: bool) -> DataFrame:
        return self.days.where((F.col("asset_rows") > self.layout.target_rows) == large)

    def index(self) -> DataFrame:
        return self.days.select(*KEY, "first_pos", "last_pos")

    def power_lines(self) -> PowerLine:
        """Lines of power over temperature, from the moments of all asset-days."""
        parts = F.array(*(
            F.struct(F.lit(line).alias("line"), *(
                F.col(f"{name}_{int(line)}").alias(name) for name in ("n", "x", "y", "xx", "xy")))
            for line in LINES))
        rows = self.days.select(F.inline(parts)).where("n > 0")
        n = F.sum("n")
        means = rows.groupBy("line").agg((F.sum(F.col("n") * F.col("x")) / n).alias("mean_x"),
                                         (F.sum(F.col("n") * F.col("y")) / n).alias("mean_y"))
        off_x, off_y = F.col("x") - F.col("mean_x"), F.col("y") - F.col("mean_y")
        merged = rows.join(F.broadcast(means), "line").groupBy("line", "mean_x", "mean_y").agg(
            F.sum(F.col("xx") + F.col("n") * off_x * off_x).alias("xx"),
            F.sum(F.col("xy") + F.col("n") * off_x * off_y).alias("xy"))
        slope = F.when(F.col("xx") > 0, F.col("xy") / F.col("xx"))
        return PowerLine(merged.select(
            "line", slope.alias("slope"),
            (F.col("mean_y") - slope * F.col("mean_x")).alias("intercept")))

    def frames(self, readings: DataFrame, cfg: TwinConfig = TwinConfig()) -> list[Frames]:
        """Frames of the assets that fit a task and of those that do not; a kind without assets
        is left out, so an even fleet is scanned once here."""
        sides = {row["large"] for row in self.days.select(
            (F.col("asset_rows") > self.layout.target_rows).alias("large")).distinct().collect()}
        if len(sides) < 2:
            return [self._split(readings, cfg) if True in sides else frames_by_asset(readings, cfg)]
        large = self.routed(True).select("asset_id").distinct()
        return [frames_by_asset(readings.join(large, "asset_id", "left_anti"), cfg),
                self._split(readings.join(large, "asset_id", "left_semi"), cfg)]

    def _split(self, readings: DataFrame, cfg: TwinConfig) -> Frames:
        days = self.routed(True).select(*KEY, "first_pos", "last_pos")
        ends = day_ends(readings, cfg, self.layout)
        # A day's last rows are borrowed by as many later days as there are such rows at most.
        borrowers = (
            borrowed_days(days, cfg.context_rows).groupBy("asset_id", F.col("source_d").alias("d"))
            .agg(F.collect_list(F.struct("d", "first_pos")).alias("borrowers")))
        table = days.join(borrowers, list(KEY), "left")
        at_end = F.col("last_pos") - F.col("rank") + 1
        own = F.array(F.struct(
            F.col("d"), F.col("first_pos"), (F.col("first_pos") + F.col("rank") - 1).alias("pos")))
        copies = F.filter(
            F.transform("borrowers", lambda b: F.struct(b["d"], b["first_pos"], at_end.alias("pos"))),
            lambda c: c["pos"] >= c["first_pos"] - cfg.context_rows)
        columns = [c for c in readings.columns if c != "d"]
        rows = ends.join(table, list(KEY)).select(
            *columns, F.inline(F.when(F.col("newest"), copies).otherwise(own)))
        k = F.col("pos") - F.greatest("first_pos", F.lit(cfg.lookback))
        return Frames(rows.withColumn("k", k.cast("int")).drop("first_pos"), KEY, cfg.context_rows - 1)


def day_ends(readings: DataFrame, cfg: TwinConfig, layout: Layout) -> DataFrame:
    """Each asset-day's first rows and, ``newest``, its last ones, ranked from its ends.

    A reading takes part in both searches; Spark cuts either before the exchange.
    """
    roles = readings.withColumn("newest", F.explode(F.array(F.lit(False), F.lit(True))))
    if layout.day_salts > 1:
        width, bounds = end_bounds(readings, cfg, layout)
        marked = roles.withColumn("segment", segment(width)).join(bounds, list(KEY), "left")
        inside = F.when(F.col("newest"), F.col("segment") >= F.col("first_tail")).otherwise(
            F.col("segment") <= F.col("last_head"))
        roles = marked.where(F.coalesce(inside, F.lit(True))).drop("segment", "last_head", "first_tail")
    sign = F.when(F.col("newest"), -1).otherwise(1).cast("long")
    order = [sign * epoch_micros(F.col("timestamp")),
             sign * F.coalesce("reading_id", F.lit(LOWEST))]

    def ranked(rows: DataFrame, *parts: str) -> DataFrame:
        ends = Window.partitionBy(*KEY, "newest", *parts).orderBy(*order)
        return rows.withColumn("rank", F.row_number().over(ends)).where(
            F.col("rank") <= max(cfg.head_rows, cfg.context_rows))

    if layout.day_salts > 1:
        salt = F.pmod(F.xxhash64("reading_id"), F.lit(layout.day_salts))
        roles = ranked(roles.withColumn("part", salt), "part").drop("part", "rank")
    return ranked(roles).where(
        F.col("rank") <= F.when(F.col("newest"), cfg.context_rows).otherwise(cfg.head_rows))


def summarise(readings: DataFrame, target_rows: int = TARGET_ROWS) -> Summary:
    """Writes the summary, which takes one scan of the readings, and measures it."""
    return stored(counted(readings), target_rows)


def extended(summary: Summary, added: DataFrame) -> Summary:
    """The summary with more readings, of which alone are read; earlier ones are not again.

    Asset-days that get readings have their counts and moments merged: exactly, as spreads are kept
    about their own means.
    """
    fresh = counted(added)
    both = summary.days.select(*fresh.columns).unionByName(fresh)
    day = Window.partitionBy(*KEY)
    sums = [F.sum("n").alias("n")]
    for line in LINES:
        n, x, y, xx, xy = (f"{name}_{int(line)}" for name in ("n", "x", "y", "xx", "xy"))
        total = F.sum(n).over(day)
        both = both.withColumns({
            f"mean_{x}": F.try_divide(F.sum(F.col(n) * F.col(x)).over(day), total),
            f"mean_{y}": F.try_divide(F.sum(F.col(n) * F.col(y)).over(day), total)})
        off_x, off_y = F.col(x) - F.col(f"mean_{x}"), F.col(y) - F.col(f"mean_{y}")
        sums += [F.sum(n).alias(n), F.first(f"mean_{x}").alias(x), F.first(f"mean_{y}").alias(y),
                 F.sum(F.col(xx) + F.col(n) * off_x * off_x).alias(xx),
                 F.sum(F.col(xy) + F.col(n) * off_x * off_y).alias(xy)]
    return stored(both.groupBy(*KEY).agg(*sums), summary.layout.target_rows)


def counted(readings: DataFrame) -> DataFrame:
    return readings.groupBy(*KEY).agg(
        F.count("*").alias("n"), *(m for line in LINES for m in moments(line)))


def stored(counts: DataFrame, target_rows: int) -> Summary:
    """Counts with positions, written to the shared folder."""
    spark, path = counts.sparkSession, scratch_path(counts.sparkSession, "summary")
    asset = Window.partitionBy("asset_id")
    earlier = asset.orderBy("d").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    days = counts.withColumns({
        "first_pos": first, "last_pos": first + F.col("n") - 1, "asset_rows": F.sum("n").over(asset)})
    days.write.parquet(path)
    table = spark.read.schema(days.schema).parquet(path)
    largest, day = table.agg(F.max("asset_rows"), F.max("n")).first()
    return Summary(table, Layout(largest or 0, day or 0, target_rows))
