"""The controller for several forecasts of the same rows at once.

Each forecast is a lane. What lanes share, the rows of a day in order, is grouped and sorted once;
slopes, their means and the controller's state are columns per lane, so the rows that are shuffled
are those of one run, however many forecasts are compared.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coldloop.config import TwinConfig
from coldloop.functions.numeric import TEMPERATURE_DIGITS, to_fixed
from coldloop.operators.control import next_state
from coldloop.operators.days import KEY


def with_lane_slopes(scored: DataFrame, lanes: Sequence[str],
                     cfg: TwinConfig = TwinConfig()) -> DataFrame:
    """Adds ``heat_<lane>`` and ``cool_<lane>``, the rolling slopes after each forecast ``<lane>``."""
    day = Window.partitionBy(*KEY).orderBy("k")
    so_far = day.rowsBetween(Window.unboundedPreceding, 0)
    recent = (Window.partitionBy(*KEY, "heating").orderBy("k")
              .rowsBetween(1 - cfg.slope_memory, 0))
    scale = 10 ** TEMPERATURE_DIGITS
    seed = to_fixed(F.col("t_init"), TEMPERATURE_DIGITS)
    units = {lane: to_fixed(F.col(lane), TEMPERATURE_DIGITS) for lane in lanes}
    rows = scored.withColumns({
        "heating": F.coalesce(F.col("Etat_Compresseur") == 0, F.lit(False)),
        **{f"slope_{lane}": u - F.when(F.col("k") == 0, seed).otherwise(F.lag(u).over(day))
           for lane, u in units.items()}})
    rows = rows.withColumns({f"mean_{lane}": F.try_divide(
        F.sum(f"slope_{lane}").over(recent).cast("double"),
        (F.count(f"slope_{lane}").over(recent) * scale).cast("double")) for lane in lanes})

    def carried(mean: str, condition: Column, default: float) -> Column:
        return F.coalesce(F.last(F.when(condition, F.col(mean)), ignorenulls=True).over(so_far),
                          F.lit(default))

    return rows.withColumns({
        **{f"heat_{lane}": carried(f"mean_{lane}", F.col("heating"), cfg.default_heating)
           for lane in lanes},
        **{f"cool_{lane}": carried(f"mean_{lane}", ~F.col("heating"), cfg.default_cooling)
           for lane in lanes},
    }).drop("heating", *(f"{part}_{lane}" for part in ("slope", "mean") for lane in lanes))


def replay_lanes(rows: DataFrame, lanes: Sequence[str], cfg: TwinConfig = TwinConfig()) -> DataFrame:
    """Adds ``opt_<lane>`` and ``state_<lane>``: the controller's temperature and state per lane.

    All lanes start from the seed reading. One fold per asset-day, of at most ``cfg.rows_per_day``
    rows, steps all of them.
    """
    rest = [c for c in rows.columns if c not in (*KEY, "k")]
    days = rows.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("k", *rest))).alias("rows"))
    fields = ",".join(f"opt_{lane}:double,state_{lane}:double" for lane in lanes)
    first = F.col("rows")[0]
    start = F.struct(
        *(first["t_init"].cast("double").alias(f"t_{lane}") for lane in lanes),
        *(first["etat_init"].cast("double").alias(f"s_{lane}") for lane in lanes),
        F.array().cast(f"array<struct<{fields}>>").alias("out"))

    def step(acc: Column, row: Column) -> Column:
        states = {lane: next_state(acc[f"t_{lane}"], acc[f"s_{lane}"], cfg) for lane in lanes}
        moved = {lane: acc[f"t_{lane}"] + F.when(state == 1, row[f"cool_{lane}"]).otherwise(
            row[f"heat_{lane}"]) for lane, state in states.items()}
        done = F.struct(*(part for lane in lanes for part in (
            acc[f"t_{lane}"].alias(f"opt_{lane}"), states[lane].alias(f"state_{lane}"))))
        return F.struct(*(moved[lane].alias(f"t_{lane}") for lane in lanes),
                        *(states[lane].alias(f"s_{lane}") for lane in lanes),
                        F.concat(acc["out"], F.array(done)).alias("out"))

    outcome = F.aggregate("rows", start, step, lambda acc: acc["out"])
    return (days.select(*KEY, F.inline(F.arrays_zip("rows", outcome.alias("outcome"))))
            .select(*KEY, "rows.*", "outcome.*"))
