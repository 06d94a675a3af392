"""Energy and runtime figures, switch events and the series behind the charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coldloop.config import TwinConfig
from coldloop.functions import labels
from coldloop.functions.numeric import POWER_DIGITS
from coldloop.operators.days import KEY
from coldloop.operators.scorers import power_units

FIGURES = ("real_kwh", "pred_kwh", "opt_kwh", "real_minutes", "pred_minutes", "opt_minutes",
           "saving_kwh")


def _figures(total, cfg: TwinConfig, optimise: bool) -> dict[str, Column]:
    """KPI columns from a summing function (an aggregate or a running window).

    Predicted runtime equals the recorded one: the power model is given recorded states.
    """
    def kwh(col: str) -> Column:
        kilowatts = F.coalesce(total(power_units(F.col(col))), F.lit(0)).cast("double")
        return kilowatts / F.lit(float(10 ** POWER_DIGITS)) * F.lit(cfg.minutes_per_row / 60)

    def minutes(col: str) -> Column:
        on = F.when(F.col(col) == 1, 1).otherwise(0)
        return F.coalesce(total(on), F.lit(0)) * cfg.minutes_per_row

    figures = {
        "real_kwh": kwh("Puissance_Elec_kW"),
        "pred_kwh": kwh("pwr_pred_ia"),
        "opt_kwh": kwh("pwr_opt") if optimise else F.lit(0.0),
        "real_minutes": minutes("Etat_Compresseur"),
        "pred_minutes": minutes("Etat_Compresseur"),
        "opt_minutes": minutes("etat_opt") if optimise else F.lit(0).cast("bigint"),
    }
    return figures


def _with_saving(df: DataFrame) -> DataFrame:
    return df.withColumn("saving_kwh", F.col("opt_kwh") - F.col("real_kwh"))


def kpis(df: DataFrame, keys=KEY, cfg: TwinConfig = TwinConfig(),
         optimise: bool = True) -> DataFrame:
    """Totals per group; with ``optimise`` off the optimised figures are zero."""
    figures = _figures(F.sum, cfg, optimise)
    return _with_saving(df.groupBy(*keys).agg(*(c.alias(n) for n, c in figures.items())))


def running_kpis(df: DataFrame, cfg: TwinConfig = TwinConfig(),
                 optimise: bool = True) -> DataFrame:
    """Totals over the first ``n`` rows of each day, for n = 0 .. rows of the day.

    Nothing is shown at 0, and once started at least two rows are, so n = 1 repeats n = 2.
    """
    shown = Window.partitionBy(*KEY).orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    figures = _figures(lambda c: F.sum(c).over(shown), cfg, optimise)
    totals = _with_saving(df.select(*KEY, "k", *(c.alias(n) for n, c in figures.items())))
    following = Window.partitionBy(*KEY).orderBy("k")
    first = F.col("k") == 0
    totals = totals.select(*KEY, "k", *(
        F.when(first, F.coalesce(F.lead(n).over(following), F.col(n)))
        .otherwise(F.col(n)).alias(n) for n in FIGURES))
    ticks = F.when(first, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.col("k") + 1))
    return (
        totals.withColumn("n", F.explode(ticks))
        .select(*KEY, "n", *(
            F.when(F.col("n") == 0, F.lit(0)).otherwise(F.col(n)).alias(n) for n in FIGURES))
    )


def kpi_labels(totals: DataFrame) -> DataFrame:
    return totals.select(
        *KEY,
        labels.energy_label(F.col("real_kwh")).alias("real_energy"),
        labels.minutes_label(F.col("real_minutes")).alias("real_time"),
        labels.energy_label(F.col("pred_kwh")).alias("pred_energy"),
        labels.minutes_label(F.col("pred_minutes")).alias("pred_time"),
        labels.energy_label(F.col("opt_kwh")).alias("opt_energy"),
        labels.minutes_label(F.col("opt_minutes")).alias("opt_time"),
        labels.signed_energy_label(F.col("saving_kwh")).alias("saving"),
    )


def switch_events(df: DataFrame, optimise: bool = True) -> DataFrame:
    """Rows where a compressor state rises (ON) or falls (OFF) within the day."""
    day = Window.partitionBy(*KEY).orderBy("k")

    def change(state: str) -> Column:
        return F.coalesce(F.col(state) - F.lag(state).over(day), F.lit(0.0))

    series = [("real", "Etat_Compresseur", "T_int")]
    if optimise:
        series.append(("opt", "etat_opt", "t_int_opt"))
    marked = df.withColumns({f"{name}_change": change(state) for name, state, _ in series})
    entries = F.array(*(
        F.struct(F.lit(name).alias("series"), F.col(f"{name}_change").alias("change"),
                 F.col(value).alias("temperature")) for name, _, value in series))
    return (
        marked.select(*KEY, "k", "timestamp", F.inline(entries))
        .where(F.col("change").isin(1.0, -1.0))
        .select(*KEY, "k", "timestamp", "series",
                F.when(F.col("change") == 1, "ON").otherwise("OFF").alias("event"),
                "temperature")
    )


def day_series(df: DataFrame, cfg: TwinConfig = TwinConfig(), optimise: bool = True) -> DataFrame:
    """The columns behind the weather, temperature and power charts."""
    def if_on(name: str) -> Column:
        return (F.col(name) if optimise else F.lit(None).cast("double")).alias(name)

    return df.select(
        *KEY, "k", "timestamp", "T_ext", F.lit(cfg.setpoint).alias("setpoint"), "T_int",
        "t_int_pred", if_on("t_int_opt"), "Puissance_Elec_kW", "pwr_pred_ia", if_on("pwr_opt"))
