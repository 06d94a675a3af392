"""Temperature and power scorers.

A thermal scorer is a function from frames to frames with ``t_int_pred``; a power scorer
predicts kW from a temperature column and a state column.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coldloop.functions.numeric import (
    POWER_DIGITS, TEMPERATURE_DIGITS, finite_or_null, from_fixed, half_even, to_fixed,
)
from coldloop.operators.days import Frames

ThermalScorer = Callable[[Frames], Frames]


def reaching(scorer: ThermalScorer, steps: int) -> ThermalScorer:
    """Declares how many earlier readings a scorer looks back on, so that frames hold them."""
    scorer.reach = steps
    return scorer


def lookback_mean(steps: int = 12, recency: bool = False,
                  out: str = "t_int_pred") -> ThermalScorer:
    """Mean of the previous ``steps`` temperatures, rounded half-even to billionths.

    With ``recency`` the newest reading weighs ``steps`` times as much as the oldest. Without it,
    missing temperatures are left out.
    """
    def score(frames: Frames) -> Frames:
        reading = to_fixed(F.col("T_int"), TEMPERATURE_DIGITS)
        if recency:
            value = F.lit(0).cast("bigint")
            for age in range(1, steps + 1):
                value = value + F.lag(reading, age).over(frames.order) * (steps + 1 - age)
            mean = value / F.lit(steps * (steps + 1) // 2)
        else:
            before = frames.order.rowsBetween(-steps, -1)
            mean = F.try_divide(F.sum(reading).over(before), F.count(reading).over(before))
        return frames.with_columns({out: from_fixed(F.rint(mean), TEMPERATURE_DIGITS)})
    return reaching(score, steps)


def array_mean_udf(steps: int = 12) -> ThermalScorer:
    """The same forecast as ``lookback_mean`` through the user-code hook: a pandas UDF.

    Every row is scored: missing temperatures reach the function as NaN, and it returns NaN,
    here null, where it has nothing to average.
    """
    scale = 10.0 ** TEMPERATURE_DIGITS

    @F.pandas_udf("double")
    def mean(values: pd.Series) -> pd.Series:
        units = [np.rint(v[~np.isnan(v)] * scale) for v in values]
        return pd.Series([np.rint(u.sum() / len(u)) / scale if len(u) else np.nan for u in units])

    def score(frames: Frames) -> Frames:
        reading = F.coalesce("T_int", F.lit(float("nan")))
        before = F.collect_list(reading).over(frames.order.rowsBetween(-steps, -1))
        return frames.with_columns({"before": before}).with_columns(
            {"t_int_pred": finite_or_null(mean("before"))}).map(lambda df: df.drop("before"))
    return reaching(score, steps)


def running(state: Column) -> Column:
    return F.coalesce(state == 1, F.lit(False))


def power_units(col: Column) -> Column:
    return to_fixed(col, POWER_DIGITS)


class PowerScorer:
    """Adds a predicted power column from a temperature and a state column."""

    def apply(self, df: DataFrame, temperature: str, state: str, out: str) -> DataFrame:
        raise NotImplementedError


@dataclass
class PowerLine(PowerScorer):
    """One straight line of power over temperature for each compressor state."""

    lines: DataFrame

    @classmethod
    def fit(cls, readings: DataFrame) -> PowerLine:
        power, temperature = F.col("Puissance_Elec_kW"), F.col("T_int")
        return cls(
            readings.groupBy(running(F.col("Etat_Compresseur")).alias("line"))
            .agg(F.regr_slope(power, temperature).alias("slope"),
                 F.regr_intercept(power, temperature).alias("intercept")))

    def apply(self, df: DataFrame, temperature: str, state: str, out: str) -> DataFrame:
        """The lines are at most two rows (grouped by a boolean), so they are broadcast."""
        power = F.col("slope") * F.col(temperature) + F.col("intercept")
        return (
            df.withColumn("line", running(F.col(state)))
            .join(F.broadcast(self.lines), "line", "left")
            .withColumn(out, half_even(power, POWER_DIGITS))
            .drop("line", "slope", "intercept")
        )


@dataclass
class LeafMeans(PowerScorer):
    """Mean power per state and temperature bin, at several nested bin widths.

    A stand-in for trees of a given depth: the first split is the state, each further
    level halves the range of temperatures seen when fitting. Temperatures outside fall into the
    outer bins, an empty leaf takes the mean of its state, and an unknown temperature gives null.
    """

    leaves: DataFrame
    depths: tuple[int, ...]
    low: float
    high: float

    @staticmethod
    def _bin(temperature: Column, bins: int, low: float, high: float) -> Column:
        at = F.floor((temperature - F.lit(low)) * F.lit(float(bins))
                     / F.lit(high - low if high > low else 1.0))
        return F.when(temperature.isNotNull(), F.greatest(F.least(at, F.lit(bins - 1)), F.lit(0)))

    @classmethod
    def fit(cls, readings: DataFrame, depths: tuple[int, ...] = (3, 5, 7, 9)) -> LeafMeans:
        finest = 2 ** (max(depths) - 1)
        known = readings.where("T_int is not null and Puissance_Elec_kW is not null")
        low, high = known.agg(F.min("T_int"), F.max("T_int")).first()
        low, high = low or 0.0, high or 0.0
        power = to_fixed(F.col("Puissance_Elec_kW"), POWER_DIGITS)
        bins = known.groupBy(
            running(F.col("Etat_Compresseur")).alias("line"),
            cls._bin(F.col("T_int"), finest, low, high).alias("bin")
        ).agg(F.sum(power).alias("units"), F.count("*").alias("n"))
        # At most 2 x finest rows from here on: every leaf with its ancestors' means.
        grid = readings.sparkSession.range(2 * finest).select(
            (F.col("id") >= finest).alias("line"), (F.col("id") % finest).alias("bin"))
        leaves = grid.join(bins, ["line", "bin"], "left")
        scale = F.lit(float(10 ** POWER_DIGITS))
        whole = Window.partitionBy("line")
        fallback = F.sum("units").over(whole) / F.sum("n").over(whole)
        means = {}
        for depth in depths:
            leaf = Window.partitionBy(
                "line", F.floor(F.col("bin") / F.lit(finest // 2 ** (depth - 1))))
            mean = F.sum("units").over(leaf) / F.sum("n").over(leaf)
            means[f"depth_{depth}"] = F.coalesce(mean, fallback) / scale
        return cls(leaves.select("line", "bin", *(c.alias(n) for n, c in means.items())),
                   tuple(depths), low, high)

    def apply(self, df: DataFrame, temperature: str, state: str, out: str) -> DataFrame:
        """Adds ``<out>_<depth>`` for every depth, with one broadcast of the leaf table."""
        finest = 2 ** (max(self.depths) - 1)
        leaves = self.leaves.select(
            "line", "bin",
            *(F.col(f"depth_{d}").alias(f"{out}_{d}") for d in self.depths))
        return (
            df.withColumn("line", running(F.col(state)))
            .withColumn("bin", self._bin(F.col(temperature), finest, self.low, self.high))
            .join(F.broadcast(leaves), ["line", "bin"], "left")
            .drop("line", "bin")
        )


@dataclass
class ModelPower(PowerScorer):
    """A fitted Spark ML pipeline over (temperature, state)."""

    model: object

    def apply(self, df: DataFrame, temperature: str, state: str, out: str) -> DataFrame:
        inputs = df.withColumns({"model_T_int": F.col(temperature), "model_state": F.col(state)})
        scored = self.model.transform(inputs)
        known = F.col("model_T_int").isNotNull() & F.col("model_state").isNotNull()
        return (
            scored.withColumn(out, F.when(known, finite_or_null(F.col("prediction"))))
            .drop("model_T_int", "model_state", "power_inputs", "prediction")
        )
