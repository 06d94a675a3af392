"""Feature scaling and lookback sequences."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coldloop.config import FEATURES, TwinConfig
from coldloop.operators.days import KEY, Frames
from coldloop.sources.readings import with_time_features

SCALER_SCHEMA = "feature string, mean double, std double"
# Below this spread a feature counts as constant.
CONSTANT = 1e-9


@dataclass(frozen=True)
class Scaler:
    """Mean and population standard deviation of each feature, as fitted constants."""

    mean: dict[str, float]
    std: dict[str, float]

    @classmethod
    def fit(cls, readings: DataFrame) -> Scaler:
        """One aggregated row of means and deviations.

        The lag feature holds every indoor temperature but each asset's last, so it is
        measured on the readings themselves and no row has to be ordered.
        """
        stamp = F.struct("timestamp", "reading_id")
        last = readings.groupBy("asset_id").agg(F.max(stamp).alias("last"))
        rows = with_time_features(readings).join(last, "asset_id").withColumn(
            "T_int_lag_1", F.when(stamp != F.col("last"), F.col("T_int")))
        found = rows.agg(*(measure(F.col(name)).alias(f"{name}_{part}") for name in FEATURES
                           for part, measure in (("mean", F.avg), ("std", F.stddev_pop)))).first()
        return cls({name: found[f"{name}_mean"] or 0.0 for name in FEATURES},
                   {name: found[f"{name}_std"] or 0.0 for name in FEATURES})

    def apply(self, df: DataFrame) -> DataFrame:
        """Replaces each feature by (x - mean) / std; a constant feature is only centred."""
        return df.withColumns({
            name: (F.col(name) - F.lit(self.mean[name]))
            / F.lit(self.std[name] if self.std[name] >= CONSTANT else 1.0)
            for name in FEATURES})

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(name, self.mean[name], self.std[name]) for name in FEATURES]
        spark.createDataFrame(rows, SCALER_SCHEMA).coalesce(1).write.mode("overwrite").json(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Scaler:
        rows = spark.read.schema(SCALER_SCHEMA).json(path).collect()  # one row per feature
        return cls({r["feature"]: r["mean"] for r in rows}, {r["feature"]: r["std"] for r in rows})


def with_lookback(frames: Frames, cfg: TwinConfig = TwinConfig()) -> Frames:
    """Adds ``lookback``: the rows before each row, oldest first, as float32 arrays."""
    row = F.array(*(F.col(f).cast(T.FloatType()) for f in FEATURES))
    before = frames.order.rowsBetween(-cfg.lookback, -1)
    return frames.with_columns({"lookback": F.collect_list(row).over(before)})


def lookback_values(sequences: DataFrame) -> DataFrame:
    """One row per asset-day, row, step and feature."""
    steps = sequences.select(*KEY, "k", F.posexplode("lookback").alias("step", "values"))
    names = F.array(*(F.lit(f) for f in FEATURES))
    return (
        steps.select(*KEY, "k", "step", F.posexplode("values").alias("i", "value"))
        .select(*KEY, "k", "step", F.element_at(names, F.col("i") + 1).alias("feature"), "value")
    )


def flat_lookback(sequences: DataFrame, column: str = "flat") -> DataFrame:
    return sequences.withColumn(column, F.flatten("lookback"))
