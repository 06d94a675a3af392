"""Trained temperature models as one artifact: scaler, lookback, recurrent units and readout.

A model is a Spark ML pipeline whose saved form holds all that scoring needs. The recurrent units
are a fixed network drawn from a seed, run over the lookback in Arrow batches; what is learnt is the
scaler and the linear readout of the units, by one pass of normal equations. With attention, the
units of all steps are also pooled, weighted by how close they are to the last step's.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coldloop.config import FEATURES, TwinConfig
from coldloop.operators import days as D
from coldloop.operators import registry
from coldloop.operators.scorers import ThermalScorer, reaching
from coldloop.operators.sequences import CONSTANT
from coldloop.operators.units import BLOCK, Units, matrix
from coldloop.sources.readings import with_time_features

WORK_COLUMNS = ("scaled", "tensor", "known", "label", "weight", "vector", "prediction")


class FeatureScaler(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Learns mean and population deviation of each feature from a day's own rows."""

    def _fit(self, rows: DataFrame) -> FeatureScalerModel:
        own = rows.where(F.to_date("timestamp") == F.col("d"))
        found = own.agg(*(f(name).alias(f"{part}_{name}") for name in FEATURES
                          for part, f in (("mean", F.avg), ("std", F.stddev_pop)))).first()
        return FeatureScalerModel().setMoments(
            [float(found[f"mean_{name}"] or 0.0) for name in FEATURES],
            [float(found[f"std_{name}"] or 0.0) for name in FEATURES])


class FeatureScalerModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``scaled``: (x - mean) / std of each feature; a constant one is only centred."""

    means = Param(Params._dummy(), "means", "of each feature", TypeConverters.toListFloat)
    stds = Param(Params._dummy(), "stds", "of each feature", TypeConverters.toListFloat)

    def setMoments(self, means: list[float], stds: list[float]) -> FeatureScalerModel:
        return self._set(means=means, stds=stds)

    def _transform(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("scaled", F.array(*(
            ((F.col(name) - F.lit(mean)) / F.lit(std if std >= CONSTANT else 1.0)).cast("float")
            for name, mean, std in zip(FEATURES, self.getOrDefault("means"), self.getOrDefault("stds")))))


class Lookback(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``tensor``, the scaled rows before each slice row, oldest first, and keeps slice rows.

    ``known`` marks rows whose lookback is complete; others are scored null and train nothing.
    """

    steps = Param(Params._dummy(), "steps", "rows", TypeConverters.toInt)
    rowsPerDay = Param(Params._dummy(), "rowsPerDay", "rows of a slice", TypeConverters.toInt)
    keys = Param(Params._dummy(), "keys", "columns within which rows follow each other",
                 TypeConverters.toListString)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(steps=12, rowsPerDay=144, keys=["asset_id"])

    def _transform(self, rows: DataFrame) -> DataFrame:
        steps = self.getOrDefault("steps")
        before = (Window.partitionBy(*self.getOrDefault("keys")).orderBy("timestamp", "reading_id")
                  .rowsBetween(-steps, -1))
        tensor = F.flatten(F.collect_list("scaled").over(before))
        known = (F.size("tensor") == steps * len(FEATURES)) & F.forall(
            "tensor", lambda x: x.isNotNull() & ~F.isnan(x))
        return (
            rows.withColumn("tensor", tensor)
            .where(F.col("k").between(0, self.getOrDefault("rowsPerDay") - 1))
            .withColumn("known", known)
            .withColumns({
                "label": F.coalesce("T_int", F.lit(0.0)),
                "weight": F.when(F.col("known") & F.col("T_int").isNotNull(), 1.0).otherwise(0.0)}))


class RecurrentUnits(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``vector``: the units' values after the lookback; zeros where it is not known."""

    units = Param(Params._dummy(), "units", "hidden values", TypeConverters.toInt)
    attention = Param(Params._dummy(), "attention", "pool all steps", TypeConverters.toBoolean)
    seed = Param(Params._dummy(), "seed", "of the fixed weights", TypeConverters.toInt)
    steps = Param(Params._dummy(), "steps", "rows of the lookback", TypeConverters.toInt)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(units=64, attention=False, seed=11, steps=12)

    def network(self) -> Units:
        return Units(*(self.getOrDefault(p) for p in ("units", "attention", "seed", "steps")))

    def _transform(self, rows: DataFrame) -> DataFrame:
        arguments = tuple(self.getOrDefault(p) for p in ("units", "attention", "seed", "steps"))

        @F.arrow_udf("array<double>")
        def values(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            network = Units(*arguments)
            for tensors in batches:
                inputs, known = matrix(tensors, network.steps * len(FEATURES))
                out = np.zeros((len(tensors), network.width))
                out[known] = np.concatenate(
                    [network(inputs[i:i + BLOCK]) for i in range(0, len(inputs), BLOCK)]
                    or [np.zeros((0, network.width))])
                yield pa.ListArray.from_arrays(
                    np.arange(len(out) + 1, dtype=np.int32) * network.width, out.ravel())

        return rows.withColumn("vector", array_to_vector(values("tensor")))


def shape_of(label: str) -> tuple[int, bool]:
    """Units and attention of a thermal label of the registry."""
    return 128 if "128u" in label else 64, "NoAttention" not in label


def prepared(frames: D.Frames) -> D.Frames:
    """Frames with all features; the first reading of an asset stands in for its predecessor."""
    return D.with_lag_feature(frames).map(with_time_features).with_columns(
        {"T_int_lag_1": F.coalesce("T_int_lag_1", "T_int")})


def with_keys(model: PipelineModel, keys: tuple[str, ...]) -> PipelineModel:
    """The same model for rows that follow each other within ``keys``."""
    return PipelineModel([s.copy({s.keys: list(keys)}) if isinstance(s, Lookback) else s
                          for s in model.stages])


def train(frames: D.Frames, cutoff: dt.date, label: str,
          cfg: TwinConfig = TwinConfig()) -> PipelineModel:
    """The model of a thermal label, fitted on the dates before ``cutoff``."""
    units, attention = shape_of(label)
    lookback = Lookback()._set(steps=cfg.lookback, rowsPerDay=cfg.rows_per_day, keys=list(frames.keys))
    stages = [
        FeatureScaler(), lookback,
        RecurrentUnits()._set(units=units, attention=attention, steps=cfg.lookback),
        LinearRegression(featuresCol="vector", labelCol="label", weightCol="weight",
                         predictionCol="prediction", solver="normal", regParam=1e-3),
        SQLTransformer(statement="SELECT *, CASE WHEN known THEN prediction END AS t_int_pred "
                                 "FROM __THIS__"),
    ]
    return Pipeline(stages=stages).fit(prepared(frames).df.where(F.col("d") < F.lit(cutoff)))


def trained(model: PipelineModel) -> ThermalScorer:
    """A fitted pipeline as a scorer of frames; only slice rows come out of it."""
    steps = next(s for s in model.stages if isinstance(s, Lookback)).getOrDefault("steps")

    def score(frames: D.Frames) -> D.Frames:
        return prepared(frames).map(lambda df: with_keys(model, frames.keys).transform(df).drop(
            *WORK_COLUMNS))
    return reaching(score, steps)


def model_path(spark: SparkSession, root: str, label: str) -> str:
    """Where a label's model lies below ``root``; an unknown label is an error."""
    names = spark.createDataFrame([(label,)], "name string")
    found = registry.with_paths(registry.lookup(names, registry.registry(spark), "name")).select(
        "model_path").first()
    if found is None:
        raise KeyError(label)
    return f"{root}/{found[0]}"


def save(model: PipelineModel, spark: SparkSession, root: str, label: str) -> None:
    model.write().overwrite().save(model_path(spark, root, label))


def load(spark: SparkSession, root: str, label: str) -> PipelineModel:
    return PipelineModel.load(model_path(spark, root, label))


def parts(model: PipelineModel) -> tuple[FeatureScalerModel, Lookback, RecurrentUnits,
                                         LinearRegressionModel]:
    kinds = (FeatureScalerModel, Lookback, RecurrentUnits, LinearRegressionModel)
    return tuple(next(s for s in model.stages if isinstance(s, kind)) for kind in kinds)
