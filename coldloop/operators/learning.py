"""Trained scorers on Spark ML: linear regression on the lookback, boosted trees for power."""

from __future__ import annotations

import datetime as dt

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldloop.config import TwinConfig
from coldloop.operators import days as D
from coldloop.operators.sequences import Scaler, flat_lookback, with_lookback
from coldloop.session import scratch_path
from coldloop.sources.readings import with_time_features


#: Boosting rounds of a power model.
ROUNDS = 50
#: Values of temperature and of state up to which power models are trained on each of them.
TEMPERATURE_LEVELS, STATE_LEVELS = 4_096, 32


def lookback_vectors(frames: D.Frames, scaler: Scaler,
                     cfg: TwinConfig = TwinConfig()) -> DataFrame:
    """Slice rows with the flattened, scaled lookback as an ML vector.

    The very first reading of an asset has no predecessor; its own temperature fills in. Rows
    with an unknown value in their lookback are marked by ``known``: they train nothing and
    are scored null.
    """
    filled = D.with_lag_feature(frames).map(with_time_features).with_columns({
        "T_int_lag_1": F.coalesce("T_int_lag_1", "T_int"), "actual": F.col("T_int")})
    rows = flat_lookback(with_lookback(filled.map(scaler.apply), cfg).slices(cfg))
    known = F.forall("flat", lambda x: x.isNotNull() & ~F.isnan(x))
    filled = F.when(known, F.col("flat").cast("array<double>")).otherwise(
        F.array_repeat(F.lit(0.0), F.size("flat")))
    return rows.withColumns({"vector": array_to_vector(filled), "known": known})


def train_thermal(vectors: DataFrame, cutoff: dt.date) -> PipelineModel:
    """Fits on the days before ``cutoff``; the normal equations need one pass."""
    regression = LinearRegression(featuresCol="vector", labelCol="actual",
                                  predictionCol="t_int_pred", solver="normal", regParam=1e-3)
    earlier = vectors.where(F.col("d") < F.lit(cutoff)).where("actual is not null and known")
    return Pipeline(stages=[regression]).fit(earlier.select("vector", "actual"))


def score_thermal(model: PipelineModel, vectors: DataFrame) -> DataFrame:
    """Adds ``t_int_pred``; null where the lookback is not fully known."""
    return model.transform(vectors).withColumn(
        "t_int_pred", F.when(F.col("known"), F.col("t_int_pred")))


def power_rows(readings: DataFrame, cutoff: dt.date) -> DataFrame:
    """What power models learn from: complete readings before ``cutoff``."""
    return (
        readings.where(F.col("d") < F.lit(cutoff))
        .select(F.col("T_int").alias("model_T_int"), F.col("Etat_Compresseur").alias("model_state"),
                "Puissance_Elec_kW").dropna()
    )


def at_levels(rows: DataFrame, column: str, most: int) -> DataFrame:
    """``rows``; where a column has more than ``most`` values, each goes to the nearest quantile.

    Two quantiles part halfway, which is where a tree that is trained on them splits.
    """
    if rows.select(column).distinct().limit(most + 1).count() <= most:
        return rows
    found = rows.approxQuantile(column, np.linspace(0, 1, most).tolist(), 0.25 / most)
    values, halves = found[:1], []
    for value in found[1:]:
        half = values[-1] + (value - values[-1]) / 2
        if values[-1] < half < value:
            halves.append(half)
            values.append(value)
    level = Bucketizer(splits=[-np.inf, *halves, np.inf], inputCol=column, outputCol="level")
    nearest = F.element_at(F.lit(np.array(values)), F.col("level").cast("int") + 1)
    return level.transform(rows).withColumn(column, nearest).drop("level")


def power_cells(rows: DataFrame) -> DataFrame:
    """Mean power and number ``n`` of ``power_rows`` per temperature and state.

    Squared-error trees over these two see of a cell only its mean and its number of rows, so they
    grow on the cells as on the rows. There are at most ``TEMPERATURE_LEVELS`` times
    ``STATE_LEVELS`` cells, however many rows and different values there are.
    """
    for column, most in (("model_T_int", TEMPERATURE_LEVELS), ("model_state", STATE_LEVELS)):
        rows = at_levels(rows, column, most)
    return rows.groupBy("model_T_int", "model_state").agg(
        F.avg("Puissance_Elec_kW").alias("Puissance_Elec_kW"),
        F.count("*").cast("double").alias("n"))


def train_power(rows: DataFrame, depth: int = 5, rounds: int = ROUNDS) -> PipelineModel:
    """Boosted trees of one depth over (temperature, state), fitted on ``power_rows``."""
    return train_power_cells(power_cells(rows), depth, rounds)


def train_power_cells(cells: DataFrame, depth: int = 5, rounds: int = ROUNDS) -> PipelineModel:
    """Boosted trees of one depth over (temperature, state), fitted on ``power_cells``."""
    trees = GBTRegressor(featuresCol="power_inputs", labelCol="Puissance_Elec_kW", weightCol="n",
                         predictionCol="prediction", maxDepth=depth, maxIter=rounds, seed=7)
    assemble = VectorAssembler(inputCols=["model_T_int", "model_state"], outputCol="power_inputs",
                               handleInvalid="keep")
    return Pipeline(stages=[assemble, trees]).fit(cells)


def save_and_load(model: PipelineModel, df: DataFrame, label: str) -> PipelineModel:
    """Writes the artifact to the shared folder and loads it back, as a scoring job would."""
    path = scratch_path(df.sparkSession, label)
    model.write().save(path)
    return PipelineModel.load(path)
