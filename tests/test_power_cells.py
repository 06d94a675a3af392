"""Power models grow on cells of readings as they would on the readings."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from coldloop.operators import learning

SCHEMA = "model_T_int double, model_state double, Puissance_Elec_kW double"


def readings(spark, temperatures, seed=0):
    rng = np.random.default_rng(seed)
    state = rng.integers(0, 2, len(temperatures)).astype(float)
    power = np.where(state == 1, 30 + 2 * temperatures, 1.0) + rng.normal(size=len(state))
    return spark.createDataFrame(
        [tuple(map(float, r)) for r in zip(temperatures, state, power)], SCHEMA)


def predictions(model, rows):
    return [r.prediction for r in model.transform(rows).orderBy(*rows.columns).collect()]


def test_trees_on_cells_equal_trees_on_readings(spark):
    """3,000 readings of 200 temperatures, twice as many low ones; more than a tree's 32 bins."""
    t = np.random.default_rng(1).choice(np.repeat(np.arange(200), [2] * 100 + [1] * 100), 3_000)
    rows = readings(spark, 4 + t / 100).persist()
    assemble = VectorAssembler(inputCols=rows.columns[:2], outputCol="power_inputs")
    trees = GBTRegressor(featuresCol="power_inputs", labelCol="Puissance_Elec_kW", maxDepth=4,
                         maxIter=4, seed=7)
    plain = Pipeline(stages=[assemble, trees]).fit(rows)
    model = learning.train_power(rows, depth=4, rounds=4)
    assert predictions(model, rows) == pytest.approx(predictions(plain, rows), abs=1e-9)
    assert learning.power_cells(rows).agg(F.sum("n")).first()[0] == 3_000


def test_cells_are_bounded_for_temperatures_that_never_repeat(spark, monkeypatch):
    monkeypatch.setattr(learning, "TEMPERATURE_LEVELS", 64)
    rows = readings(spark, np.random.default_rng(2).uniform(4, 8, 3_000)).persist()
    cells = learning.power_cells(rows).collect()
    assert 100 < len(cells) <= 2 * 64 and sum(c.n for c in cells) == 3_000
    assert max(c.n for c in cells) < 100
    scored = learning.train_power(rows, depth=5, rounds=5).transform(rows)
    error = F.avg(F.abs(F.col("prediction") - F.col("Puissance_Elec_kW")))
    assert scored.agg(error).first()[0] < 1.2  # the noise alone makes 0.8


def test_neighbouring_values_and_no_rows(spark, monkeypatch):
    monkeypatch.setattr(learning, "TEMPERATURE_LEVELS", 3)
    close = [5.0, np.nextafter(5.0, 6), np.nextafter(np.nextafter(5.0, 6), 6), 7.0, 8.0]
    cells = learning.power_cells(readings(spark, np.array(close * 20))).collect()
    assert sum(c.n for c in cells) == 100 and len({c.model_T_int for c in cells}) <= 3
    assert learning.power_cells(spark.createDataFrame([], SCHEMA)).count() == 0
