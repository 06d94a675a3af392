"""Trained scorers: split by date, stored and loaded, and usable in the full run."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from coldloop.config import TwinConfig
from coldloop.operators import days as D
from coldloop.operators import evaluate, learning, metrics
from coldloop.operators.registry import registry
from coldloop.operators.scorers import ModelPower, array_mean_udf, lookback_mean
from coldloop.operators.sequences import Scaler
from coldloop.plans.twin import forecast, twin_from_frames
from coldloop.sources.readings import read_events

CFG = TwinConfig()
SF_DIR = "/root/testdata/sf0.001"


def test_trained_scorers_run_the_whole_twin(spark):
    source = read_events(spark, SF_DIR)
    cutoff = evaluate.split_date(source)
    frames = D.day_frames(source, CFG)
    vectors = learning.lookback_vectors(frames, Scaler.fit(source), CFG)
    assert vectors.first().vector.size == 96
    thermal = learning.save_and_load(learning.train_thermal(vectors, cutoff), source, "thermal")
    trees = learning.train_power(learning.power_rows(source, cutoff), depth=3, rounds=5)
    power = learning.save_and_load(trees, source, "power")
    assert isinstance(thermal, PipelineModel) and isinstance(power, PipelineModel)

    later = thermal.transform(vectors.where(F.col("d") >= F.lit(cutoff)))
    assert later.count() > 0 and later.where("t_int_pred is null").isEmpty()

    # Trained forecasts replace the closed-form ones row by row, context rows included.
    predicted = thermal.transform(vectors).select("asset_id", "d", "k", "t_int_pred")

    def scorer(f):
        return f.map(lambda df: df.join(predicted, ["asset_id", "d", "k"], "left"))

    twin = twin_from_frames(frames, ModelPower(power), CFG, scorer)
    assert twin.count() == forecast(frames, CFG).count()
    assert twin.where("pwr_opt is null or not etat_opt in (0, 1)").isEmpty()


def test_pandas_hook_equals_the_window_scorer(spark):
    frames = D.frames_by_day(read_events(spark, SF_DIR), CFG)
    columns = ("asset_id", "d", "k", "t_int_pred")
    by_udf = forecast(frames, CFG, array_mean_udf(12)).select(*columns)
    by_window = forecast(frames, CFG, lookback_mean(12)).select(*columns)
    assert sorted(by_udf.collect()) == sorted(by_window.collect())


def test_variants_are_ranked_and_joined_to_the_registry(spark):
    source = read_events(spark, SF_DIR)
    errors = evaluate.model_errors(source, D.day_frames(source, CFG), evaluate.split_date(source))
    board = evaluate.leaderboard(errors, registry(spark)).collect()
    assert len(board) == 8
    for target in (evaluate.TEMPERATURE, evaluate.POWER):
        ranked = sorted((r for r in board if r.target == target), key=lambda r: r.rank)
        assert [r.rank for r in ranked][0] == 1
        assert [r.rmse for r in ranked] == sorted(r.rmse for r in ranked)
    assert all(r.mae <= r.rmse for r in board)


def test_run_figures_count_rows_days_and_calls(spark):
    source = read_events(spark, SF_DIR)
    scored = forecast(D.day_frames(source, CFG), CFG)
    counts, timed = metrics.run_counts(scored).first(), metrics.timed_run(scored, "v1").first()
    assert counts.rows_scored == timed.rows_scored == scored.count()
    assert counts.days_scored == timed.days_scored == scored.where("k = 0").count()
    assert (counts.thermal_calls, counts.power_calls) == (
        counts.days_scored, 2 * counts.days_scored)
    assert timed.variant == "v1" and timed.elapsed_seconds > 0 and timed.loaded_at is not None
