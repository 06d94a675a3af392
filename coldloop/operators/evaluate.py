"""Errors, ranking and side-by-side runs of the closed-form model variants.

The trained networks and boosted trees behind the registry labels are not available; each
label has a closed-form stand-in of the same shape of input: lookback means of 12 or 6
rows, plain or weighted towards recent rows, and leaf means of 3 to 9 levels.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coldloop.config import TwinConfig
from coldloop.functions.numeric import POWER_DIGITS, half_even
from coldloop.operators import days as D
from coldloop.operators.kpi import kpis
from coldloop.operators.lanes import replay_lanes, with_lane_slopes
from coldloop.operators.registry import ENERGY, MODELS, normalised
from coldloop.operators.scorers import LeafMeans, ThermalScorer, lookback_mean

# Target names as published with the model errors.
TEMPERATURE, POWER = "Température (°C)", "Puissance (kW)"
DEPTHS = (3, 5, 7, 9)


def thermal_shapes() -> dict[str, tuple[int, bool]]:
    """Label to the readings its mean looks back on, and whether recent ones weigh more."""
    return {label: (12 if "128u" in label else 6, "NoAttention" not in label)
            for family, label, _ in MODELS if family != ENERGY}


def thermal_variants() -> dict[str, ThermalScorer]:
    """Label to scorer; each writes its own column ``t_<i>``."""
    return {label: lookback_mean(steps, recency, out=f"t_{i}")
            for i, (label, (steps, recency)) in enumerate(thermal_shapes().items())}


def energy_label(depth: int) -> str:
    return f"XGBoost Depth {depth}"


def split_date(readings: DataFrame, share: float = 2 / 3) -> dt.date:
    """The date that leaves ``share`` of the calendar days before it."""
    first, last = readings.agg(F.min("d"), F.max("d")).first()
    return first + dt.timedelta(days=int(((last - first).days + 1) * share))


def score_thermal_variants(frames: D.Frames, cfg: TwinConfig) -> DataFrame:
    for scorer in thermal_variants().values():
        frames = scorer(frames)
    return frames.slices(cfg)


def _error_rows(df: DataFrame, target: str, actual: str, predicted: dict[str, str]) -> DataFrame:
    pairs = F.array(*(
        F.struct(F.lit(label.replace(" ", "_")).alias("model"),
                 (F.col(actual) - F.col(column)).alias("error"))
        for label, column in predicted.items()))
    return df.select(F.inline(pairs)).select("model", F.lit(target).alias("target"), "error")


def model_errors(readings: DataFrame, frames: D.Frames, cutoff: dt.date,
                 cfg: TwinConfig = TwinConfig()) -> DataFrame:
    """MAE and RMSE per variant. Power models learn before ``cutoff`` and are tested after."""
    thermal = _error_rows(
        score_thermal_variants(frames, cfg), TEMPERATURE, "T_int",
        {label: f"t_{i}" for i, label in enumerate(thermal_variants())})
    leaves = LeafMeans.fit(readings.where(F.col("d") < F.lit(cutoff)), DEPTHS)
    later = readings.where(F.col("d") >= F.lit(cutoff))
    scored = leaves.apply(later, "T_int", "Etat_Compresseur", "p")
    energy = _error_rows(scored, POWER, "Puissance_Elec_kW",
                         {energy_label(d): f"p_{d}" for d in DEPTHS})
    error = F.col("error")
    return (
        thermal.unionByName(energy).groupBy("model", "target")
        .agg(F.count(error).alias("n"), F.avg(F.abs(error)).alias("mae"),
             F.sqrt(F.avg(error * error)).alias("rmse"))
        .withColumns({m: half_even(F.col(m), 6) for m in ("mae", "rmse")})
    )


def leaderboard(errors: DataFrame, models: DataFrame) -> DataFrame:
    """Variants ranked by RMSE within their target, joined to the registry by name."""
    by_target = Window.partitionBy("target").orderBy("rmse")
    return (
        errors.withColumn("rank", F.rank().over(by_target))
        .withColumn("name", normalised(F.col("model")))
        .join(F.broadcast(models.withColumn("name", normalised(F.col("label")))), "name")
        .select("target", "rank", "model", "mae", "rmse", "family", "label", "artifact")
    )


def variant_kpis(readings: DataFrame, frames: D.Frames,
                 cfg: TwinConfig = TwinConfig()) -> DataFrame:
    """KPIs of every pair of thermal and energy variants, per asset.

    The four forecasts of a row are lanes of one controller fold; lanes and power predictions are
    unpivoted just before the totals, so no row is shuffled more than once for all variants.
    """
    labels = list(thermal_variants())
    lanes = [f"t_{i}" for i in range(len(labels))]
    scored = score_thermal_variants(D.with_seed(frames), cfg).select(
        *D.KEY, "k", "Puissance_Elec_kW", "Etat_Compresseur", "t_init", "etat_init", *lanes)
    run = replay_lanes(with_lane_slopes(scored, lanes, cfg), lanes, cfg)
    leaves = LeafMeans.fit(readings, DEPTHS)
    for lane in lanes:
        run = leaves.apply(run, lane, "Etat_Compresseur", f"pred_{lane}")
        run = leaves.apply(run, f"opt_{lane}", f"state_{lane}", f"pwr_{lane}")
    pairs = F.array(*(
        F.struct(F.lit(label).alias("thermal"), F.lit(energy_label(depth)).alias("energy"),
                 F.col(f"state_{lane}").alias("etat_opt"),
                 half_even(F.col(f"pred_{lane}_{depth}"), POWER_DIGITS).alias("pwr_pred_ia"),
                 half_even(F.col(f"pwr_{lane}_{depth}"), POWER_DIGITS).alias("pwr_opt"))
        for label, lane in zip(labels, lanes) for depth in DEPTHS))
    rows = run.select("asset_id", "Puissance_Elec_kW", "Etat_Compresseur", F.inline(pairs))
    return kpis(rows, ("thermal", "energy", "asset_id"), cfg)
