"""The full day pipeline: readings to optimised day results, all asset-days at once."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame

from coldloop.config import TwinConfig
from coldloop.operators import days as D
from coldloop.operators.control import replay
from coldloop.operators.layout import Layout
from coldloop.operators.routed import Summary, summarise
from coldloop.operators.scorers import PowerLine, PowerScorer, ThermalScorer, lookback_mean
from coldloop.operators.slopes import with_rolling_slopes, with_slopes


def reach_of(thermal: ThermalScorer | None, cfg: TwinConfig) -> int:
    """Earlier readings a scorer needs; one that does not say is taken to need the lookback."""
    return getattr(thermal, "reach", cfg.lookback)


def forecast(frames: D.Frames, cfg: TwinConfig = TwinConfig(),
             thermal: ThermalScorer | None = None) -> DataFrame:
    """Slice rows with the seed reading and ``t_int_pred``."""
    thermal = thermal or lookback_mean(cfg.lookback)
    if frames.reach is not None and reach_of(thermal, cfg) > frames.reach:
        raise ValueError(f"the scorer looks back on {reach_of(thermal, cfg)} readings and the "
                         f"frames hold {frames.reach}; set TwinConfig.reach")
    return thermal(D.with_seed(frames)).slices(cfg)


def controlled(scored: DataFrame, cfg: TwinConfig = TwinConfig()) -> DataFrame:
    """Slopes, rolling slopes and the controller on top of a forecast."""
    return replay(with_rolling_slopes(with_slopes(scored), cfg), cfg)


def twin_from_frames(frames: D.Frames, power: PowerScorer, cfg: TwinConfig = TwinConfig(),
                     thermal: ThermalScorer | None = None) -> DataFrame:
    scored = forecast(frames, cfg, thermal)
    scored = power.apply(scored, "t_int_pred", "Etat_Compresseur", "pwr_pred_ia")
    return power.apply(controlled(scored, cfg), "t_int_opt", "etat_opt", "pwr_opt")


def twin_days(readings: DataFrame, cfg: TwinConfig = TwinConfig(),
              thermal: ThermalScorer | None = None, power: PowerScorer | None = None,
              layout: Layout | None = None, wanted: DataFrame | None = None) -> DataFrame:
    """Every asset-day (or those ``wanted``) with forecasts, controller and power.

    Unless a layout is given or only some days are wanted, each asset gets its own plan.
    """
    cfg = replace(cfg, reach=max(cfg.reach, reach_of(thermal, cfg)))
    if layout is None and wanted is None:
        return twin_routed(readings, summarise(readings), cfg, thermal, power)
    frames = D.day_frames(readings, cfg, layout, wanted)
    return twin_from_frames(frames, power or PowerLine.fit(readings), cfg, thermal)


def twin_routed(readings: DataFrame, summary: Summary, cfg: TwinConfig = TwinConfig(),
                thermal: ThermalScorer | None = None, power: PowerScorer | None = None,
                prepare: Callable[[D.Frames], D.Frames] = lambda frames: frames) -> DataFrame:
    """The twin of every asset-day, by the plans that ``summary`` chooses."""
    cfg = replace(cfg, reach=max(cfg.reach, reach_of(thermal, cfg)))
    power = power or summary.power_lines()
    return reduce(DataFrame.unionByName, (
        twin_from_frames(prepare(frames), power, cfg, thermal)
        for frames in summary.frames(readings, cfg)))


def twin_date(readings: DataFrame, day: dt.date, power: PowerScorer,
              cfg: TwinConfig = TwinConfig(), thermal: ThermalScorer | None = None,
              index: DataFrame | None = None) -> DataFrame:
    """One calendar date over all assets; an unknown date gives no rows. With a stored day
    ``index`` only that date and the dates it borrows from are read."""
    cfg = replace(cfg, reach=max(cfg.reach, reach_of(thermal, cfg)))
    return twin_from_frames(
        D.frames_for_date(readings, day, cfg, index=index), power, cfg, thermal)
