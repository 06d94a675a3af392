"""Replay of the two-threshold controller over each asset-day."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coldloop.config import TwinConfig
from coldloop.operators.days import KEY

# Longest day replayed by the array fold, whose cost grows with the square of the length.
FOLD_LIMIT = 1_000
_OUT = "array<struct<t_int_opt:double,etat_opt:double>>"


def replay(df: DataFrame, cfg: TwinConfig = TwinConfig()) -> DataFrame:
    """Adds ``t_int_opt`` and ``etat_opt``.

    Each state depends on the temperature the previous states led to, so a day is folded
    in order; days run in parallel and hold at most ``cfg.rows_per_day`` rows.
    """
    if cfg.rows_per_day > FOLD_LIMIT:
        return replay_long_days(df, cfg)
    payload = [c for c in df.columns if c not in KEY]
    rest = [c for c in payload if c != "k"]
    days = df.groupBy(*KEY).agg(
        F.sort_array(F.collect_list(F.struct("k", *rest))).alias("rows"))
    first = F.col("rows")[0]
    start = F.struct(
        first["t_init"].cast("double").alias("t"),
        first["etat_init"].cast("double").alias("s"),
        F.array().cast(_OUT).alias("out"),
    )

    def step(acc: Column, row: Column) -> Column:
        state = next_state(acc["t"], acc["s"], cfg)
        slope = F.when(state == 1, row["pente_froid"]).otherwise(row["pente_chauffe"])
        done = F.struct(acc["t"].alias("t_int_opt"), state.alias("etat_opt"))
        return F.struct((acc["t"] + slope).alias("t"), state.alias("s"),
                        F.concat(acc["out"], F.array(done)).alias("out"))

    outcome = F.aggregate("rows", start, step, lambda acc: acc["out"])
    return (
        days.select(*KEY, F.inline(F.arrays_zip("rows", outcome.alias("outcome"))))
        .select(*KEY, "rows.*", "outcome.*")
    )


def next_state(temperature: Column, state: Column, cfg: TwinConfig) -> Column:
    """On above the upper threshold, off below the lower one, unchanged in between."""
    return (
        F.when(temperature > F.lit(cfg.switch_on_above), 1.0)
        .when(temperature < F.lit(cfg.switch_off_below), 0.0)
        .otherwise(state)
    )


def replay_long_days(df: DataFrame, cfg: TwinConfig) -> DataFrame:
    """The same recurrence for long days: grouped Arrow batches, linear in the length."""
    schema = T.StructType(df.schema.fields + [
        T.StructField("t_int_opt", T.DoubleType()), T.StructField("etat_opt", T.DoubleType())])
    on_above, off_below = cfg.switch_on_above, cfg.switch_off_below

    def run(day: pd.DataFrame) -> pd.DataFrame:
        day = day.sort_values("k")
        heat, cool = day["pente_chauffe"].to_numpy(), day["pente_froid"].to_numpy()
        t, s = day["t_init"].iloc[0], day["etat_init"].iloc[0]
        temperatures, states = np.empty(len(day)), np.empty(len(day))
        for i in range(len(day)):
            s = 1.0 if t > on_above else 0.0 if t < off_below else s
            temperatures[i], states[i] = t, s
            t = t + (cool[i] if s == 1.0 else heat[i])
        return day.assign(t_int_opt=temperatures, etat_opt=states)

    return df.groupBy(*KEY).applyInPandas(run, schema)
