"""Scoring with every model call measured: which model, which day, how many rows, how long.

A day of an asset is one call of each model, as a request is. All models score a day in one pass
over its lookbacks; a worker opens a model at its first call and keeps it.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import time

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coldloop.config import FEATURES, TwinConfig
from coldloop.operators.artifacts import opened, padded
from coldloop.operators.days import KEY, Frames
from coldloop.operators.recurrent import prepared

#: Upper ends of the latency histogram's bins in seconds; a last bin takes all.
BOUNDS = (0.001, 0.005, 0.01, 0.05, 0.1, 0.5, 1.0, 5.0)
#: When this process opened a model, by the digest of its bytes.
OPENED_AT: dict[str, dt.datetime] = {}


def measured(spark: SparkSession, frames: Frames, models: dict[str, bytes],
             cfg: TwinConfig = TwinConfig()) -> DataFrame:
    """Slice rows of every model: asset_id, d, k, model, t_int_pred and the call's measurements.

    ``call_seconds`` and ``loaded_at`` are on the first row of a call and null on its others, so
    calls are counted by them. Times differ from run to run: write the result before using it
    twice. ``models`` maps names to stored artifacts. A group is one day of at most
    ``cfg.rows_per_day`` rows.
    """
    sent = spark.sparkContext.broadcast(
        {name: (content, hashlib.sha256(content).hexdigest()) for name, content in models.items()})
    longest = max((opened(*pair).steps for pair in sent.value.values()), default=cfg.lookback)
    if frames.reach is not None and longest > frames.reach:
        raise ValueError(f"a model looks back on {longest} readings and the frames hold "
                         f"{frames.reach}; set TwinConfig.reach")
    width = len(FEATURES)

    def calls(day: pa.Table) -> pa.Table:
        day = day.sort_by("k").combine_chunks()
        rows, out = padded(day["tensor"].combine_chunks(), longest * width), []
        for name, (content, digest) in sent.value.items():
            model = opened(content, digest)
            loaded = OPENED_AT.setdefault(digest, dt.datetime.now(dt.timezone.utc))
            begin = time.perf_counter()
            values = model.predict(rows[:, (longest - model.steps) * width:])
            seconds = time.perf_counter() - begin
            n = len(rows)
            out.append(pa.table({
                "asset_id": day["asset_id"], "d": day["d"], "k": day["k"],
                "model": pa.array([name] * n, pa.string()),
                "t_int_pred": pa.array(values, pa.float64(), mask=values != values),
                "call_seconds": pa.array([seconds, *[None] * (n - 1)], pa.float64()),
                "loaded_at": pa.array([loaded, *[None] * (n - 1)], pa.timestamp("us", "UTC"))}))
        return pa.concat_tables(out)

    before = frames.order.rowsBetween(-longest, -1)
    row = F.array(*(F.col(name) for name in FEATURES))
    lookbacks = prepared(frames).with_columns(
        {"tensor": F.flatten(F.collect_list(row).over(before))}).slices(cfg)
    days = lookbacks.select("asset_id", "d", F.col("k").cast("bigint").alias("k"), "tensor")
    if not models:
        days = days.where(F.lit(False))
    return days.groupBy(*KEY).applyInArrow(
        calls, "asset_id long, d date, k long, model string, t_int_pred double, "
               "call_seconds double, loaded_at timestamp")


def day_calls(scored: DataFrame) -> DataFrame:
    """Per model and asset-day: calls, rows asked for, rows with a forecast, seconds, load time."""
    return scored.groupBy("model", *KEY).agg(
        F.count("call_seconds").alias("calls"), F.count("*").alias("rows_asked"),
        F.count("t_int_pred").alias("rows_scored"), F.sum("call_seconds").alias("seconds"),
        F.max("loaded_at").alias("loaded_at"))


def latency_histogram(scored: DataFrame, bounds: tuple[float, ...] = BOUNDS) -> DataFrame:
    """Per model and bin: ``le`` (its upper end), calls up to it, and the model's seconds.

    Bins are cumulative; the last one, infinity, counts all calls.
    """
    ends = sorted({*bounds, float("inf")})
    seconds = F.col("call_seconds")
    counted = scored.where(seconds.isNotNull()).groupBy("model").agg(
        F.sum(seconds).alias("seconds"),
        F.array(*(F.struct(F.lit(end).alias("le"), F.count(F.when(seconds <= end, 1)).alias("calls"))
                  for end in ends)).alias("bins"))
    return counted.select("model", "seconds", F.inline("bins"))
