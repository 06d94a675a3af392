"""Scoring by a model that every worker opens once, in batches.

An artifact is a file of arrays in the shared folder. The driver reads it and broadcasts its bytes;
a worker makes the model from them at its first batch and keeps it for later tasks. Batches are
Arrow columns, so no row becomes a Python object.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from coldloop.config import FEATURES
from coldloop.operators.artifacts import Artifact, RecurrentArtifact, opened, padded, to_bytes
from coldloop.operators.days import Frames
from coldloop.operators.recurrent import parts, prepared
from coldloop.operators.scorers import ThermalScorer, reaching
from coldloop.operators.units import BLOCK

#: Largest artifact that is sent to all workers.
MOST_BYTES = 256 << 20


def compiled(model: PipelineModel) -> RecurrentArtifact:
    """A fitted recurrent pipeline as arrays: scaler, shape of the units, readout."""
    scaler, _, units, line = parts(model)
    return RecurrentArtifact(
        np.array(scaler.getOrDefault("means")), np.array(scaler.getOrDefault("stds")),
        np.array([units.getOrDefault(p) for p in ("units", "attention", "seed", "steps")], np.int64),
        np.append(line.coefficients.toArray(), line.intercept))


def save(spark: SparkSession, artifact: Artifact, path: str) -> None:
    """One row of bytes below ``path``, written by a task to whatever store Spark reaches."""
    spark.createDataFrame([(bytearray(to_bytes(artifact)),)], "content binary").write.mode(
        "overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> bytes:
    content = bytes(spark.read.parquet(path).first()[0])
    if len(content) > MOST_BYTES:
        raise ValueError(f"the artifact has {len(content)} bytes and would go to every worker")
    return content


def batched(spark: SparkSession, content: bytes, block: int = BLOCK) -> ThermalScorer:
    """An artifact as a scorer of frames: ``block`` rows at once."""
    digest = hashlib.sha256(content).hexdigest()
    steps, sent = opened(content, digest).steps, spark.sparkContext.broadcast(content)

    @F.arrow_udf("double")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = opened(sent.value, digest)
        for tensors in batches:
            rows = padded(tensors, steps * len(FEATURES))
            found = [model.predict(rows[i:i + block]) for i in range(0, len(rows), block)]
            values = np.concatenate(found) if found else np.zeros(0)
            yield pa.array(values, mask=~np.isfinite(values))

    def score(frames: Frames) -> Frames:
        before = frames.order.rowsBetween(-steps, -1)
        row = F.array(*(F.col(name) for name in FEATURES))
        return prepared(frames).with_columns(
            {"tensor": F.flatten(F.collect_list(row).over(before))}).with_columns(
            {"t_int_pred": predict("tensor")}).map(lambda df: df.drop("tensor"))
    return reaching(score, steps)
