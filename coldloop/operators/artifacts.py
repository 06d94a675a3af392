"""Models as files of arrays: what a worker opens to score batches of lookbacks.

Tasks import this module and nothing of Spark.
"""

from __future__ import annotations

import io
from typing import Protocol

import numpy as np
import pyarrow as pa

from coldloop.config import FEATURES
from coldloop.operators.units import Units

#: Whole units of a temperature; see ``functions.numeric``.
SCALE = 1e9


class Artifact(Protocol):
    """A model over the last ``steps`` rows of features; NaN in, NaN out."""

    kind: str
    steps: int

    def arrays(self) -> dict[str, np.ndarray]: ...

    def predict(self, rows: np.ndarray) -> np.ndarray: ...


class MeanArtifact:
    """Weighted mean of the temperatures of the last rows, in whole units, half-even."""

    kind = "mean"

    def __init__(self, weights: np.ndarray) -> None:
        self.weights, self.steps = np.asarray(weights, np.int64), len(weights)

    def arrays(self) -> dict[str, np.ndarray]:
        return {"weights": self.weights}

    def predict(self, rows: np.ndarray) -> np.ndarray:
        temperatures = rows.reshape(len(rows), self.steps, -1)[:, :, FEATURES.index("T_int")]
        known = np.isfinite(temperatures)
        units = np.where(known, np.rint(temperatures * SCALE), 0.0).astype(np.int64)
        weights = known @ self.weights
        with np.errstate(invalid="ignore", divide="ignore"):
            mean = (units @ self.weights).astype(np.float64) / weights
        return np.where(weights > 0, np.rint(mean) / SCALE, np.nan)


class RecurrentArtifact:
    """A fitted recurrent pipeline as arrays: scaler, shape of the units, readout."""

    kind = "recurrent"

    def __init__(self, means: np.ndarray, stds: np.ndarray, shape: np.ndarray,
                 readout: np.ndarray) -> None:
        self.means, self.stds, self.shape, self.readout = means, stds, shape, readout
        units, attention, seed, self.steps = (int(x) for x in shape)
        self.units = Units(units, bool(attention), seed, self.steps)

    def arrays(self) -> dict[str, np.ndarray]:
        return {"means": self.means, "stds": self.stds, "shape": self.shape, "readout": self.readout}

    def predict(self, rows: np.ndarray) -> np.ndarray:
        spread = np.where(self.stds >= 1e-9, self.stds, 1.0)
        x = (rows.reshape(len(rows), self.steps, -1) - self.means) / spread
        known = np.isfinite(x).all(axis=(1, 2))
        values = self.units(x[known].astype(np.float32).reshape(known.sum(), -1))
        out = np.full(len(rows), np.nan)
        out[known] = values @ self.readout[:-1] + self.readout[-1]
        return out


KINDS: dict[str, type] = {k.kind: k for k in (MeanArtifact, RecurrentArtifact)}
#: Models opened by this process, by the digest of their bytes.
OPEN: dict[str, Artifact] = {}


def to_bytes(artifact: Artifact) -> bytes:
    sink = io.BytesIO()
    np.savez(sink, kind=np.array(artifact.kind), **artifact.arrays())
    return sink.getvalue()


def opened(content: bytes, digest: str) -> Artifact:
    """The model behind ``content``, made at the first call in a process."""
    if digest not in OPEN:
        with np.load(io.BytesIO(content), allow_pickle=False) as arrays:
            named = {name: arrays[name] for name in arrays.files}
        OPEN[digest] = KINDS[str(named.pop("kind"))](**named)
    return OPEN[digest]


def padded(tensors: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of ``width`` values; what is missing at the front is NaN."""
    lengths = tensors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    values = tensors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.full((len(lengths), width), np.nan)
    if len(values):
        row = np.repeat(np.arange(len(lengths)), lengths)
        place = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - width, lengths)
        out[row, place] = values
    return out
