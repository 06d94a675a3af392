"""The fixed recurrent units behind the trained temperature models, on arrays.

Tasks import this module and nothing of Spark ML.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from coldloop.config import FEATURES

#: Rows that go through the units at once; the published models took 64.
BLOCK = 4_096


def drawn(seed: int, *shape: int) -> np.ndarray:
    """Uniform numbers in [-1, 1) from the raw bits of a generator, the same in every version."""
    bits = np.random.PCG64(seed).random_raw(int(np.prod(shape)))
    return ((bits >> np.uint64(11)) * 2.0 ** -52 - 1.0).reshape(shape)


class Units:
    """The fixed recurrent network: ``units`` hidden values per step."""

    def __init__(self, units: int, attention: bool, seed: int, steps: int) -> None:
        self.steps, self.attention = steps, attention
        self.inward = drawn(seed, len(FEATURES), units) * 0.5
        self.across = drawn(seed + 1, units, units) * (0.9 * np.sqrt(3.0 / units))
        self.bias = drawn(seed + 2, units) * 0.1

    def __call__(self, tensor: np.ndarray) -> np.ndarray:
        """Rows of (last step's features, hidden values[, pooled hidden values])."""
        x = tensor.reshape(len(tensor), self.steps, len(FEATURES)).astype(np.float64)
        hidden, all_hidden = np.zeros((len(x), len(self.bias))), []
        for t in range(self.steps):
            hidden = np.tanh(x[:, t] @ self.inward + hidden @ self.across + self.bias)
            all_hidden.append(hidden)
        out = [x[:, -1], hidden]
        if self.attention:
            history = np.stack(all_hidden, axis=1)
            close = np.einsum("nth,nh->nt", history, hidden) / np.sqrt(len(self.bias))
            weights = np.exp(close - close.max(axis=1, keepdims=True))
            out.append(np.einsum("nt,nth->nh", weights / weights.sum(axis=1, keepdims=True), history))
        return np.concatenate(out, axis=1)

    @property
    def width(self) -> int:
        return len(FEATURES) + len(self.bias) * (2 if self.attention else 1)


def matrix(tensors: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column that have exactly ``width`` known values, and which ones those are."""
    lengths = tensors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    values = tensors.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    full = lengths == width
    rows = values[(ends[full] - width)[:, None] + np.arange(width)] if full.any() else np.zeros((0, width))
    known = np.isfinite(rows).all(axis=1)
    full[full] = known
    return rows[known], full
