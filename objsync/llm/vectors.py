"""Vectors of an array column as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


class Vectors:
    """The arrays of a column: their lengths, and which of them are whole.

    ``finite`` is true for an array that is not null and holds neither nulls nor
    non-finite components, ``nonzero`` for one with a component other than zero.
    """

    def __init__(self, column: pa.Array):
        present = column.is_valid().to_numpy(False)
        self.lengths = pc.list_value_length(column).fill_null(0).to_numpy().astype(np.int64)
        flat = column.flatten().cast(pa.float64())
        self._flat = flat.to_numpy(zero_copy_only=False)
        self._starts = np.cumsum(self.lengths) - self.lengths
        self.finite = present & (self._count(np.isfinite(self._flat)) == self.lengths)
        self.nonzero = self._count(self._flat != 0) > 0

    def _count(self, flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(flags)))
        return sums[self._starts + self.lengths] - sums[self._starts]

    def matrix(self, rows: np.ndarray, length: int) -> np.ndarray:
        """The arrays ``rows``, all of ``length`` components, as doubles."""
        return self._flat[self._starts[rows][:, None] + np.arange(length)]


def binary(rows: np.ndarray) -> pa.Array:
    """Each row of a matrix as its bytes."""
    return pa.array([row.tobytes() for row in np.ascontiguousarray(rows)], pa.binary())


def unpacked(column: pa.Array, dtype: str) -> np.ndarray:
    """The matrix that ``binary`` packed; all values have one size."""
    data = np.frombuffer(b"".join(column.to_pylist()), dtype=dtype)
    return data.reshape(len(column), -1) if len(column) else data.reshape(0, 0)


def nearest_centres(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The number of the nearest centre of each point."""
    out = np.empty(len(points), dtype=np.int64)
    norms = (centres * centres).sum(axis=1)
    for a in range(0, len(points), 8192):
        out[a : a + 8192] = np.argmin(norms - 2 * points[a : a + 8192] @ centres.T, axis=1)
    return out


def fitted_centres(points: np.ndarray, count: int, rounds: int = 10, seed: int = 7) -> np.ndarray:
    """At most ``count`` centres of bounded many ``points`` by Lloyd's rounds."""
    distinct = np.unique(points, axis=0)
    rng = np.random.default_rng(seed)
    centres = distinct[rng.choice(len(distinct), min(count, len(distinct)), replace=False)]
    for _ in range(rounds):
        of = nearest_centres(points, centres)
        n = np.bincount(of, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, of, points)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres
