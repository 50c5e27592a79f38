"""What the two vector operators share: usable vectors, samples to fit on, groups of bounded size."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector has components, all of them finite numbers, and not only zeros."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column of equally long vectors, in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def sample(rows: DataFrame, total: int, size: int, seed: str) -> dict[int, np.ndarray]:
    """About ``size`` of ``total`` vectors, at most twice as many, by a hash of their ids; a matrix for each dimension."""
    draw = F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = rows.where(draw < size / max(total, 1)).select("vec_id", "embedding").limit(2 * size).collect()
    drawn.sort(key=lambda r: (len(r.embedding), r.vec_id, r.embedding))
    out: dict[int, list] = {}
    for r in drawn:
        out.setdefault(len(r.embedding), []).append(r.embedding)
    return {d: np.array(v, np.float64) for d, v in out.items()}


def squared_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * x @ y.T, 0)


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 0) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = squared_distances(x, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(centres))
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres
