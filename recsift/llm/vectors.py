"""Integer vectors in tiles: what the operators on embeddings share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Scaled components are held within plus and minus this, so that inner products of up to 2 ** 16 components fit 64 bits.
LARGEST = 1 << 23


def scaled(rows: DataFrame, scale: int, id_col: str, vec_col: str, **keep: Column) -> DataFrame:
    """Distinct ``(vec_id long, v array<int>, *keep)``: every component x as floor(scale * x), x as double.

    Rows with a null id, a null vector, or a null or non-finite component take no part. Rows alike in all
    these columns are one row.
    """
    x = F.col(vec_col)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf")))
    whole = F.transform(x, lambda c: F.least(F.greatest(F.floor(c.cast("double") * scale), F.lit(-LARGEST)), F.lit(LARGEST)).cast("int"))
    taken = rows.where(F.col(id_col).isNotNull() & x.isNotNull()).where(finite)
    return taken.select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("v"), *(c.alias(n) for n, c in keep.items())).distinct()


def as_matrix(lists: pa.Array, dims: int) -> np.ndarray:
    """A row per vector; components that a shorter vector lacks are zero."""
    size = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if (size == dims).all():
        return flat.reshape(-1, dims).astype(np.int64)
    out = np.zeros((len(size), dims), np.int64)
    out[np.arange(dims) < size[:, None]] = flat
    return out


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices: in floating point where no sum can be rounded."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2.0**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def slices(keys: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """``(first, last)`` of runs of at most ``size`` rows that share a key, over sorted ``keys``."""
    edges = np.r_[0, np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys)] if len(keys) else np.zeros(1, int)
    for lo, hi in zip(edges[:-1], edges[1:]):
        for first in range(lo, hi, size):
            yield first, min(first + size, hi)


def largest(scores: np.ndarray, ids: np.ndarray, k: int, least: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, score, id)`` of the k largest entries of each row of ``scores`` (all, if fewer), ties to the smaller id.

    Entries below ``least`` of their row, and those equal to the type's smallest number, are left out.
    """
    none = np.iinfo(scores.dtype).min
    limit = np.full(len(scores), none + 1) if least is None else np.maximum(least, none + 1)
    if scores.shape[1] > k:
        limit = np.maximum(limit, np.partition(scores, -k, axis=1)[:, -k])
    row, at = np.nonzero(scores >= limit[:, None])
    got, own = scores[row, at], ids[at]
    order = np.lexsort((own, -got, row))
    row, got, own = row[order], got[order], own[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], got[place < k], own[place < k]
