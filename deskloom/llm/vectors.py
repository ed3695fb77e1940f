"""Vectors as integer arrays, shared by the exact search and the mining of negatives."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# sums of products stay exact in double precision below this
EXACT = 2**53


def usable(vec: Column) -> Column:
    """The vector and all of its components are there and finite."""
    odd = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return vec.isNotNull() & ~odd


def floored(vec: Column, scale: int) -> Column:
    """floor(scale * x) of every component, as an array of bigint."""
    return F.transform(vec, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))


def measure(vectors: DataFrame, vec: str) -> tuple[int, int, int]:
    """Rows, the longest length, and the largest squared norm of an array column of bigint.

    Scores are sums of products, exact in double precision as long as the largest squared norm
    is below 2**53 (they are bounded by it); larger components are refused.
    """
    # in double precision, so that a component of any size is seen and refused
    norm = F.aggregate(vec, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    rows, dims, most = vectors.agg(F.count(F.lit(1)), F.max(F.size(vec)), F.max(norm)).first()
    if most is not None and most >= EXACT:
        raise ValueError("components are too large for exact scores in double precision")
    return rows, dims or 0, int(most or 0)


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A list column as a matrix of doubles; shorter vectors are padded with zeros."""
    sizes = np.asarray(column.value_lengths())
    flat = np.asarray(column.flatten(), dtype=np.float64)
    if (sizes == dims).all():
        return flat.reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims))
    starts = np.cumsum(sizes) - sizes
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(flat)) - np.repeat(starts, sizes)] = flat
    return out


def unpack(blobs: list[bytes], dims: int) -> np.ndarray:
    """Vectors of 32-bit integers, packed one after another, as a matrix of doubles."""
    return np.frombuffer(b"".join(blobs), np.int32).reshape(-1, dims).astype(np.float64)
