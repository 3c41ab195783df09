"""Vectors as rows of numbers: which take part, and how tasks get them as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vec: Column) -> Column:
    """True for vectors without null or non-finite components; false for null vectors."""
    return F.coalesce(vec.isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def one_per_id(rows: DataFrame, *columns: str) -> DataFrame:
    """Of rows of one vec_id the one with the least `columns` (in that order).  Rows without an id are left out."""
    least = rows.filter(F.col("vec_id").isNotNull()).groupBy("vec_id").agg(F.min(F.struct(*columns)).alias("x"))
    return least.select("vec_id", *[f"x.{c}" for c in columns])


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A list column as rows of `dim` doubles; what a shorter vector lacks is 0."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    if len(sizes) * dim == len(flat):
        return flat.reshape(-1, dim)
    out = np.zeros((len(sizes), dim))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def lists_of(rows: np.ndarray) -> pa.Array:
    """Rows of a matrix as a list column."""
    n, dim = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * dim), pa.array(np.ascontiguousarray(rows).ravel()))


def best(k: int, group: np.ndarray, score: np.ndarray, ident: np.ndarray) -> np.ndarray:
    """Places of the first k of each group, higher scores first and of equal ones the smaller ident."""
    order = np.lexsort((ident, -score, group))
    g = group[order]
    start = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else np.zeros(0, np.int64)
    place = np.arange(len(g)) - np.repeat(start, np.diff(np.append(start, len(g))))
    return order[place < k]
