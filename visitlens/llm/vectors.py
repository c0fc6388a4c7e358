"""Reading of embedding tables: usable rows and their scaled integers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite_rows(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is present, without null, NaN or infinite entries and not empty."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.where(v.isNotNull() & (F.size(v) > 0) & ~bad)


def dimension(df: DataFrame, vector: str) -> int:
    """The most frequent length of ``vector`` (of equally frequent ones the longest), or 0."""
    top = (df.groupBy(F.size(vector).alias("d")).agg(F.count("*").alias("n"))
           .orderBy(F.desc("n"), F.desc("d")).first())
    return top["d"] if top else 0


def as_doubles(vector: str) -> Column:
    return F.col(vector).cast("array<double>")


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """(rows, dims) of a list column of doubles without nulls."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def scaled(x: np.ndarray, factor: int, most: int) -> np.ndarray:
    """floor(factor * x) as integers, held within ``most`` of zero."""
    return np.clip(np.floor(factor * x), -most, most).astype(np.int64)


def narrow(x: np.ndarray) -> pa.Array:
    """Rows of integers as binary: the fewest bytes an entry that hold the row, then the entries.

    Equal rows have equal bytes.
    """
    out: list = [None] * len(x)
    low, high = x.min(axis=1), x.max(axis=1)
    width = np.full(len(x), 8)
    for w in (4, 2, 1):
        info = np.iinfo(f"i{w}")
        width[(low >= info.min) & (high <= info.max)] = w
    for w in np.unique(width):
        of = np.flatnonzero(width == w)
        raw = x[of].astype(f"<i{w}").tobytes()
        size = int(w) * x.shape[1]
        for i, r in enumerate(of.tolist()):
            out[r] = bytes((int(w),)) + raw[i * size:(i + 1) * size]
    return pa.array(out, pa.binary())


def wide(column: pa.Array, dims: int) -> np.ndarray:
    """The rows that :func:`narrow` stored."""
    rows = column.to_pylist()
    width = np.array([r[0] for r in rows], np.int64)
    x = np.empty((len(rows), dims), np.int64)
    for w in np.unique(width):
        of = np.flatnonzero(width == w)
        x[of] = np.frombuffer(b"".join(rows[i][1:] for i in of.tolist()),
                              f"<i{w}").reshape(-1, dims)
    return x
