"""Embedding whitening from exact bit-sliced scatter sums (operator 12).

Entries become integers (floor(64 c) + 1,000,000); the fit list is each
distinct vector once. For the scatter matrix

1. every dimension is shifted by its minimum over the fit list, so its
   numbers are small and not negative;
2. a task packs the bits of 64 rows of a dimension's bit plane into a word;
   the popcount of two planes' AND counts the rows with both bits, and the
   sum of 2^(p + q) times those counts is the exact cross-product of two
   dimensions. Counts are summed by (dimension, dimension, p + q), so no
   sum overflows; the driver gets at most dims^2 / 2 of them times twice the
   bits, however many rows there are;
3. n * sum(x x') - S S' is formed in unbounded integers and only then
   divided by n^2: the covariance, rounded once an entry;
4. one task finds its eigenvectors (``eigh``, not in the driver, where a
   threaded BLAS may block for ever beside the JVM). Of either sign, the one
   whose largest entry is positive is taken, for all rows.

Another pass over the fit list sums products of the whitened values, which
gives the ``identity_error`` that was really reached.

Edge cases: rows with a null, empty or non-finite vector are left out, so are
rows of another length than the most frequent one; repeated rows and null or
repeated ids each give their rows; scaled entries are held within 2^52 of
zero; components whose eigenvalue is not above 1e-12 of the trace (constant
or dependent dimensions, a single vector) cannot be whitened and are not
returned; ``deviation`` is null where it exceeds a long; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm.frames import Shared, map_batches, saved
from visitlens.llm.vectors import (as_doubles, dimension, finite_rows, matrix, narrow, scaled,
                                   wide)

SCALE = 64
OFFSET = 1_000_000
MOST = 1 << 52
ROWS = 1 << 14


def integer_rows(df: DataFrame, vec_id: str, vector: str, dims: int) -> DataFrame:
    """(vec_id, x): the usable rows, x the scaled entries (without the offset) as bytes."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = scaled(matrix(batch.column(1), dims), SCALE, MOST)
                yield pa.RecordBatch.from_arrays([batch.column(0), narrow(x)], ["vec_id", "x"])

    rows = df.where(F.size(vector) == dims).select(
        F.col(vec_id).cast("long").alias("vec_id"), as_doubles(vector).alias("x"))
    return rows.transform(map_batches, run, "vec_id long, x binary")


def popcounts(y: np.ndarray, bits: np.ndarray, first: np.ndarray):
    """For non-negative ``y`` (rows, dims): rows with both bits, for all pairs of planes.

    ``bits`` and ``first`` give a dimension's number of planes and its first
    one. Returns (counts of one plane, counts of two planes by plane).
    """
    planes = np.zeros((int(bits.sum()), -(-len(y) // 64)), np.uint64)
    for p in range(int(bits.max(initial=0))):
        of = np.flatnonzero(bits > p)
        plane = np.packbits(((y[:, of] >> p) & 1).astype(np.uint8), axis=0)
        pad = np.zeros((planes.shape[1] * 8, len(of)), np.uint8)
        pad[:len(plane)] = plane
        planes[first[of] + p] = np.ascontiguousarray(pad.T).view(np.uint64)
    both = np.zeros((len(planes), len(planes)), np.int64)
    for i in range(len(planes)):
        both[i, i:] = np.bitwise_count(planes[i] & planes[i:]).sum(axis=1, dtype=np.int64)
    return both


@dataclass
class Whitening:
    """What :func:`fit` learned; ``sums`` are of x without the offset."""
    dims: int
    n: int
    sums: list
    values: np.ndarray         # eigenvalues, falling
    vectors: np.ndarray        # (dims, components)
    explained: np.ndarray
    identity_error: float = 0.0


def _range(spark: SparkSession, fit_list: DataFrame, dims: int):
    """Each dimension's minimum and number of bit planes, and the number of rows."""
    def run(batches):
        low, high, n = None, None, 0
        for batch in batches:
            if batch.num_rows:
                x = wide(batch.column(0), dims)
                a, b = x.min(axis=0), x.max(axis=0)
                low = a if low is None else np.minimum(low, a)
                high = b if high is None else np.maximum(high, b)
                n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(dims, dtype=np.int32)), pa.array(low), pa.array(high),
                pa.array(np.full(dims, n))], ["d", "low", "high", "n"])

    got = (fit_list.transform(map_batches, run, "d int, low long, high long, n long")
           .groupBy("d").agg(F.min("low").alias("low"), F.max("high").alias("high"),
                             F.sum("n").alias("n")).orderBy("d").collect())
    low = np.array([r["low"] for r in got], np.int64)
    bits = np.array([int(r["high"] - r["low"]).bit_length() for r in got], np.int64)
    return low, bits, (got[0]["n"] if got else 0)


def scatter(spark: SparkSession, fit_list: DataFrame, dims: int):
    """(n, sums, sums of products) of the fit list in unbounded integers."""
    low, bits, n = _range(spark, fit_list, dims)
    if not n:
        return 0, [], []
    first = np.cumsum(bits) - bits
    dim = np.repeat(np.arange(dims), bits)
    bit = np.arange(len(dim)) - first[dim]
    i, j = np.triu_indices(len(dim))
    # pairs of planes by (dimension, dimension, p + q); one plane alone as (dimension, -1, p)
    code = (dim[i] * dims + dim[j]) * 128 + bit[i] + bit[j]
    keys, slot = np.unique(code, return_inverse=True)
    weight = np.where((dim[i] == dim[j]) & (bit[i] != bit[j]), 2, 1)
    shared = Shared(spark, (low, bits, first))

    def run(batches):
        low, bits, first = shared.value
        both = np.zeros((len(dim), len(dim)), np.int64)
        rows, held = [], 0

        def count():
            return popcounts(np.concatenate(rows), bits, first)

        for batch in batches:
            if batch.num_rows:
                rows.append(wide(batch.column(0), dims) - low)
                held += len(rows[-1])
            if held >= ROWS:
                both += count()
                rows, held = [], 0
        if held:
            both += count()
        if both.any():
            total = np.zeros(len(keys), np.int64)
            np.add.at(total, slot, both[i, j] * weight)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([keys, -1 - np.arange(len(dim))])),
                pa.array(np.concatenate([total, np.diag(both)]))], ["k", "n"])

    counts = {r["k"]: r["n"] for r in fit_list.transform(map_batches, run, "k long, n long")
              .groupBy("k").agg(F.sum("n").alias("n")).collect()}
    y_sum = [0] * dims
    for p in range(len(dim)):
        y_sum[dim[p]] += counts.get(-1 - p, 0) << int(bit[p])
    y_prod = [[0] * dims for _ in range(dims)]
    for k, c in counts.items():
        if k >= 0:
            pair, s = divmod(k, 128)
            a, b = divmod(pair, dims)
            y_prod[a][b] += c << s
    lows = [int(v) for v in low]
    sums = [y_sum[a] + n * lows[a] for a in range(dims)]
    prods = [[0] * dims for _ in range(dims)]
    for a in range(dims):
        for b in range(a, dims):
            prods[a][b] = prods[b][a] = (y_prod[a][b] + lows[a] * y_sum[b] + lows[b] * y_sum[a]
                                         + n * lows[a] * lows[b])
    return n, sums, prods


def eigen(spark: SparkSession, cov: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a symmetric matrix, found in one task."""
    d = len(cov)
    shared = Shared(spark, cov)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                values, vectors = np.linalg.eigh(shared.value)
                yield pa.RecordBatch.from_arrays([pa.array(
                    [values.tobytes() + np.ascontiguousarray(vectors).tobytes()])], ["e"])

    raw = np.frombuffer(spark.range(1, numPartitions=1).mapInArrow(run, "e binary").first()["e"])
    values, vectors = raw[:d][::-1].copy(), raw[d:].reshape(d, d)[:, ::-1].copy()
    top = np.abs(vectors).argmax(axis=0)
    return values, vectors * np.where(vectors[top, np.arange(d)] < 0, -1.0, 1.0)


def _centred(x: np.ndarray, n: int, sums: list) -> np.ndarray:
    """n * x - S, exact: machine integers where they hold it, else Python's."""
    most = n * (int(np.abs(x).max(initial=0)) + 1) + max((abs(s) for s in sums), default=0)
    if most < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _whitened(x: np.ndarray, model: Whitening) -> tuple[np.ndarray, np.ndarray]:
    c = _centred(x, model.n, model.sums)
    centred = c.astype(np.float64) / model.n
    out = np.einsum("rd,dk->rk", centred, model.vectors) / np.sqrt(model.values)
    return c, out


def _identity_error(spark: SparkSession, fit_list: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity."""
    k = len(model.values)
    shared = Shared(spark, model)
    pairs = [(-1, b) for b in range(k)] + [(a, b) for a in range(k) for b in range(a, k)]

    def run(batches):
        model, total = shared.value, np.zeros(len(pairs))
        for batch in batches:
            if batch.num_rows:
                _, z = _whitened(wide(batch.column(0), model.dims), model)
                prod = np.einsum("ra,rb->ab", z, z)
                total += np.concatenate([z.sum(axis=0), prod[np.triu_indices(k)]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(pairs), dtype=np.int32)),
                                          pa.array(total)], ["k", "v"])

    got = {r["k"]: r["v"] / model.n for r in
           fit_list.transform(map_batches, run, "k int, v double")
           .groupBy("k").agg(F.sum("v").alias("v")).collect()}
    mean = [got[b] for b in range(k)]
    return max(abs(got[i] - mean[a] * mean[b] - (a == b))
               for i, (a, b) in enumerate(pairs) if a >= 0)


def fit(spark: SparkSession, rows: DataFrame, dims: int, components: int = 16) -> Whitening:
    """Whitening of the distinct vectors of ``rows`` (see :func:`integer_rows`)."""
    fit_list = saved(rows.select("x").distinct(), "fit-list")
    n, sums, prods = scatter(spark, fit_list, dims)
    none = Whitening(dims, n, sums, np.zeros(0), np.zeros((dims, 0)), np.zeros(0))
    if not n:
        return none
    square = n * n
    cov = np.array([[(n * prods[a][b] - sums[a] * sums[b]) / square for b in range(dims)]
                    for a in range(dims)])
    trace = sum(n * prods[a][a] - sums[a] * sums[a] for a in range(dims)) / square
    if trace <= 0:
        return none
    values, vectors = eigen(spark, cov)
    k = min(components, int((values > 1e-12 * trace).sum()))
    model = Whitening(dims, n, sums, values[:k], vectors[:, :k], values[:k] / trace)
    model.identity_error = _identity_error(spark, fit_list, model)
    return model


def transform(rows: DataFrame, model: Whitening) -> DataFrame:
    """One row a vector and component: (vec_id, component, n, deviation, whitened, explained,
    identity_error)."""
    shared = Shared(rows.sparkSession, model)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def run(batches):
        model = shared.value
        k = len(model.values)
        for batch in batches:
            for a in range(0, batch.num_rows if k else 0, ROWS):
                part = batch.slice(a, ROWS)
                c, z = _whitened(wide(part.column(1), model.dims), model)
                if c.dtype != object and int(np.abs(c).max()) ** 2 * model.dims >= 1 << 63:
                    c = c.astype(object)
                dev = (c * c).sum(axis=1)
                if c.dtype == object:
                    dev = np.array([v if v < 1 << 63 else None for v in dev], object)
                m = len(c)
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n)),
                    pa.array(np.repeat(dev, k), pa.int64()), pa.array(z.ravel()),
                    pa.array(np.tile(model.explained, m)),
                    pa.array(np.full(m * k, model.identity_error))], names)

    return rows.transform(map_batches, run,
                          "vec_id long, component int, n long, deviation long, "
                          "whitened double, explained double, identity_error double")


def whiten(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
           components: int = 16) -> DataFrame:
    """Whitened coordinates of all usable rows of ``df`` on its first components."""
    usable = finite_rows(df, vector)
    dims = dimension(usable, vector)
    rows = saved(integer_rows(usable, vec_id, vector, dims), "integer-rows")
    return transform(rows, fit(df.sparkSession, rows, dims, components))
