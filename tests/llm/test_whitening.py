"""Operator 12 against brute force in unbounded integers and numpy."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from visitlens.llm import whitening
from visitlens.llm.queries import op12_whitening
from visitlens.llm.vectors import narrow, wide

SCHEMA = "vec_id long, embedding array<float>, label int"


def _exact(vectors):
    """(n, sums, covariance) of the distinct integer vectors, by plain loops."""
    fit = sorted({tuple(math.floor(64 * c) + 1_000_000 for c in v) for v in vectors})
    n, d = len(fit), len(fit[0])
    s = [sum(x[a] for x in fit) for a in range(d)]
    cov = [[Fraction(sum((n * x[a] - s[a]) * (n * x[b] - s[b]) for x in fit), n ** 3)
            for b in range(d)] for a in range(d)]
    return n, s, cov


def _check(rows, vectors, components=16):
    """``rows`` of the operator against the exact covariance of {id: vector}."""
    n, s, cov = _exact(vectors.values())
    d = len(s)
    v = np.array([[float(c) for c in r] for r in cov])
    e = np.linalg.eigvalsh(v)[::-1]
    trace = float(sum(cov[a][a] for a in range(d)))
    k = min(components, int((e > 1e-12 * trace).sum()))
    got = {}
    for r in rows:
        got.setdefault(r.vec_id, {})[r.component] = r
    assert got.keys() == vectors.keys() and len(rows) == k * len(vectors)
    for i, by in got.items():
        x = [math.floor(64 * c) + 1_000_000 for c in vectors[i]]
        assert sorted(by) == list(range(1, k + 1))
        for c, r in by.items():
            assert r.n == n and r.deviation == sum((n * x[a] - s[a]) ** 2 for a in range(d))
            assert r.explained == pytest.approx(e[c - 1] / trace, rel=1e-9)
            assert 0 <= r.identity_error < 1e-6
    # the projections are those of one orthonormal system: fit it from the rows
    ids = sorted(got)
    centred = np.array([[math.floor(64 * c) + 1_000_000 - s[a] / n
                         for a, c in enumerate(vectors[i])] for i in ids])
    z = np.array([[got[i][c].whitened for c in range(1, k + 1)] for i in ids]) * np.sqrt(e[:k])
    axes, *_ = np.linalg.lstsq(centred, z, rcond=None)
    assert np.allclose(centred @ axes, z, atol=1e-6 * math.sqrt(trace))
    if len({tuple(v) for v in vectors.values()}) > d:
        assert np.allclose(axes.T @ axes, np.eye(k), atol=1e-6)
        assert np.allclose(v @ axes, axes * e[:k], atol=1e-6 * e[0])


def _vectors(rng, n, d, spread=0.3):
    mix = np.array([[rng.gauss(0, spread) for _ in range(d)] for _ in range(d)])
    return {i: [float(np.float32(c)) for c in
                np.array([rng.gauss(0, 1) for _ in range(d)]) @ mix] for i in range(n)}


def test_popcounts_are_the_cross_products():
    rng = np.random.default_rng(4)
    y = rng.integers(0, [1, 2, 300, 7, 1], (131, 5))
    bits = np.array([int(c).bit_length() for c in y.max(axis=0)])
    first = np.cumsum(bits) - bits
    both = whitening.popcounts(y, bits, first)
    dim = np.repeat(np.arange(5), bits)
    for i in range(len(dim)):
        for j in range(i, len(dim)):
            a = y[:, dim[i]] >> (i - first[dim[i]]) & 1
            b = y[:, dim[j]] >> (j - first[dim[j]]) & 1
            assert both[i, j] == (a & b).sum()


def test_narrow_rows_come_back():
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.integers(-b, b, (9, 3)) for b in (2, 128, 129, 1 << 20, 1 << 50)])
    assert (wide(narrow(x), 3) == x).all()
    assert narrow(x[:1])[0].as_py() == narrow(x[:1].copy())[0].as_py()


def test_whitening_equals_brute_force(spark):
    rng = random.Random(12)
    for n, d in ((300, 5), (700, 20), (90, 3)):
        vectors = _vectors(rng, n, d)
        rows = [(i, v, 0) for i, v in vectors.items()]
        df = spark.createDataFrame(rows, SCHEMA).repartition(5)
        _check(whitening.whiten(df).collect(), vectors)


def test_copies_count_once_in_the_fit_and_each_get_rows(spark):
    vectors = _vectors(random.Random(3), 60, 4)
    hot = vectors[0]
    vectors |= {1000 + i: hot for i in range(400)}
    # other floats, equal integers
    vectors |= {2000 + i: [float(np.float32((math.floor(64 * c) + 0.5) / 64)) for c in hot]
                for i in range(50)}
    df = spark.createDataFrame([(i, v, 0) for i, v in vectors.items()], SCHEMA).repartition(7)
    rows = whitening.whiten(df).collect()
    _check(rows, vectors)
    assert {r.n for r in rows} == {60}


def test_far_from_zero_is_exact(spark):
    rng = random.Random(5)
    vectors = {i: [float(np.float32(1e9 + 4096 * rng.randint(0, 3))), rng.random(),
                   -float(np.float32(3e7 + 64 * rng.randint(0, 9)))] for i in range(64)}
    vectors = {i: [float(np.float32(c)) for c in v] for i, v in vectors.items()}
    n, s, cov = _exact(vectors.values())
    df = spark.createDataFrame([(i, v, 0) for i, v in vectors.items()], SCHEMA).repartition(3)
    usable = whitening.integer_rows(df, "vec_id", "embedding", 3)
    got_n, sums, prods = whitening.scatter(spark, usable.select("x").distinct(), 3)
    assert (got_n, [v + n * 1_000_000 for v in sums]) == (n, s)
    for a in range(3):
        for b in range(3):
            assert Fraction(n * prods[a][b] - sums[a] * sums[b], n * n) == cov[a][b]
    dev = {r.vec_id: r.deviation for r in whitening.whiten(df).collect()}
    for i, v in vectors.items():
        want = sum((n * (math.floor(64 * c) + 1_000_000) - s[a]) ** 2 for a, c in enumerate(v))
        assert dev[i] == (want if want < 1 << 63 else None)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    base = {i: v for i, v in _vectors(random.Random(8), 40, 3).items()}
    rows = [(i, v, None) for i, v in base.items()] + [
        (100, None, 1), (101, [1.0, None, 2.0], 1), (102, [nan, 1.0, 1.0], 1),
        (103, [inf, 1.0, 1.0], 1), (104, [-inf, 1.0, 1.0], None), (105, [], 1),
        (106, [1.0, 2.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("x", "n", "component", "whitened", "d", "k", "deviation"):
        df = df.withColumn(name, df["label"])
    _check(whitening.whiten(df).collect(), base)
    # repeated rows and null ids
    twice = spark.createDataFrame([(1, [0.0, 1.0], 0), (1, [0.0, 1.0], 0),
                                   (None, [1.0, 0.5], 0)], SCHEMA)
    got = whitening.whiten(twice).collect()
    assert sorted((r.vec_id is None, r.component) for r in got) == \
        [(False, 1), (False, 1), (True, 1)]
    # nothing to whiten: one distinct vector, or none
    assert whitening.whiten(df.limit(1)).count() == 0
    none = spark.createDataFrame([], SCHEMA)
    assert whitening.whiten(none).count() == 0
    assert whitening.whiten(df.where("vec_id > 99 and vec_id < 106")).count() == 0


def test_constant_dimensions_have_no_component(spark):
    vectors = {i: [0.25, i / 64.0, 0.5, (i * i % 7) / 64.0] for i in range(30)}
    df = spark.createDataFrame([(i, v, 0) for i, v in vectors.items()], SCHEMA)
    rows = whitening.whiten(df).collect()
    assert {r.component for r in rows} == {1, 2}


def test_query_reads_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    out = op12_whitening(spark, sf)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained",
                           "identity_error"]
    _check(out.collect(), {r.vec_id: [float(c) for c in r.embedding] for r in table})
