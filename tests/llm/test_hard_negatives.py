"""Operator 13: cover trees and mined negatives against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from visitlens.llm import covertree, hard_negatives
from visitlens.llm.queries import op13_hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def _below(tree, node):
    return tree.x[tree.begin[node]:tree.end[node]].astype(float)


@pytest.mark.parametrize("spread", [0, 1, 40, 3000])
def test_tree_covers_all_rows(spread):
    rng = np.random.default_rng(spread)
    x = rng.integers(-spread, spread + 1, (900, 6))
    labels = rng.integers(0, 4, 900)
    tree = covertree.build(x, np.arange(900), labels)
    assert sorted(tree.ids.tolist()) == list(range(900))
    assert (x[tree.ids] == tree.x).all() and (labels[tree.ids] == tree.labels).all()
    if not tree.radius:
        return
    for node in range(len(tree.theta)):
        c = tree.x[tree.centre[node]].astype(float)
        pts = _below(tree, node)
        lift = np.sqrt(np.maximum(tree.radius ** 2 - (pts ** 2).sum(axis=1), 0))
        cos = (pts @ c + lift * math.sqrt(max(tree.radius ** 2 - c @ c, 0))) / tree.radius ** 2
        assert np.arccos(np.clip(cos, -1, 1)).max() <= tree.theta[node] + 1e-6
        kids = np.flatnonzero(tree.parent == node)
        assert tree.leaf[node] == (len(kids) == 0)
        if len(kids):
            assert len(kids) <= covertree.FANOUT
            assert sum(tree.end[k] - tree.begin[k] for k in kids) == len(pts)
        mine = labels[tree.ids[tree.begin[node]:tree.end[node]]]
        assert (tree.low[node], tree.high[node]) == (mine.min(), mine.max())


@pytest.mark.parametrize("same", [True, False])
@pytest.mark.parametrize("spread", [1, 30, 100_000])
def test_search_equals_all_scores(spread, same):
    rng = np.random.default_rng(7 + spread)
    centres = rng.integers(-spread, spread + 1, (5, 8))
    labels = rng.integers(0, 5, 700)
    x = centres[labels] + rng.integers(-spread // 3 - 1, spread // 3 + 2, (700, 8))
    tree = covertree.build(x, np.arange(700), labels)
    q = np.arange(0, 700, 20)
    scores = x[q] @ x.T
    low = np.stack([np.percentile(scores, p, axis=1) for p in (10, 60, 90)], axis=1).astype(int)
    high = np.stack([np.percentile(scores, p, axis=1) for p in (50, 97, 20)], axis=1).astype(int)
    hits = covertree.search(tree, x[q], q, labels[q], low, high, 7, same, step=2)
    got = {}
    for a, w, s, i in zip(hits.query, hits.window, hits.score, hits.id):
        got.setdefault((a, w), []).append((-s, i))
    for a in range(len(q)):
        for w in range(3):
            want = sorted((-scores[a, i], i) for i in range(700)
                          if low[a, w] <= scores[a, i] <= high[a, w]
                          and (labels[i] == labels[q[a]]) == same and not (same and i == q[a]))
            assert got.get((a, w), []) == want[:7]
    assert 0 < hits.opened < 3 * scores.size


def test_clustered_rows_are_not_all_opened():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16))
    centres *= 256 / np.linalg.norm(centres, axis=1)[:, None]
    labels = rng.integers(0, 40, 4000)
    x = np.floor(centres[labels] + rng.normal(size=(4000, 16))).astype(np.int64)
    tree = covertree.build(x, np.arange(4000), labels)
    top = np.full((50, 1), 2**62)
    hits = covertree.search(tree, x[:50], np.arange(50), labels[:50], -top, top, 5, True)
    assert len(hits.query) == 250 and hits.opened < 0.1 * 50 * 4000


def _brute(rows, every=100):
    """All-pairs result of (vec_id, vector, label) rows that take part."""
    rows = [(i, [math.floor(256 * c) for c in v], lab) for i, v, lab in rows]
    out = []
    for a, x, lab in rows:
        if a % every:
            continue
        score = sorted((-sum(p * q for p, q in zip(x, y)), i, m) for i, y, m in rows)
        for ps, p in [(-s, i) for s, i, m in score if m == lab and i != a][:5]:
            near = [(-s, i) for s, i, m in score if m != lab and 30 * ps <= -100 * s <= 90 * ps]
            out += [(a, p, r, i, ps, s) for r, (s, i) in enumerate(near[:10], 1)]
    return sorted(out)


def _vectors(rng, n, d, labels, tie=False):
    centres = [[rng.gauss(0, 1) for _ in range(d)] for _ in range(labels)]
    rows = []
    for i in range(n):
        lab = rng.randrange(labels) if rng.random() < 0.6 else 0
        v = [float(np.float32(0.3 * c + 0.2 * rng.gauss(0, 1))) for c in centres[lab]]
        rows.append((i, [round(c, 1) for c in v] if tie else v, lab))
    return [(i, [float(np.float32(c)) for c in v], lab) for i, v, lab in rows]


@pytest.mark.parametrize("tie", [False, True])
def test_mining_equals_brute_force(spark, tie):
    rows = _vectors(random.Random(2), 700, 8, 5, tie)
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = hard_negatives.mine(df, shard_rows=64, is_anchor=F.col("vec_id") % 20 == 0,
                              anchor_block=9)
    assert sorted(map(tuple, got.collect())) == _brute(rows, 20)


def test_hot_label_and_copies(spark):
    rng = random.Random(4)
    rows = _vectors(rng, 150, 6, 3)
    hot = rows[0][1]
    rows += [(1000 + i, hot, 1) for i in range(400)]
    df = spark.createDataFrame(rows + rows[:40], SCHEMA).repartition(5)  # repeated rows
    got = hard_negatives.mine(df, shard_rows=50)
    assert sorted(map(tuple, got.collect())) == _brute(rows)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    base = _vectors(random.Random(9), 90, 4, 3)
    odd = [(None, [1.0] * 4, 1), (200, [1.0] * 4, None), (300, None, 1),
           (400, [1.0, None, 1.0, 1.0], 1), (500, [nan, 1.0, 1.0, 1.0], 2),
           (600, [inf, 1.0, 1.0, 1.0], 2), (700, [], 1), (800, [1.0, 2.0], 1)]
    df = spark.createDataFrame(base + odd, SCHEMA)
    for name in ("x", "a", "w", "anchor", "block", "rank", "tree", "_h", "n", "score"):
        df = df.withColumn(name, df["label"])
    assert sorted(map(tuple, hard_negatives.mine(df).collect())) == _brute(base)
    assert hard_negatives.mine(spark.createDataFrame([], SCHEMA)).count() == 0
    assert hard_negatives.mine(df.where("vec_id % 100 > 0")).count() == 0
    # an anchor without another row of its label, a positive below zero, entries out of range
    few = [(0, [1.0, 0.0], 1), (100, [1.0, 0.0], 2), (1, [-1.0, 0.0], 2), (2, [0.5, 0.1], 3)]
    got = hard_negatives.mine(spark.createDataFrame(few, SCHEMA))
    assert got.collect() == []
    huge = [(i, [3e38, -3e38 if i % 2 else 1.0], i % 3) for i in range(12)]
    assert hard_negatives.mine(spark.createDataFrame(huge, SCHEMA)).columns[0] == "anchor_id"


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label)
            for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    out = op13_hard_negatives(spark, sf)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                           "negative_score"]
    assert sorted(map(tuple, out.collect())) == _brute(rows)
