"""Hard-negative mining with cover trees (operator 13).

Candidates are dealt by (label, hash of the row) into shards of at most
``shard_rows`` rows, each with a cover tree over its norm-augmented vectors
(:mod:`covertree`) that is built once and stored. Anchors, a stated query
set, go through them in blocks: a block of at most about ``anchor_block`` rows
is broadcast, and every shard answers it by a best-first search that opens
only nodes whose bounds meet a window. First the anchors' best rows of the
same label are found (the positives), then for each the best rows of other
labels whose score lies between two shares of the positive's. Every shard
gives its own best; the best of all are ranked in Spark. Results are exact.

Vectors become integers, floor(scale * entry); a score is their inner product.

Edge cases: rows with a null id, null label, or a null, empty or non-finite
vector take no part, nor do rows of another length than the most frequent
one; rows equal in id, label and vector count once; rows of an anchor's own
id are not its positives; scaled entries are held within sqrt(2^62 / length)
of zero, so that a score fits a long; a positive with a score below zero has
an empty window; an empty table, or one without anchors, gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.llm import covertree
from visitlens.llm.frames import Shared, map_batches, saved
from visitlens.llm.vectors import (as_doubles, dimension, finite_rows, matrix, narrow, scaled,
                                   wide)
from visitlens.operators.topk import top_n_per_group
from visitlens.session import materialize

QUERIES = 512          # queries of a block searched together
RESULT = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
          "negative_score long")
NOTHING = np.iinfo(np.int64)


def integer_rows(df: DataFrame, vec_id: str, vector: str, label: str, scale: int,
                 is_anchor: Column) -> tuple[DataFrame, int]:
    """(vec_id, label, anchor, x) of the rows that take part, once each; and the dimension."""
    usable = finite_rows(df.where(F.col(vec_id).isNotNull() & F.col(label).isNotNull()), vector)
    dims = dimension(usable, vector)
    most = math.isqrt((1 << 62) // max(dims, 1))
    names = ["vec_id", "label", "anchor", "x"]

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = scaled(matrix(batch.column(3), dims), scale, most)
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], narrow(x)], names)

    rows = usable.where(F.size(vector) == dims).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"), as_doubles(vector).alias("x"))
    return rows.transform(map_batches, run, "vec_id long, label long, anchor boolean, x binary") \
        .distinct(), dims


def build_shards(rows: DataFrame, dims: int, shard_rows: int = 2048) -> DataFrame:
    """(tree, n): the candidates' cover trees, stored; about two shards a file."""
    tasks = max(1, -(-rows.count() // (2 * shard_rows)))
    order = ["label", "_h"]

    def shard(x, ids, labels):
        tree = covertree.build(np.concatenate(x), np.concatenate(ids), np.concatenate(labels))
        parts = dict(vars(tree))
        top = int(np.abs(tree.x).max(initial=0))
        parts["x"] = tree.x.astype(np.int16 if top < 1 << 15 else np.int64)
        return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(parts)], pa.binary()),
                                           pa.array([len(tree.x)])], ["tree", "n"])

    def run(batches):
        x, ids, labels, held = [], [], [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, min(shard_rows - held, batch.num_rows - at))
                x.append(wide(part.column(2), dims))
                ids.append(part.column(0).to_numpy())
                labels.append(part.column(1).to_numpy())
                at += part.num_rows
                held += part.num_rows
                if held == shard_rows:
                    yield shard(x, ids, labels)
                    x, ids, labels, held = [], [], [], 0
        if held:
            yield shard(x, ids, labels)

    dealt = (rows.select("vec_id", "label", "x").withColumn("_h", F.xxhash64("vec_id", "x"))
             .repartitionByRange(tasks, *order).sortWithinPartitions(*order).drop("_h"))
    return saved(dealt.transform(map_batches, run, "tree binary, n long"), "cover-trees")


def _search(shards: DataFrame, block: tuple, windows: tuple, k: int, same_label: bool
            ) -> DataFrame:
    """(a, w, vec_id, score): each shard's best rows for the block's anchors and windows."""
    shared = Shared(shards.sparkSession, (*block, *windows))

    def run(batches):
        x, ids, labels, low, high = shared.value
        for batch in batches:
            for data in batch.column(0):
                parts = pickle.loads(data.as_py())
                parts["x"] = parts["x"].astype(np.int64)
                tree = covertree.Tree(**parts)
                if same_label:
                    of = np.flatnonzero((labels >= tree.low[0]) & (labels <= tree.high[0]))
                else:
                    of = np.flatnonzero((labels != tree.low[0]) | (labels != tree.high[0]))
                for a in range(0, len(of), QUERIES):
                    q = of[a:a + QUERIES]
                    hits = covertree.search(tree, x[q], ids[q], labels[q], low[q], high[q], k,
                                            same_label)
                    if len(hits.query):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(q[hits.query]), pa.array(hits.window), pa.array(hits.id),
                             pa.array(hits.score)], ["a", "w", "vec_id", "score"])

    return shards.select("tree").transform(map_batches, run,
                                           "a long, w long, vec_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    return top_n_per_group(found, ["a", "w"], [F.desc("score"), "vec_id"], k, "rank")


def _mine_block(shards: DataFrame, block: tuple, positives: int, negatives: int, low: int,
                high: int) -> DataFrame:
    ids = block[1]
    n = len(ids)
    any_score = (np.full((n, 1), NOTHING.min), np.full((n, 1), NOTHING.max))
    best = _best(_search(shards, block, any_score, positives, True), positives).collect()
    pos_id = np.zeros((n, positives), np.int64)
    pos_score = np.zeros((n, positives), np.int64)
    # a window with low above high is empty: anchors with fewer positives keep some
    lows = np.ones((n, positives), np.int64)
    highs = np.zeros((n, positives), np.int64)
    for r in best:
        at = r["a"], r["rank"] - 1
        pos_id[at], pos_score[at] = r["vec_id"], r["score"]
        lows[at], highs[at] = -(-low * r["score"] // 100), high * r["score"] // 100
    shared = Shared(shards.sparkSession, (ids, pos_id, pos_score))

    def name(batches):
        ids, pos_id, pos_score = shared.value
        for batch in batches:
            a, w = (batch.column(c).to_numpy() for c in ("a", "w"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[a]), pa.array(pos_id[a, w]), batch.column("rank"),
                 batch.column("vec_id"), pa.array(pos_score[a, w]), batch.column("score")],
                [c.split()[0] for c in RESULT.split(", ")])

    found = _best(_search(shards, block, (lows, highs), negatives, False), negatives)
    return found.transform(map_batches, name, RESULT)


def mine(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
         is_anchor: Column | None = None, scale: int = 256, positives: int = 5,
         negatives: int = 10, low: int = 30, high: int = 90, shard_rows: int = 2048,
         anchor_block: int = 8192) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` marks the anchors (default: every row whose id is divisible
    by 100). For each anchor and each of its ``positives`` best rows of the
    same label, the ``negatives`` best rows of other labels with
    ``low`` % to ``high`` % of the positive's score.
    """
    spark = df.sparkSession
    if is_anchor is None:
        is_anchor = F.col(vec_id) % 100 == 0
    rows, dims = integer_rows(df, vec_id, vector, label, scale, is_anchor)
    rows = saved(rows, "integer-rows")
    shards = build_shards(rows, dims, shard_rows)
    blocks = max(1, -(-rows.where("anchor").count() // anchor_block))
    anchors = saved(rows.where("anchor").select(
        "vec_id", "label", "x", F.pmod(F.xxhash64("vec_id", "x", "label"), F.lit(blocks))
        .alias("block")), "anchors")
    paths: list[str] = []
    for b in range(blocks):
        got = anchors.where(F.col("block") == b).select("vec_id", "label", "x").toArrow()
        if got.num_rows:
            block = (wide(got.column("x").combine_chunks(), dims),
                     got.column("vec_id").to_numpy(), got.column("label").to_numpy())
            materialize(_mine_block(shards, block, positives, negatives, low, high),
                        "llm-hard-negatives", paths)
    return spark.read.schema(RESULT).parquet(*paths) if paths else \
        spark.createDataFrame([], RESULT)
