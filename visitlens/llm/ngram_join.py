"""N-gram Jaccard self-join by a token-group matrix (operator 9).

Equal shingle sets are one class, and one set per class goes on. Similar
sets are partitioned into groups in two steps:

1. minhash bands deal the sets to clusters: sets that share a band are
   linked to the smallest set of the band (never to each other), and
   connected sets form a cluster. With 32 bands of 4 hashes a pair of the
   threshold's similarity 0.85 shares no band with probability
   (1 - 0.85^4)^32 < 1e-10, so the cluster holds every partner of its sets;
2. within a cluster, blocks of at most about ``block`` sets are dealt out,
   and a task gets two blocks. There the sets are grouped by their smallest
   token hash, each group stores the union of its tokens (a row of the
   token-group matrix), a set's overlap with a union bounds its overlap with
   the group's members, and only groups whose bound reaches the threshold
   are opened for the exact test in integers.

A task reports its links as a spanning forest plus a number per set, so the
pairs of a group are never written out. Links between classes and the
classes' documents give the components.

Edge cases: sets without tokens (null or empty texts) are linked with
nothing and are their own component each; rows with a null doc_id count as
members but a component takes its smallest non-null id; repeated rows are
copies; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.llm.frames import components, map_batches, saved
from visitlens.llm.text import (Rolling, U, WordHasher, byte_table, lower_table, mix64,
                                row_counts, slices, string_buffer, word_bounds)


class Shingler:
    """Distinct shingle hashes of each row, ascending."""

    def __init__(self, n: int):
        self.n = n
        self.hash, self.roll = WordHasher(7), Rolling(8)
        self.table, self.lower = byte_table("space"), lower_table()

    def __call__(self, data, offs):
        data = self.lower[data]
        s, e, row = word_bounds(data, offs, self.table)
        rows = len(offs) - 1
        counts = row_counts(row, rows)
        first = np.cumsum(counts) - counts
        # one shingle per word with n words from it on, or the whole of a short text
        per = np.where(counts == 0, 0, np.maximum(counts - self.n + 1, 1))
        doc = np.repeat(np.arange(rows), per)
        start = first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
        end = np.minimum(start + self.n, first[doc] + counts[doc])
        token = self.roll.ranges(self.hash(data, s, e), start, end)
        order = np.lexsort((token, doc))
        token, doc = token[order], doc[order]
        new = np.ones(len(doc), bool)
        new[1:] = (token[1:] != token[:-1]) | (doc[1:] != doc[:-1])
        return token[new], row_counts(doc[new], rows)


def _signatures(n: int, bands: int, per_band: int):
    """Set size, 128-bit set key and band hashes of each document."""
    def run(batches):
        shingler = Shingler(n)
        mult = mix64(np.arange(1, bands * per_band + 1, dtype=U) * U(0xA24BAED4963EE407)) | U(1)
        for batch in batches:
            data, offs = string_buffer(batch.column(1))
            for a, b in slices(offs):
                token, size = shingler(data[offs[a]:offs[b]], offs[a:b + 1] - offs[a])
                has = np.flatnonzero(size)
                at = (np.cumsum(size) - size)[has]
                lo, hi = np.zeros(b - a, U), np.zeros(b - a, U)
                band = np.zeros((b - a, bands), U)
                if len(has):
                    lo[has] = np.add.reduceat(mix64(token), at)
                    hi[has] = np.add.reduceat(mix64(token ^ U(0x5851F42D4C957F2D)), at)
                    for k in range(bands):
                        h = np.full(len(has), U(k + 1))
                        for j in range(per_band):
                            m = mult[k * per_band + j]
                            h = mix64(h ^ np.minimum.reduceat((token * m) ^ (token >> U(29)), at))
                        band[has, k] = h
                lists = pa.FixedSizeListArray.from_arrays(
                    pa.array(band.reshape(-1).view(np.int64)), bands).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a),
                    batch.column(3).slice(a, b - a), pa.array(size),
                    pa.array(lo.view(np.int64)), pa.array(hi.view(np.int64)), lists],
                    names=["doc_id", "_k1", "_k2", "size", "lo", "hi", "bands"])
    return run


def _sets(n: int):
    """The shingle sets of the clustered texts, once per text and slice."""
    def run(batches):
        shingler = Shingler(n)
        for batch in batches:
            data, offs = string_buffer(batch.column("text"))
            for a, b in slices(offs):
                token, size = shingler(data[offs[a]:offs[b]], offs[a:b + 1] - offs[a])
                at = np.concatenate([[0], np.cumsum(size)])
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(c).slice(a, b - a) for c in
                      ("set", "cluster", "blocks", "block", "copies")),
                    pa.Array.from_buffers(pa.binary(), b - a, [
                        None, pa.py_buffer((8 * at).astype(np.int32).tobytes()),
                        pa.py_buffer(token.tobytes())])],
                    names=["set", "cluster", "blocks", "block", "copies", "tokens"])
    return run


def token_group_links(sets: list[np.ndarray], block: np.ndarray, num: int, den: int):
    """Pairs (i, j) with ``den * intersection >= num * union``, i < j, that this task owns.

    ``block`` is 0 or 1; with both present only pairs across them are owned.
    """
    token, doc = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    size = np.array([len(s) for s in sets])
    uniq, col, df = np.unique(token, return_inverse=True, return_counts=True)
    group_key = np.array([s[0] for s in sets])
    _, group = np.unique(np.stack([group_key, block.astype(U)], 1), axis=0, return_inverse=True)
    group = group.reshape(-1)
    # tokens in one set only can match nothing
    common = df > 1
    col_of = np.cumsum(common) - 1
    use = common[col]
    doc, col = doc[use], col_of[col[use]]
    n, m, g = len(sets), int(common.sum()), int(group.max()) + 1
    across = block.min() != block.max()
    found = []
    bound = np.zeros((n, g), np.int64)
    step = max(1, (1 << 22) // max(n, 1))
    order = np.argsort(col, kind="stable")
    doc, col = doc[order], col[order]
    edges = np.searchsorted(col, np.arange(0, m + step, step))
    for a, b, base in zip(edges[:-1], edges[1:], range(0, m, step)):
        wide = min(step, m - base)
        x = np.zeros((n, wide), np.float32)
        x[doc[a:b], col[a:b] - base] = 1
        union = np.zeros((g, wide), np.float32)
        np.maximum.at(union, group, x)
        bound += (x @ union.T).astype(np.int64)
    # a member s needs den*|q&s| >= num*(|q|+|s|-|q&s|) and |s| >= |q&s|, so |q&s| >= num/den |q|
    open_ = bound * den >= num * size[:, None]
    members = np.argsort(group, kind="stable")
    first = np.searchsorted(group[members], np.arange(g + 1))
    rows = [col[s] for s in np.split(np.arange(len(col))[np.argsort(doc, kind="stable")],
                                     np.cumsum(np.bincount(doc, minlength=n))[:-1])]
    for k in range(g):
        mine = members[first[k]:first[k + 1]]
        asks = np.flatnonzero(open_[:, k])
        if across:
            asks = asks[block[asks] == 0] if block[mine[0]] == 1 else asks[:0]
        if not len(asks):
            continue
        cols = np.unique(np.concatenate([rows[i] for i in mine]))
        if not len(cols):
            continue

        def matrix(ids):
            size_of = [len(rows[i]) for i in ids]
            r = np.repeat(np.arange(len(ids)), size_of)
            c = np.concatenate([rows[i] for i in ids])
            at = np.minimum(np.searchsorted(cols, c), len(cols) - 1)
            ok = cols[at] == c
            x = np.zeros((len(ids), len(cols)), np.float32)
            x[r[ok], at[ok]] = 1
            return x

        inner = (matrix(asks) @ matrix(mine).T).astype(np.int64)
        union = size[asks][:, None] + size[mine][None, :] - inner
        i, j = np.nonzero(inner * den >= num * union)
        i, j = asks[i], mine[j]
        # each side of a pair passes its bound, so one of the two is enough
        keep = i < j if not across else np.ones(len(i), bool)
        found.append(np.stack([np.minimum(i, j)[keep], np.maximum(i, j)[keep]], 1))
    if not found:
        return np.zeros((0, 2), np.int64)
    return np.unique(np.concatenate(found), axis=0)


def _join_blocks(num: int, den: int):
    """Streams (cluster, x, y) runs: links as a forest, and partners per set."""
    def solve(run_rows):
        sets = [np.frombuffer(r["tokens"], U) for r in run_rows]
        ids = np.array([r["set"] for r in run_rows], np.int64)
        copies = np.array([r["copies"] for r in run_rows], np.int64)
        x, y = run_rows[0]["x"], run_rows[0]["y"]
        side = np.array([0 if r["block"] == x else 1 for r in run_rows]) if x != y \
            else np.zeros(len(ids), np.int64)
        links = token_group_links(sets, side, num, den) if len(sets) > 1 \
            else np.zeros((0, 2), np.int64)
        partners = np.zeros(len(ids), np.int64)
        np.add.at(partners, links[:, 0], copies[links[:, 1]])
        np.add.at(partners, links[:, 1], copies[links[:, 0]])
        root = list(range(len(ids)))

        def find(i):
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i
        out = []
        for i, j in links.tolist():
            a, b = find(i), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((ids[i], ids[j]))
        linked = np.flatnonzero(partners)
        return pa.RecordBatch.from_arrays([
            pa.array([a for a, _ in out] + ids[linked].tolist(), pa.int64()),
            pa.array([b for _, b in out] + [None] * len(linked), pa.int64()),
            pa.array([0] * len(out) + partners[linked].tolist(), pa.int64())],
            names=["a", "b", "partners"])

    def run(batches):
        rows: list = []
        key = None
        for batch in batches:
            for r in batch.to_pylist():
                now = (r["cluster"], r["x"], r["y"])
                if now != key and rows:
                    yield solve(rows)
                    rows = []
                key = now
                rows.append(r)
        if rows:
            yield solve(rows)
    return run


def similar_documents(docs: DataFrame, **how) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) for documents (doc_id, text).

    Two documents link when ``den * |intersection| >= num * |union|`` of
    their distinct ``n``-word shingles; n_links counts the linked documents.
    ``how`` as in :func:`similar_rows`.
    """
    return similar_rows(docs, **how).select("doc_id", "n_shingles", "component_id", "n_links")


def copies_to_drop(docs: DataFrame, **how) -> DataFrame:
    """Keys (doc_id, _k1, _k2) of the rows that are not the first of their component.

    The first is the one of the smallest non-null doc_id, of equal ids the one
    with the smallest text keys, so a component of null ids keeps a row too.
    Rows that repeat the first's id and text have its key and are not listed;
    rows without words are alone in their component.
    """
    rows = saved(similar_rows(docs, **how).where("group is not null").select(
        "doc_id", "_k1", "_k2", "group"), "members")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_k1", "_k2")
    first = saved(rows.groupBy("group").agg(F.min(order).alias("first"),
                                            F.max(order).alias("last"))
                  .where("first <> last").select("group", "first"), "firsts")
    return rows.join(first, "group").where(order != F.col("first")).select(
        "doc_id", "_k1", "_k2").distinct()


def similar_rows(docs: DataFrame, n: int = 4, num: int = 85, den: int = 100,
                 bands: int = 32, per_band: int = 4, block: int = 512) -> DataFrame:
    """As :func:`similar_documents`, with the text's keys ``_k1``, ``_k2`` (xxhash64 and
    hash) and ``group``, a number of the component (null for rows without words)."""
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("_k1"),
                        F.hash("text").alias("_k2"))
    sig = saved(keyed.transform(map_batches,
        _signatures(n, bands, per_band),
        "doc_id long, _k1 long, _k2 int, size long, lo long, hi long, bands array<long>"), "sets")
    # a class per distinct set: its id is the smallest text key, which finds its text again
    classes = saved(sig.where("size > 0").groupBy("lo", "hi", "size").agg(
        F.count("*").alias("copies"), F.min(F.struct("_k1", "_k2")).alias("text"),
        F.min("doc_id").alias("min_id"), F.min("bands").alias("bands"))
        .withColumn("set", F.xxhash64("lo", "hi", "size")), "classes")
    band = classes.select("set", F.posexplode("bands").alias("k", "h")) \
        .select("set", F.xxhash64("k", "h").alias("h"))
    leads = saved(band.groupBy("h").agg(F.min("set").alias("lead"), F.count("*").alias("n"))
                  .where("n > 1").select("h", "lead"), "bands")
    near = components(band.join(leads, "h").where("set <> lead")
                      .select(F.col("set").alias("a"), F.col("lead").alias("b")).distinct())
    sizes = near.groupBy("comp").agg(F.count("*").alias("m"))
    near = saved(near.join(sizes, "comp").select(
        F.col("node").alias("set"), F.col("comp").alias("cluster"),
        F.ceil(F.col("m") / block).cast("int").alias("blocks"))
        .withColumn("block", F.expr("cast(pmod(xxhash64(set, 3), blocks) as int)")), "clusters")
    wanted = near.join(classes.select("set", "copies", "text"), "set").select(
        "set", "cluster", "blocks", "block", "copies",
        F.col("text._k1").alias("_k1"), F.col("text._k2").alias("_k2"))
    sets = keyed.select("text", "_k1", "_k2").join(wanted, ["_k1", "_k2"]).select(
        "set", "cluster", "blocks", "block", "copies", "text").transform(map_batches,
        _sets(n), "set long, cluster long, blocks int, block int, copies long, tokens binary") \
        .groupBy("set").agg(*(F.first(c).alias(c) for c in
                              ("cluster", "blocks", "block", "copies", "tokens")))
    # a set goes to the pairs of its block with each block of the cluster
    dealt = sets.withColumn("o", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        "set", "cluster", F.least("block", "o").alias("x"), F.greatest("block", "o").alias("y"),
        "block", "copies", "tokens")
    links = saved(dealt.repartition("cluster", "x", "y").sortWithinPartitions("cluster", "x", "y")
                  .transform(map_batches, _join_blocks(num, den),
                             "a long, b long, partners long"), "links")
    comp = components(links.where("b is not null").select("a", "b"))
    partners = links.where("b is null").groupBy(F.col("a").alias("set")).agg(
        F.sum("partners").alias("partners"))
    info = classes.select("set", "lo", "hi", "size", "min_id", "copies").join(
        comp.select(F.col("node").alias("set"), "comp"), "set", "left").join(
        partners, "set", "left").select(
        "lo", "hi", "size", "min_id", F.coalesce("comp", "set").alias("comp"),
        (F.col("copies") - 1 + F.coalesce("partners", F.lit(0))).alias("n_links"))
    info = saved(info, "components")
    smallest = info.groupBy("comp").agg(F.min("min_id").alias("component_id"))
    info = saved(info.join(smallest, "comp").select(
        "lo", "hi", "size", "comp", "component_id", "n_links"), "answer")
    return sig.join(info, ["lo", "hi", "size"], "left").select(
        "doc_id", "_k1", "_k2", F.col("comp").alias("group"), F.col("size").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
