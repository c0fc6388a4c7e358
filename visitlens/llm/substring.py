"""Substring deduplication with suffix automata of reference shards (operator 3).

A passage of ``window`` words that starts anywhere else is removed. A word
window is owned by its anchor, the smallest-hashed run of ``ANCHOR`` words
in it, so equal windows have equal anchors at equal places, and the windows
of one anchor occurrence are consecutive: a context. Steps:

1. anchors of all documents are counted (partial sums before the shuffle);
   an anchor that occurs once owns no repeated window;
2. equal contexts are one, with their number of places; with two places or
   more all its windows repeat;
3. anchors with different contexts go to reference shards. A shard builds
   the suffix automaton of its contexts, weighted by their places, and
   streams those with one place for matching statistics: where the longest
   match with a second place has ``window`` words or more, the window
   ending there is a repeat. The automata are not broadcast, as their size
   follows the corpus; contexts are dealt to them instead;
4. an anchor with more than ``shard_contexts`` different contexts would be one
   unbounded automaton. Its windows are dealt anew by longer anchors, twice
   the words each time, and go through 2 and 3 again; an anchor as long as
   the window has one context, so this ends after a few rounds;
5. repeated windows are merged to maximal spans per distinct text.

Edge cases: null or empty texts have no words; copies of a text count as
many places and get the same spans; texts under ``window`` words keep all;
an empty table gives no rows; other columns stay, but for those named like an
output.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.llm.automaton import SuffixAutomaton
from visitlens.llm.frames import map_batches, saved
from visitlens.llm.text import (Rolling, U, WordHasher, byte_table, mix64, row_counts, slices,
                                string_buffer, word_bounds)

ANCHOR = 6


def _keyed(docs: DataFrame, text_col: str) -> DataFrame:
    """The two keys of a text (96 bits): equal texts share their spans."""
    return docs.withColumns({"_k1": F.xxhash64(text_col), "_k2": F.hash(text_col)})


def _owned(words, row, window: int, anchor_words: int, grams: Rolling, contexts: Rolling):
    """The contexts in word hashes of rows end to end: (first window, windows, anchor, context)."""
    span = window - anchor_words + 1
    n = len(words)
    none = np.zeros(0, np.int64)
    if n < window:
        return none, none, none.astype(U), none.astype(U)
    at = np.arange(n - anchor_words + 1)
    gram = grams.ranges(words, at, at + anchor_words)
    low = (gram >> U(32) << U(32)) | at.astype(U)
    width = 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[:len(low) - (span - width)], low[span - width:])
    valid = np.flatnonzero(row[:n - window + 1] == row[window - 1:])
    if not len(valid):
        return none, none, none.astype(U), none.astype(U)
    owner = (low[valid] & U(0xFFFFFFFF)).astype(np.int64)
    head = np.ones(len(valid), bool)
    head[1:] = (valid[1:] != valid[:-1] + 1) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(head)
    size = np.diff(np.append(at, len(valid)))
    start, anchor = valid[at], owner[at]
    ctx = contexts.ranges(words, start, start + size + window - 1)
    return start, size, gram[anchor], mix64(ctx ^ ((anchor - start) * 65536 + size).astype(U))


def _anchors(window: int):
    def run(batches):
        hasher, grams, contexts = WordHasher(1), Rolling(2), Rolling(3)
        table = byte_table("space")
        for batch in batches:
            data, offs = string_buffer(batch.column(0))
            k1 = batch.column(1).to_numpy()
            k2 = batch.column(2).to_numpy()
            for a, b in slices(offs):
                part = data[offs[a]:offs[b]]
                s, e, row = word_bounds(part, offs[a:b + 1] - offs[a], table)
                start, size, anchor, ctx = _owned(hasher(part, s, e), row, window,
                                                  min(ANCHOR, window), grams, contexts)
                if not len(start):
                    continue
                # copies of a text within the slice go on as one, with their number
                doc = row[start]
                text = np.unique(np.stack([k1[a:b], k2[a:b].astype(np.int64)], 1), axis=0,
                                 return_index=True, return_counts=True)
                times = np.zeros(b - a, np.int64)
                times[text[1]] = text[2]
                keep = times[doc] > 0
                first = np.zeros(b - a, np.int64)
                counts = row_counts(row, b - a)
                first[:] = np.cumsum(counts) - counts
                doc, start, size = doc[keep], start[keep], size[keep]
                yield pa.RecordBatch.from_arrays([
                    pa.array(k1[a:b][doc]), pa.array(k2[a:b][doc]),
                    pa.array((start - first[doc]).astype(np.int32)),
                    pa.array(size.astype(np.int32)),
                    pa.array(anchor[keep].view(np.int64)),
                    pa.array(ctx[keep].view(np.int64)),
                    pa.array(times[doc].astype(np.int32))],
                    names=["_k1", "_k2", "at", "size", "anchor", "ctx", "n"])
    return run


def _contexts(window: int):
    """The words of the listed contexts of each text, once per slice."""
    def run(batches):
        hasher, table = WordHasher(1), byte_table("space")
        for batch in batches:
            data, offs = string_buffer(batch.column("text"))
            facts = batch.column("facts")
            for a, b in slices(offs):
                part = data[offs[a]:offs[b]]
                s, e, row = word_bounds(part, offs[a:b + 1] - offs[a], table)
                words = hasher(part, s, e)
                counts = row_counts(row, b - a)
                first = np.cumsum(counts) - counts
                mine = facts.slice(a, b - a)
                per = np.diff(np.asarray(mine.offsets))
                flat = mine.flatten()
                doc = np.repeat(np.arange(b - a), per)
                pair = np.stack([flat.field("anchor").to_numpy(), flat.field("ctx").to_numpy()], 1)
                once = np.sort(np.unique(pair, axis=0, return_index=True)[1])
                flat, doc = flat.take(pa.array(once)), doc[once]
                at = flat.field("at").to_numpy().astype(np.int64)
                size = flat.field("size").to_numpy().astype(np.int64)
                start = first[doc] + at
                length = size + window - 1
                offsets = np.concatenate([[0], np.cumsum(length)])
                idx = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], length)
                yield pa.RecordBatch.from_arrays([
                    flat.field("anchor"), flat.field("ctx"), flat.field("n"), flat.field("m"),
                    batch.column("_k1").slice(a, b - a).take(pa.array(doc)),
                    batch.column("_k2").slice(a, b - a).take(pa.array(doc)),
                    flat.field("at"),
                    pa.Array.from_buffers(pa.binary(), len(doc), [
                        None, pa.py_buffer((8 * offsets).astype(np.int32).tobytes()),
                        pa.py_buffer(words[idx].tobytes())])],
                    names=["anchor", "ctx", "n", "m", "_k1", "_k2", "at", "words"])
    return run


CONTEXTS = "anchor long, ctx long, n long, m long, _k1 long, _k2 int, at int, words binary"
PARTS = ("anchor long, ctx long, n long, _k1 long, _k2 int, at int, size int, words binary")
RANGES = "_k1 long, _k2 int, first int, last int"


def _ranges(rows, flags, at, k1, k2):
    """Runs of flagged windows (sorted by row) as range rows."""
    f = np.flatnonzero(flags)
    head = np.ones(len(f), bool)
    head[1:] = (f[1:] != f[:-1] + 1) | (rows[f[1:]] != rows[f[:-1]])
    s = f[head]
    e = f[np.append(np.flatnonzero(head)[1:] - 1, len(f) - 1)] if len(f) else f
    return pa.RecordBatch.from_arrays([
        pa.array(k1[rows[s]]), pa.array(k2[rows[s]]), pa.array(at[s].astype(np.int32)),
        pa.array(at[e].astype(np.int32))], names=["_k1", "_k2", "first", "last"])


def _shards(window: int, shard_contexts: int):
    """Automata of consecutive anchors' contexts; emits repeats of contexts with one place."""
    empty = pa.schema([("_k1", pa.int64()), ("_k2", pa.int32()), ("first", pa.int32()),
                       ("last", pa.int32())])

    def resolve(group):
        auto = SuffixAutomaton()
        lists = [np.frombuffer(g[4], np.uint64).tolist() for g in group]
        for g, words in zip(group, lists):
            auto.add(words, g[5])
        auto.finish()
        alone = [i for i, g in enumerate(group) if g[5] == 1]
        flags = [np.array(auto.matching(lists[i])[window - 1:]) >= window for i in alone]
        group = [group[i] for i in alone]
        if not group:
            return pa.RecordBatch.from_pylist([], schema=empty)
        size = np.array([len(f) for f in flags])
        rows = np.repeat(np.arange(len(group)), size)
        at = np.repeat([g[3] for g in group], size) + np.arange(len(rows)) - np.repeat(
            np.cumsum(size) - size, size)
        return _ranges(rows, np.concatenate(flags), at,
                       np.array([g[1] for g in group], np.int64),
                       np.array([g[2] for g in group], np.int32))

    def run(batches):
        group: list = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in
                             ("anchor", "_k1", "_k2", "at", "words", "n"))):
                if len(group) >= min(shard_contexts, 1000) and row[0] != group[-1][0]:
                    yield resolve(group)
                    group = []
                group.append(row)
        if group:
            yield resolve(group)
    return run


def _redealt(window: int, anchor_words: int):
    """The windows of contexts as contexts of longer anchors."""
    def run(batches):
        grams, whole = Rolling(2), Rolling(3)
        for batch in batches:
            data, offs = string_buffer(batch.column("words").cast(pa.binary()))
            for a, b in slices(offs):
                words = data[offs[a]:offs[b]].copy().view(U)
                first = (offs[a:b + 1] - offs[a]) // 8
                row = np.repeat(np.arange(b - a), np.diff(first))
                start, size, anchor, ctx = _owned(words, row, window, anchor_words, grams, whole)
                of = row[start]
                length = size + window - 1
                ends = np.cumsum(length)
                idx = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(
                    start - ends + length, length)
                take = pa.array(a + of)
                yield pa.RecordBatch.from_arrays([
                    pa.array(anchor.view(np.int64)), pa.array(ctx.view(np.int64)),
                    batch.column("n").take(take), batch.column("_k1").take(take),
                    batch.column("_k2").take(take),
                    pa.array((batch.column("at").to_numpy()[a + of] + start - first[of])
                             .astype(np.int32)), pa.array(size.astype(np.int32)),
                    pa.Array.from_buffers(pa.binary(), len(start), [
                        None, pa.py_buffer((8 * np.concatenate([[0], ends])).astype(np.int32)
                                           .tobytes()),
                        pa.py_buffer(words[idx].tobytes())])],
                    names=["anchor", "ctx", "n", "_k1", "_k2", "at", "size", "words"])
    return run


def _judged(contexts: DataFrame, window: int, shard_contexts: int, anchor_words: int
            ) -> DataFrame:
    """(_k1, _k2, first, last): repeated windows of the contexts with one place."""
    found = contexts.where(F.col("m") <= shard_contexts).repartition("anchor") \
        .sortWithinPartitions("anchor") \
        .transform(map_batches, _shards(window, shard_contexts), RANGES)
    big = contexts.where(F.col("m") > shard_contexts)
    if anchor_words >= window or big.isEmpty():
        return found
    anchor_words = min(2 * anchor_words, window)
    parts = saved(big.transform(map_batches, _redealt(window, anchor_words), PARTS), "parts")
    distinct = saved(parts.groupBy("anchor", "ctx").agg(
        F.sum("n").alias("n"), F.min(F.struct("_k1", "_k2", "at")).alias("rep"),
        F.first("words").alias("words")), "part-contexts")
    # places of their own whose whole part is somewhere else too
    same = parts.where("n = 1").drop("n").join(
        distinct.where("n > 1").select("anchor", "ctx"), ["anchor", "ctx"]).select(
        "_k1", "_k2", F.col("at").alias("first"), (F.col("at") + F.col("size") - 1).alias("last"))
    many = saved(distinct.groupBy("anchor").agg(F.count("*").alias("m")).where("m > 1"),
                 "part-mixed")
    deeper = saved(distinct.join(many, "anchor").select(
        "anchor", "ctx", "n", "m", "rep._k1", "rep._k2", "rep.at", "words"), "part-words")
    return found.unionByName(same).unionByName(
        _judged(deeper, window, shard_contexts, anchor_words))


def repeated_ranges(docs: DataFrame, window: int = 35, text_col: str = "text",
                    shard_contexts: int = 4000) -> DataFrame:
    """(_k1, _k2, ranges): first and last starting word of repeated windows, per distinct text."""
    keyed = _keyed(docs, text_col)
    anchors = keyed.select(text_col, "_k1", "_k2").transform(map_batches,
        _anchors(window), "_k1 long, _k2 int, at int, size int, anchor long, ctx long, n int")
    common = saved(anchors.groupBy("anchor").agg(F.sum("n").alias("tot")).where("tot >= 2")
                   .select("anchor"), "anchors")
    places = saved(anchors.join(common, "anchor").groupBy("_k1", "_k2", "at", "size", "anchor",
                                                          "ctx").agg(F.sum("n").alias("n")),
                   "places")
    # distinct contexts with their number of places and one of the places
    distinct = saved(places.groupBy("anchor", "ctx").agg(
        F.sum("n").alias("n"), F.min(F.struct("_k1", "_k2", "at", "size")).alias("rep")),
        "contexts")
    whole = distinct.where("n > 1").select("anchor", "ctx")
    same = places.join(whole, ["anchor", "ctx"]).select(
        "_k1", "_k2", F.col("at").alias("first"), (F.col("at") + F.col("size") - 1).alias("last"))
    many = saved(distinct.groupBy("anchor").agg(F.count("*").alias("m")).where("m > 1"), "mixed")
    asked = distinct.join(many, "anchor").select(
        "rep._k1", "rep._k2", F.struct("anchor", "ctx", "n", "m", "rep.at", "rep.size")
        .alias("f")).groupBy("_k1", "_k2").agg(F.collect_list("f").alias("facts"))
    contexts = saved(keyed.select(F.col(text_col).alias("text"), "_k1", "_k2")
                     .join(saved(asked, "asked"), ["_k1", "_k2"]).transform(map_batches,
        _contexts(window), CONTEXTS).groupBy("anchor", "ctx").agg(
        *(F.first(c).alias(c) for c in ("n", "m", "_k1", "_k2", "at", "words"))), "words")
    found = _judged(contexts, window, shard_contexts, min(ANCHOR, window))
    return saved(same.unionByName(found).groupBy("_k1", "_k2").agg(
        F.collect_list(F.struct("first", "last")).alias("ranges")), "ranges")


def _cut(window: int, text_col: str, keep_layout: bool):
    def run(batches):
        table = byte_table("space")
        for batch in batches:
            data, offs = string_buffer(batch.column(text_col))
            ranges = batch.column("ranges")
            cols = {n: batch.column(n) for n in batch.schema.names
                    if n not in ("ranges", "_k1", "_k2")}
            for a, b in slices(offs):
                part = data[offs[a]:offs[b]]
                s, e, row = word_bounds(part, offs[a:b + 1] - offs[a], table)
                counts = row_counts(row, b - a)
                first = np.cumsum(counts) - counts
                mine = ranges.slice(a, b - a).fill_null([])
                doc = np.repeat(np.arange(b - a), np.diff(np.asarray(mine.offsets)))
                flat = mine.flatten()
                change = np.zeros(len(s) + 1, np.int64)
                np.add.at(change, first[doc] + flat.field("first").to_numpy(), 1)
                np.add.at(change, first[doc] + flat.field("last").to_numpy() + window, -1)
                drop = np.cumsum(change[:-1]) > 0
                removed = np.bincount(row[drop], minlength=b - a).astype(np.int64)
                kept = np.flatnonzero(~drop)
                if keep_layout:  # each kept word with the blanks before it
                    base = offs[:-1][a:b] - offs[a]
                    s2 = np.where(np.arange(len(s)) == first[row], base[row],
                                  np.concatenate([[0], e[:-1]])) if len(s) else s
                    ls, le, sep = s2[kept], e[kept], 0
                else:
                    ls, le, sep = s[kept], e[kept], 1
                size = le - ls + sep
                out = np.cumsum(size)
                idx = np.arange(int(out[-1]) if len(out) else 0) + np.repeat(ls - out + size, size)
                text = part[np.minimum(idx, max(len(part) - 1, 0))]
                if sep:
                    text[out - 1] = 32
                ends = np.zeros(b - a, np.int64)
                np.add.at(ends, row[kept], size)
                ends = np.cumsum(ends)
                if sep:  # no blank after a text's last word
                    last = np.flatnonzero(np.diff(row[kept], append=-1) != 0)
                    text = np.delete(text, out[last] - 1)
                    has = np.zeros(b - a, np.int64)
                    has[row[kept[last]]] = 1
                    ends -= np.cumsum(has)
                new = pa.Array.from_buffers(pa.string(), b - a, [
                    None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32).tobytes()),
                    pa.py_buffer(text.tobytes())])
                here = {n: c.slice(a, b - a) for n, c in cols.items()}
                here |= {"n_words": pa.array(counts), "n_removed": pa.array(removed),
                         "kept": new}
                yield pa.RecordBatch.from_pydict(here)
    return run


def remove_repeats(docs: DataFrame, window: int = 35, text_col: str = "text",
                   shard_contexts: int = 4000, keep_layout: bool = False) -> DataFrame:
    """``docs`` with n_words, n_removed and kept (the kept words).

    Kept words are joined by one space, or with ``keep_layout`` keep the
    blanks that stood before them.
    """
    docs = docs.drop("n_words", "n_removed", "kept", "ranges", "_k1", "_k2")
    ranges = repeated_ranges(docs, window, text_col, shard_contexts)
    joined = _keyed(docs, text_col).join(ranges, ["_k1", "_k2"], "left")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return joined.transform(map_batches, _cut(window, text_col, keep_layout),
                             fields + ", n_words long, n_removed long, kept string")
