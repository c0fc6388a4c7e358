"""Benchmark decontamination by an FM-index per training shard (operator 1).

A shard is a slice of a task's documents (about 2 MB of text), as a
sequence of word symbols; words that occur in no benchmark phrase only
separate, and stretches shorter than the shortest phrase are left out, as
no phrase fits into them. All phrases of a benchmark block are searched
backwards at once through wavelet-matrix ranks, occurrences are located by
sampled suffix positions, and their word ranges are merged into removal
spans. Documents are never shuffled. The benchmark goes out in blocks of
a bounded number of phrases, each a broadcast; a document carries its spans
from block to block.

Edge cases: null or empty texts have no words and no spans; an item without
words has no phrase; items with a null id mark words but name no item;
repeated rows are judged alike; an empty benchmark gives no hits; other
columns of either table are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.llm.fmindex import FMIndex
from visitlens.llm.frames import map_batches, saved, Shared
from visitlens.llm.text import (WordHasher, byte_table, lower_table, row_counts, slices,
                                string_buffer, word_bounds)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD_RE = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPANS = "array<struct<start:bigint,end:bigint>>"


def phrase_words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD_RE), F.lit(0))


def benchmark_phrases(bench: DataFrame, width: int) -> DataFrame:
    """Distinct (words, item_id): each window of ``width`` words, or a shorter item whole."""
    w = bench.select(F.col("item_id").cast("string"), phrase_words(F.col("text")).alias("w"))
    w = w.where(F.size("w") > 0)
    windows = F.when(F.size("w") <= width, F.array("w")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size("w") - width + 1),
                    lambda i: F.slice("w", i, width)))
    return w.select("item_id", F.explode(windows).alias("words")).distinct()


class PhraseBlock:
    """Phrases as right-aligned symbol rows over the block's own vocabulary."""

    def __init__(self, rows, width: int):
        phrases: dict[tuple, set] = {}
        for r in rows:
            phrases.setdefault(tuple(r["words"]), set()).add(r["item_id"])
        keys = sorted(phrases)
        vocab = sorted({w for k in keys for w in k})
        buf = [w.encode() for w in vocab]
        end = np.cumsum([len(b) for b in buf]).astype(np.int64)
        start = end - np.array([len(b) for b in buf], np.int64)
        hashes = WordHasher(1)(np.frombuffer(b"".join(buf), np.uint8), start, end)
        order = np.argsort(hashes)
        self.vocab = hashes[order]
        symbol = {vocab[i]: k + 1 for k, i in enumerate(order.tolist())}
        self.size = np.array([len(k) for k in keys], np.int64)
        self.phrases = np.zeros((len(keys), width), np.int64)
        for i, k in enumerate(keys):
            self.phrases[i, width - len(k):] = [symbol[w] for w in k]
        self.items = sorted({x for v in phrases.values() for x in v if x is not None})
        number = {x: i for i, x in enumerate(self.items)}
        per = [[number[x] for x in phrases[k] if x is not None] for k in keys]
        self.item_at = np.concatenate([[0], np.cumsum([len(p) for p in per])]).astype(np.int64)
        self.item_of = np.array([x for p in per for x in p], np.int64)

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        seen = np.zeros(1 << 20, bool)
        seen[self.vocab >> np.uint64(44)] = True
        out = np.zeros(len(hashes), np.int64)
        may = np.flatnonzero(seen[hashes >> np.uint64(44)])
        k = np.minimum(np.searchsorted(self.vocab, hashes[may]), len(self.vocab) - 1)
        ok = self.vocab[k] == hashes[may]
        out[may[ok]] = k[ok] + 1
        return out


def search_shard(block: PhraseBlock, symbol: np.ndarray, row: np.ndarray):
    """(word hit flags, pairs of row and item number) of a shard's words."""
    n = len(symbol)
    hit = np.zeros(n, bool)
    none = np.zeros(0, np.int64)
    known = symbol > 0
    head = known.copy()
    head[1:] &= ~known[:-1] | (row[1:] != row[:-1])
    starts = np.flatnonzero(head)
    if not len(starts):
        return hit, none, none
    seg = np.cumsum(head) - 1
    length = np.bincount(seg[known], minlength=len(starts))
    keep = known & (length[np.maximum(seg, 0)] >= block.size.min())
    word = np.flatnonzero(keep)
    if not len(word):
        return hit, none, none
    first = np.flatnonzero(head[word])
    text = np.insert(symbol[word], first, 0)
    where = np.insert(word, first, -1)
    index = FMIndex(text, len(block.vocab) + 1)
    sp, ep = index.search(block.phrases, block.size)
    count = ep - sp
    phrase = np.repeat(np.arange(len(count)), count)
    rows = np.arange(int(count.sum())) + np.repeat(sp - np.cumsum(count) + count, count)
    at = where[index.locate(rows)]
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + block.size[phrase], -1)
    hit = np.cumsum(change[:-1]) > 0
    pair = np.unique(row[at] * len(count) + phrase)
    doc, phrase = pair // len(count), pair % len(count)
    k = block.item_at[phrase + 1] - block.item_at[phrase]
    item = block.item_of[np.arange(int(k.sum())) + np.repeat(
        block.item_at[phrase] - np.cumsum(k) + k, k)]
    pair = np.unique(np.repeat(doc, k) * (len(block.items) + 1) + item)
    return hit, pair // (len(block.items) + 1), pair % (len(block.items) + 1)


def span_column(hit: np.ndarray, row: np.ndarray, first_word: np.ndarray, n: int) -> pa.Array:
    """Merged runs of hit words per row, as lists of (start, end) word numbers."""
    before = np.zeros(len(hit), bool)
    before[1:] = hit[:-1] & (row[1:] == row[:-1])
    after = np.zeros(len(hit), bool)
    after[:-1] = hit[1:] & (row[1:] == row[:-1])
    s = np.flatnonzero(hit & ~before)
    e = np.flatnonzero(hit & ~after)
    offs = np.concatenate([[0], np.cumsum(row_counts(row[s], n))]).astype(np.int32)
    shift = first_word[row[s]]
    return pa.ListArray.from_arrays(pa.array(offs), pa.StructArray.from_arrays(
        [pa.array(s - shift), pa.array(e + 1 - shift)], names=["start", "end"]))


def merge_spans(a, b):
    out: list = []
    for s in sorted([(x["start"], x["end"]) for x in a + b]):
        if out and s[0] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], s[1]))
        else:
            out.append(s)
    return [{"start": s, "end": e} for s, e in out]


def removal_spans(docs: DataFrame, bench: DataFrame, width: int = 10,
                  block_phrases: int = 100_000, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, spans (merged word ranges to remove) and items (ids, sorted).

    The driver holds one block of at most about ``block_phrases`` phrases at
    a time; more phrases mean more passes over a document inside its task.
    """
    phrases = benchmark_phrases(bench, width)
    total = phrases.count()
    blocks = max(1, -(-total // block_phrases))
    if blocks > 1:
        phrases = saved(phrases, "phrases")
    out = docs.withColumns({"n_words": F.lit(0).cast("long"),
                            "spans": F.array().cast(SPANS),
                            "items": F.array().cast("array<string>")})
    for b in range(blocks):
        rows = phrases.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == b).collect()
        shared = Shared(docs.sparkSession, PhraseBlock(rows, width))
        out = out.transform(map_batches, _searcher(shared, text_col, b == 0), out.schema)
    return out


def _searcher(shared, text_col, first):
    def run(batches):
        block = shared.value
        hasher, table, lower = WordHasher(1), byte_table("alnum"), lower_table()
        names = np.array(block.items, object)
        for batch in batches:
            data, offs = string_buffer(batch.column(text_col))
            for a, b in slices(offs):
                part = lower[data[offs[a]:offs[b]]]
                s, e, row = word_bounds(part, offs[a:b + 1] - offs[a], table)
                n_words = row_counts(row, b - a)
                if len(block.size):
                    hit, doc, item = search_shard(block, block.symbols(hasher(part, s, e)), row)
                else:
                    hit, doc, item = np.zeros(len(s), bool), s[:0], s[:0]
                spans = span_column(hit, row, np.cumsum(n_words) - n_words, b - a)
                at = np.concatenate([[0], np.cumsum(row_counts(doc, b - a))]).astype(np.int32)
                items = pa.ListArray.from_arrays(pa.array(at), pa.array(
                    names[item].tolist(), pa.string()))
                rows = batch.slice(a, b - a)
                if not first:
                    items = pa.array([sorted(set(x) | set(y)) for x, y in zip(
                        items.to_pylist(), rows.column("items").to_pylist())],
                        pa.list_(pa.string()))
                    spans = pa.array([merge_spans(x, y) for x, y in zip(
                        spans.to_pylist(), rows.column("spans").to_pylist())], spans.type)
                cols = {n: rows.column(n) for n in rows.schema.names}
                cols |= {"n_words": pa.array(n_words), "spans": spans, "items": items}
                yield pa.RecordBatch.from_pydict(cols)
    return run


def without_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Cut the word ranges of ``spans`` out of the text (whole texts without spans stay)."""
    def run(batches):
        table, lower = byte_table("alnum"), lower_table()
        for batch in batches:
            texts = batch.column(text_col)
            spans = batch.column("spans")
            sizes = np.diff(np.asarray(spans.offsets))
            new = {}
            for i in np.flatnonzero(sizes).tolist():
                raw = texts[i].as_py().encode()
                data = np.frombuffer(raw, np.uint8)
                s, e, _ = word_bounds(lower[data], np.array([0, len(raw)]), table)
                kept, at = [], 0
                for x in spans[i].as_py():
                    kept.append(raw[at:s[x["start"]]])
                    at = int(e[x["end"] - 1])
                new[i] = b"".join(kept + [raw[at:]]).decode()
            cols = {n: batch.column(n) for n in batch.schema.names}
            if new:
                values = texts.to_pylist()
                for i, t in new.items():
                    values[i] = t
                cols[text_col] = pa.array(values, texts.type)
            yield pa.RecordBatch.from_pydict(cols)

    return docs.transform(map_batches, run, docs.schema)
