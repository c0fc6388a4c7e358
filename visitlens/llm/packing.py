"""Sequence packing by cutting-stock column generation (operator 6).

Documents are tokenised once; one longer than a sequence is cut into full
sequences and a remainder. The remainders' lengths, rounded up to a grain,
form a histogram of fixed size whatever the corpus. On it a linear program
over patterns (how many pieces of each length class go into a sequence) is
solved by column generation: the duals price the classes and a knapsack
dynamic program finds the best new pattern. The rounded-down pattern counts
are assigned to the pieces by their rank in their class; what rounding
leaves (some pieces per pattern, not per document) is packed first-fit
decreasing into patterns of count one.

Edge cases: a null or empty text is the end token alone; repeated rows are
packed each on their own; an empty table gives no rows; other columns of
the input are ignored.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlens.llm.frames import Shared, map_batches, saved, worker_state
from visitlens.llm.text import WordHasher, byte_table, slices, string_buffer, word_bounds

PIECE_SCHEMA = ("doc_id long, start long, length long, doc_tokens long, ids binary, "
                "cls int, part int, rank long")


SEPARATOR = "<|startoftext|>"


class WordCache:
    """Token ids of chunks of blank-separated words, kept by the chunk's 64-bit hash.

    The tokenizer drops white space and never joins across it, so a text's
    ids are its words' ids in order. A word of Latin letters and then ASCII
    punctuation (but no apostrophe) is two chunks, as the tokenizer parts
    letters from punctuation too. Beyond ``limit`` chunks those used in the
    fewest slices of text are dropped, to half of it, which bounds the memory.
    """

    def __init__(self, tokenizer, limit: int = 500_000):
        self.tok, self.limit = tokenizer, limit
        self.hash, self.table = WordHasher(3), byte_table("space")
        vocab = tokenizer.get_vocab()
        self.word_end = np.zeros(max(vocab.values()) + 1, bool)
        self.word_end[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.separator = vocab[SEPARATOR]
        self.letter = np.zeros(256, bool)
        self.letter[65:91] = self.letter[97:123] = True
        self.punct = np.zeros(256, bool)
        self.punct[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"]] = True
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.used = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _shrink(self):
        """Keep the chunks used in most slices, half the limit at most, and halve their counts."""
        half = min(max(self.limit // 2, 1), len(self.used))
        cut = np.sort(self.used)[-half]
        keep = np.flatnonzero(self.used > min(cut, self.used.max() - 1))[:half]
        size = self.size[keep]
        ends = np.cumsum(size)
        self.pool = self.pool[np.arange(int(size.sum()))
                              + np.repeat(self.at[keep] - ends + size, size)]
        self.keys, self.at, self.size = self.keys[keep], ends - size, size
        self.used = self.used[keep] // 2

    def _ids(self, words, letters_only):
        """(ids, ids per word): words of letters end at the first word-end token."""
        if letters_only:
            ids = np.array(self.tok.encode_batch_fast(
                [" ".join(words)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.word_end[ids]) + 1
            if len(ends) == len(words) and ends[-1] == len(ids):
                return ids, np.diff(ends, prepend=0)
        own = [w for w in words if SEPARATOR in w]
        if not own:
            ids = np.array(self.tok.encode_batch_fast(
                [SEPARATOR.join(words)], add_special_tokens=False)[0].ids, np.uint32)
            cut = np.append(np.flatnonzero(ids == self.separator), len(ids))
            if len(cut) == len(words):
                return ids[ids != self.separator], np.diff(cut, prepend=-1) - 1
        found = [e.ids for e in self.tok.encode_batch(words, add_special_tokens=False)]
        return (np.array([i for f in found for i in f], np.uint32),
                np.array([len(f) for f in found], np.int64))

    def _add(self, keys, words, letters_only):
        """Merge new chunks, whose ``keys`` ascend, into the sorted cache."""
        if not len(words):
            return
        found = [self._ids(words[a:a + 4000], letters_only) for a in range(0, len(words), 4000)]
        size = np.concatenate([n for _, n in found])
        at = len(self.pool) + np.cumsum(size) - size
        self.pool = np.concatenate([self.pool, *(ids for ids, _ in found)])
        to = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, to, keys)
        self.at = np.insert(self.at, to, at)
        self.size = np.insert(self.size, to, size)
        self.used = np.insert(self.used, to, 0)

    def _chunks(self, data, offs):
        """Chunk bounds, rows and whether a chunk is all letters."""
        s, e, row = word_bounds(data, offs, self.table)
        if not len(s):
            return s, e, row, np.zeros(0, bool)
        letter = self.letter[data]
        # two-byte letters U+00C0..U+017F but the signs U+00D7 and U+00F7, and
        # U+0130, whose lower case has a combining dot
        lead = np.flatnonzero((data[:-1] >= 0xC3) & (data[:-1] <= 0xC5)
                              & ~((data[:-1] == 0xC3) & np.isin(data[1:], (0x97, 0xB7)))
                              & ~((data[:-1] == 0xC4) & (data[1:] == 0xB0)))
        letter[lead] = letter[lead + 1] = True
        at = np.arange(len(data))
        stop = np.minimum.accumulate(np.where(letter, len(data), at)[::-1])[::-1]
        stop = np.minimum(stop[s], e)
        punct = np.concatenate([[0], np.cumsum(self.punct[data])])
        two = np.flatnonzero((stop > s) & (stop < e) & (punct[e] - punct[stop] == e - stop))
        pure = stop == e
        pure[two] = True
        e2 = e.copy()
        e2[two] = stop[two]
        return (np.insert(s, two + 1, stop[two]), np.insert(e2, two + 1, e[two]),
                np.insert(row, two + 1, row[two]), np.insert(pure, two + 1, False))

    def _missing(self, uniq):
        if not len(self.keys):
            return np.arange(len(uniq))
        k = np.minimum(np.searchsorted(self.keys, uniq), len(self.keys) - 1)
        return np.flatnonzero(self.keys[k] != uniq)

    def encode(self, data, offs):
        """(ids, ids per row) of the texts in a buffer."""
        s, e, row, pure = self._chunks(data, offs)
        uniq, first, inv = np.unique(self.hash(data, s, e), return_index=True,
                                     return_inverse=True)
        new = self._missing(uniq)
        if len(self.keys) > 1 and len(self.keys) + len(new) > self.limit:
            self._shrink()
            new = self._missing(uniq)
        if len(new):
            raw = data.tobytes()
            for kind in (True, False):
                mine = new[pure[first[new]] == kind]
                at = first[mine]
                self._add(uniq[mine], [raw[a:b].decode() for a, b in zip(
                    s[at].tolist(), e[at].tolist())], kind)
        k = np.searchsorted(self.keys, uniq)
        self.used[k] += 1
        k = k[inv]
        size = self.size[k]
        total = np.cumsum(size)
        ids = self.pool[np.arange(int(size.sum())) + np.repeat(self.at[k] - total + size, size)]
        per_row = np.bincount(row, weights=size, minlength=len(offs) - 1).astype(np.int64)
        return ids, per_row


def worker_cache(tokenizer_json: str) -> WordCache:
    """The word cache of a Python worker, kept for the tasks it serves one after another."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    state = worker_state()
    if state.get("tokenizer") != tokenizer_json:
        state["tokenizer"] = tokenizer_json
        state["words"] = WordCache(Tokenizer.from_str(tokenizer_json))
    return state["words"]


def tokenized_pieces(docs: DataFrame, tokenizer_json: str, capacity: int, grain: int,
                     end_id: int) -> DataFrame:
    """One row per piece with its ids, length class and rank in its task's class."""
    shared = Shared(docs.sparkSession, tokenizer_json)

    def cut(batches):
        cache = worker_cache(shared.value)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity // grain + 2, np.int64)
        for batch in batches:
            data, offs = string_buffer(batch.column(1))
            for a, b in slices(offs):
                ids, n = cache.encode(data[offs[a]:offs[b]], offs[a:b + 1] - offs[a])
                ids = np.insert(ids, np.cumsum(n), np.uint32(end_id))
                n += 1
                k = -(-n // capacity)
                row = np.repeat(np.arange(b - a), k)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(k) - k, k)) * capacity
                length = np.minimum(capacity, n[row] - start)
                cls = -(-length // grain)
                order = np.argsort(cls, kind="stable")
                counts = np.bincount(cls, minlength=len(seen))
                rank = np.empty(len(row), np.int64)
                rank[order] = (np.arange(len(row)) - (np.cumsum(counts) - counts)[cls[order]]
                               + seen[cls[order]])
                seen += counts
                # pieces of about 16 MB of ids a batch: binary offsets are 32-bit
                bounds = np.concatenate([[0], np.cumsum(length)])
                for x, y in slices(4 * bounds, 16 << 20):
                    binary = pa.Array.from_buffers(pa.binary(), y - x, [
                        None, pa.py_buffer((4 * (bounds[x:y + 1] - bounds[x]))
                                           .astype(np.int32).tobytes()),
                        pa.py_buffer(ids[bounds[x]:bounds[y]].astype("<u4").tobytes())])
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).take(pa.array(a + row[x:y])),
                        pa.array(start[x:y]), pa.array(length[x:y]),
                        pa.array(n[row[x:y]]), binary, pa.array(cls[x:y].astype(np.int32)),
                        pa.array(np.full(y - x, part, np.int32)), pa.array(rank[x:y])],
                        names=["doc_id", "start", "length", "doc_tokens", "ids", "cls",
                               "part", "rank"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")) \
        .transform(map_batches, cut, PIECE_SCHEMA)


def best_pattern(value: np.ndarray, size: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack by dynamic programming: the pattern of highest value."""
    best = np.zeros(capacity + 1)
    take = np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        m = int(np.searchsorted(size, c, side="right"))
        best[c] = best[c - 1]
        if m:
            got = best[c - size[:m]] + value[:m]
            j = int(np.argmax(got))
            if got[j] > best[c] + 1e-12:
                best[c], take[c] = got[j], j
    pattern, c = np.zeros(len(size)), capacity
    while c > 0:
        if take[c] < 0:
            c -= 1
        else:
            pattern[take[c]] += 1
            c -= size[take[c]]
    return float(best[capacity]), pattern


def inverse(a: np.ndarray) -> np.ndarray:
    """Gauss-Jordan elimination with row pivots, element-wise.

    It runs in the driver, where a threaded BLAS may block for ever once the
    JVM has been forked off, so no BLAS or LAPACK routine is called.
    """
    k = len(a)
    m = np.hstack([a.astype(float), np.eye(k)])
    for c in range(k):
        r = c + int(np.argmax(np.abs(m[c:, c])))
        if r != c:
            m[[c, r]] = m[[r, c]]
        m[c] /= m[c, c]
        rows = np.flatnonzero(m[:, c])
        rows = rows[rows != c]
        m[rows] -= m[rows, c, None] * m[c]
    return m[:, k:]


def solve_patterns(size: np.ndarray, count: np.ndarray, capacity: int, gap: float = 2e-3,
                   max_columns: int = 1500, refresh: int = 200
                   ) -> tuple[np.ndarray, np.ndarray]:
    """Linear program of the cutting stock by column generation.

    Minimises the number of sequences so that each class is served. Starts
    from one pattern per class and swaps in the best-priced pattern until
    none improves the bound by more than ``gap``; the basis inverse is
    computed anew every ``refresh`` swaps. Returns (patterns x classes,
    real-valued counts).
    """
    k = len(size)
    fits = np.floor(capacity / size)
    basis = np.diag(fits)                 # columns are patterns
    inv = np.diag(1.0 / fits)
    x = count / fits
    for it in range(max_columns):
        dual = inv.sum(axis=0)
        value, new = best_pattern(np.maximum(dual, 0.0), size, capacity)
        if value <= 1 + gap:
            break
        used = np.flatnonzero(new)
        d = (inv[:, used] * new[used]).sum(axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(d > 1e-9, np.maximum(x, 0) / d, np.inf)
        r = int(np.argmin(ratio))
        if not np.isfinite(ratio[r]):
            break
        step = ratio[r]
        x = x - step * d
        x[r] = step
        basis[:, r] = new
        pivot = inv[r] / d[r]
        inv -= np.outer(d, pivot)
        inv[r] = pivot
        if it % refresh == refresh - 1:
            inv = inverse(basis)
            x = (inv * count).sum(axis=1)
    return basis.T, np.maximum(x, 0.0)


def plan_patterns(hist: dict[int, int], units: int) -> list[tuple[dict[int, int], int]]:
    """Whole patterns [(class -> pieces, how many sequences)] that hold exactly the histogram."""
    plan: list[tuple[dict[int, int], int]] = []
    left = dict(hist)
    if left.get(units):
        plan.append(({units: 1}, left.pop(units)))
    if left:
        size = np.array(sorted(left))
        patterns, x = solve_patterns(size, np.array([float(left[c]) for c in size]), units)
        for row, times in zip(patterns, np.floor(x + 1e-6).astype(int)):
            # numerical noise must not take more pieces than there are
            for c, a in zip(size, row):
                if a:
                    times = min(times, left[int(c)] // int(a))
            if times > 0:
                plan.append(({int(c): int(a) for c, a in zip(size, row) if a}, int(times)))
                for c, a in plan[-1][0].items():
                    left[c] -= a * int(times)
    room: list[int] = []
    bins: list[dict[int, int]] = []
    for c in sorted(left, reverse=True):
        for _ in range(left[c]):
            i = next((i for i, r in enumerate(room) if r >= c), None)
            if i is None:
                room.append(units)
                bins.append({})
                i = len(room) - 1
            room[i] -= c
            bins[i][c] = bins[i].get(c, 0) + 1
    return plan + [(b, 1) for b in bins]


@dataclass
class Packing:
    """``pieces`` hold the ids; ``placement`` says where each piece lies."""
    pieces: DataFrame
    placement: DataFrame

    def sequences(self) -> DataFrame:
        """(sequence_id, ids): the packed sequences, at most the capacity each."""
        ids = self.pieces.select("part", "cls", "rank", "ids").join(
            self.placement.select("part", "cls", "rank", "sequence_id", "offset"),
            ["part", "cls", "rank"])
        return ids.groupBy("sequence_id").agg(
            F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p")).select(
            "sequence_id", F.aggregate("p", F.lit(b"").cast("binary"),
                                       lambda a, p: F.concat(a, p["ids"])).alias("ids"))


def pack(docs: DataFrame, tokenizer_json: str, capacity: int = 4096, grain: int = 16,
         end_id: int = 2, digest: Column | None = None) -> Packing:
    """Pack ``docs`` (doc_id, text) into sequences of at most ``capacity`` tokens.

    ``digest`` is an optional expression over a piece's ids, carried into
    the placement as ``digest`` so that checks need not move the ids.
    The driver holds the histogram (``capacity / grain`` numbers) and the
    patterns (about as many); neither grows with the corpus.
    """
    units = capacity // grain
    pieces = saved(tokenized_pieces(docs, tokenizer_json, capacity, grain, end_id), "pieces")
    counts = pieces.groupBy("cls", "part").agg(F.count("*").alias("n"))
    hist = {r["cls"]: r["n"] for r in counts.groupBy("cls").agg(F.sum("n").alias("n")).collect()}
    plan = plan_patterns(hist, units)

    key, base, per, rows = [], [], [], {c: 0 for c in hist}
    sequence = 0
    for pattern, times in plan:
        for c, a in pattern.items():
            key.append((c << 44) + rows[c])
            base.append(sequence)
            per.append(a)
            rows[c] += a * times
        sequence += times
    order = np.argsort(np.array(key, np.int64))
    table = Shared(docs.sparkSession, tuple(
        np.array(v, np.int64)[order] for v in (key, base, per)))

    def place(batches):
        key, base, per = table.value
        for batch in batches:
            cls = batch.column("cls").to_numpy().astype(np.int64)
            at = (cls << 44) + batch.column("grank").to_numpy()
            i = np.searchsorted(key, at, side="right") - 1
            k = at - key[i]
            cols = {n: batch.column(n) for n in batch.schema.names}
            cols["sequence_id"] = pa.array(base[i] + k // per[i])
            cols["slot"] = pa.array(k % per[i])
            yield pa.RecordBatch.from_pydict(cols)

    before = Window.partitionBy("cls").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("cls", "part", F.coalesce(F.sum("n").over(before),
                                                    F.lit(0)).alias("before"))
    narrow = pieces.select("doc_id", "start", "length", "doc_tokens", "cls", "part", "rank",
                           (digest if digest is not None else F.lit(None).cast("long"))
                           .alias("digest")).join(first, ["cls", "part"]) \
        .withColumn("grank", F.col("rank") + F.col("before")).drop("before")
    placed = narrow.transform(map_batches, place, narrow.schema.simpleString()[7:-1]
                               + ",sequence_id:bigint,slot:bigint")
    seq = Window.partitionBy("sequence_id").orderBy(F.desc("cls"), "slot") \
        .rowsBetween(Window.unboundedPreceding, -1)
    placement = placed.withColumn("offset", F.coalesce(F.sum("length").over(seq), F.lit(0)))
    return Packing(pieces, placement.drop("grank", "slot"))
