"""Hierarchical Pitman-Yor language model with Gibbs-sampled seating (operator 10).

The model nests three levels. Each word's context restaurant seats the tokens
that follow it (a text starts after the empty word, which also ends it); a new
table there is a customer of the word restaurant, and a new table of that draws
its word from the spelling model, a hierarchy of context
restaurants over bytes: the last three bytes' restaurant draws from its
parent, the last two bytes', that one from the last byte's, and so on to the
root over a uniform byte. Restaurants of one shorter context share it as
parent. Customers of a parent are its children's tables.

Tables are sampled by collapsed Gibbs steps: a customer of a dish leaves (it
sat alone with the probability given by generalised Stirling numbers) and
is seated again by the restaurant's weights. Dishes of more than ``EXACT``
customers move an eighth of them at a time by expected numbers. The levels are
sampled in turn: words and spellings from one table a (context, word) pair, then
the pairs given these, then words and spellings from the pairs' tables. Predictive
probabilities are averaged over the kept samples. An unseen word gets the mass of
the word restaurant's new tables times its spelling's probability, so ``score``
is over all byte strings; ``event_score`` takes all unseen words as one event (the
mass that new tables give to all unseen spellings), as the add-one base score
does, so these two are over the training vocabulary and one unknown word.

Counts of words and of (context, word) pairs cover all training texts and are
summed in Spark; the spelling model's cells are bounded by its contexts and 257 bytes
(second and third bytes back count by classes), whatever the corpus, and are what the
driver holds. Texts are read once, into blocks that hold their tokens as numbers of
the block's words. A block asks for its pairs, and later for its words, by ranges of
64-bit keys, a packed row a range; a range sums and answers what all blocks ask of
it, and only pairs that occur twice or more, which need sampling, become rows. Steps
are saved, and deleted when all that reads them is written.

Edge cases: null and empty texts consist of the end token; a null ``train``
flag means no training text; without training texts the spelling model is
uniform; repeated rows are counted and scored each; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.llm.frames import Kept, map_batches, Shared, trimmed
from visitlens.llm.text import (U, WordHasher, byte_table, gather_bytes, lower_table, mix64,
                                row_counts, slices, string_buffer, word_bounds)

END, BYTES = 256, 257
SECOND, THIRD = 32, 8           # classes of the second and third byte back
EXACT = 256
DISCOUNT = (0.2, 0.4, 0.6, 0.7)  # of the byte restaurants by context length
THETA = 1.0


# -- seating ---------------------------------------------------------------

def alone_table(d: float, most: int = EXACT) -> np.ndarray:
    """P(a random customer sits alone) for c customers at t tables, from
    generalised Stirling numbers S(c, t) = S(c-1, t-1) + (c-1 - d t) S(c-1, t)."""
    log = np.full((most + 1, most + 1), -np.inf)
    log[0, 0] = 0.0
    t = np.arange(most + 1)
    for c in range(1, most + 1):
        with np.errstate(divide="ignore", invalid="ignore"):
            stay = log[c - 1] + np.log(np.maximum(c - 1 - d * t, 1e-300))
        stay[t > c - 1] = -np.inf
        new = np.concatenate([[-np.inf], log[c - 1, :-1]])
        log[c] = np.logaddexp(stay, new)
    out = np.zeros((most + 1, most + 1))
    with np.errstate(invalid="ignore"):
        out[1:, 1:] = np.exp(log[:-1, :-1] - log[1:, 1:])
    return np.nan_to_num(out)


def gibbs_step(c, t, weight, d, alone, u1, u2):
    """One step for all dishes; ``weight`` is (theta + d T) times the parent's probability."""
    small = c <= EXACT
    cs = np.where(small, c, 0)
    leaves = u1 < alone[cs, np.minimum(t, EXACT)]
    t1 = t - leaves
    new = u2 * (weight + c - 1 - d * t1) < weight
    moved = np.maximum(c // 8, 1)
    gone = np.floor(moved * np.minimum(d * t / np.maximum(c, 1), 1) + u1)
    t2 = np.maximum(t - gone, 1)
    came = np.floor(moved * weight / (weight + c - moved - d * t2 + 1e-12) + u2)
    return np.where(small, t1 + new, np.clip(t2 + came, 1, c)).astype(np.int64)


def seating(c, weight, d, key, sweeps: int = 24, keep: int = 12):
    """(averaged tables, last tables) of dishes with ``c`` customers.

    The random numbers depend on the key and the sweep alone, so a task
    that runs again draws the same seating.
    """
    alone = alone_table(d)
    t = np.minimum(c, np.ceil(c ** d)).astype(np.int64)
    t = np.where(c <= EXACT, np.minimum(t, EXACT), t)
    total = np.zeros(len(c))
    for sweep in range(sweeps):
        r = mix64(key + U((2 * sweep + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
        u1 = (r >> U(11)).astype(float) / 2.0 ** 53
        u2 = (mix64(r + U(1)) >> U(11)).astype(float) / 2.0 ** 53
        t = gibbs_step(c, t, weight, d, alone, u1, u2)
        if sweep >= sweeps - keep:
            total += t
    return total / keep, t


def discount(once: int, twice: int) -> float:
    """From the numbers of dishes with one and two customers."""
    return min(max(once / max(once + 2 * twice, 1), 0.05), 0.95)


def gathered(batches, rows: int = 50_000):
    """The same rows in batches of about ``rows``, for steps with a cost per batch."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n = [], 0
    if n:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


# -- spelling model ----------------------------------------------------------

def byte_contexts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """(symbol, context of 1, 2 and 3 bytes, word) for each byte and end of the words."""
    size = ends - starts + 1
    word = np.repeat(np.arange(len(starts)), size)
    first = np.cumsum(size) - size
    k = np.arange(len(word)) - first[word]
    padded = np.append(data, 0).astype(np.int64)
    sym = np.where(k == (ends - starts)[word], END, padded[np.minimum(starts[word] + k,
                                                                      len(data))])

    def back(n):
        return np.where(k >= n, np.concatenate([np.zeros(n, np.int64), sym[:-n]])
                        if len(sym) > n else END, END)
    one = back(1)
    two = one * SECOND + back(2) % SECOND
    return sym, one, two, two * THIRD + back(3) % THIRD, word


@dataclass
class SpellingModel:
    """log10 probabilities; rows of contexts seen in training, then all two-byte contexts."""
    row_of: np.ndarray
    table: np.ndarray
    seen: int

    def log10(self, data, starts, ends) -> np.ndarray:
        out = np.zeros(len(starts))
        # in blocks of about a million bytes
        for a, b in slices(np.concatenate([[0], np.cumsum(ends - starts + 1)])):
            sym, _, two, three, word = byte_contexts(data, starts[a:b], ends[a:b])
            row = self.row_of[three]
            row = np.where(row >= 0, row, self.seen + two)
            out[a:b] = np.bincount(word, weights=self.table[row, sym], minlength=b - a)
        return out


def spelling_model(context: np.ndarray, symbol: np.ndarray, count: np.ndarray,
                   sweeps: int = 24, keep: int = 8, seed: int = 5) -> SpellingModel:
    """Gibbs-sample the byte restaurants from three-byte-context counts."""
    rng = np.random.default_rng(seed)
    shape = [1, BYTES, BYTES * SECOND, BYTES * SECOND * THIRD]
    # cells (context, symbol) of each level; a level's cell points to its parent's
    keys = [None] * 4
    keys[3] = context.astype(np.int64) * BYTES + symbol
    order = np.argsort(keys[3])
    keys[3], top = keys[3][order], count[order].astype(np.int64)
    parent = [None] * 4
    fold = {3: THIRD, 2: SECOND, 1: BYTES}
    for level in (3, 2, 1):
        k = keys[level] // BYTES // fold[level] * BYTES + keys[level] % BYTES
        keys[level - 1], parent[level] = np.unique(k, return_inverse=True)
    ctx = [k // BYTES for k in keys]
    sym = [k % BYTES for k in keys]
    alone = [alone_table(d) for d in DISCOUNT]
    c = [None, None, None, top]
    t = [None] * 4
    for level in (3, 2, 1, 0):
        if level < 3:
            c[level] = np.bincount(parent[level + 1], weights=t[level + 1],
                                   minlength=len(keys[level])).astype(np.int64)
        t[level] = np.minimum(c[level], np.ceil(c[level] ** DISCOUNT[level])).astype(np.int64)
    seen = np.unique(ctx[3])
    row_of = np.full(shape[3], -1, np.int64)
    row_of[seen] = np.arange(len(seen))
    total = np.zeros((len(seen) + shape[2], BYTES))
    for sweep in range(sweeps):
        # probabilities of the cells' symbols, from the root down
        prob, mass = [None] * 4, [None] * 4
        for level in range(4):
            d = DISCOUNT[level]
            cc = np.bincount(ctx[level], weights=c[level], minlength=shape[level])
            tt = np.bincount(ctx[level], weights=t[level], minlength=shape[level])
            mass[level] = (THETA + d * tt) / (THETA + cc)
            base = np.full(len(keys[level]), 1 / BYTES) if level == 0 \
                else prob[level - 1][parent[level]]
            up_weight = (THETA + d * tt)[ctx[level]] * base
            prob[level] = ((c[level] - d * t[level]) + up_weight) / (THETA + cc)[ctx[level]]
            mass[level] = (mass[level], up_weight, (THETA + cc)[ctx[level]])
        if sweep >= sweeps - keep:
            dense = np.full((1, BYTES), 1 / BYTES)
            for level in range(4):
                rows = seen if level == 3 else np.arange(shape[level])
                above = np.zeros(len(rows), np.int64) if level == 0 else rows // fold[level]
                p = dense[above] * mass[level][0][rows][:, None]
                at = row_of[ctx[level]] if level == 3 else ctx[level]
                p[at, sym[level]] += (c[level] - DISCOUNT[level] * t[level]) / mass[level][2]
                dense = p
                if level == 2:
                    total[len(seen):] += dense
            total[:len(seen)] += dense
        for level in (3, 2, 1, 0):
            if level < 3:
                c[level] = np.bincount(parent[level + 1], weights=t[level + 1],
                                       minlength=len(keys[level])).astype(np.int64)
                t[level] = np.clip(t[level], 1, c[level])
            n = len(keys[level])
            t[level] = gibbs_step(c[level], t[level], mass[level][1], DISCOUNT[level],
                                  alone[level], rng.random(n), rng.random(n))
    return SpellingModel(row_of, np.log10(np.maximum(total / keep, 1e-30)).astype(np.float32),
                         len(seen))


# -- word counts ---------------------------------------------------------------

class Vocabulary:
    """Distinct words of a block: hashes, bytes and counts, merged over its slices."""

    def __init__(self):
        self.parts: list = []

    def add(self, keys, counts, words):
        self.parts.append((keys, counts, words))

    def merged(self):
        keys = np.concatenate([p[0] for p in self.parts])
        counts = np.concatenate([p[1] for p in self.parts])
        words = pa.concat_arrays([p[2] for p in self.parts])
        uniq, first, inv = distinct(keys)
        self.parts = []
        return uniq, np.bincount(inv, weights=counts, minlength=len(uniq)).astype(np.int64), \
            words.take(pa.array(first)), inv


class Words:
    """Lower-cased words of a slice by row, with their hashes."""

    def __init__(self):
        self.hash, self.table, self.lower = WordHasher(41), byte_table("space"), lower_table()
        self.end = self.hash(np.zeros(1, np.uint8), np.zeros(1, np.int64), np.zeros(1, np.int64))

    def __call__(self, data, offs):
        low = self.lower[data]
        s, e, row = word_bounds(low, offs, self.table)
        return low, s, e, row, self.hash(low, s, e)

    def in_order(self, row, h, n: int):
        """Hashes of the tokens of ``n`` texts, each text's end token after its words."""
        out = np.repeat(self.end, len(h) + n)
        out[np.arange(len(h)) + row] = h
        return out


def pair_key(u, v):
    """One 64-bit key of two word hashes; ``PAIR_KEY`` is the same in SQL."""
    return (u << U(1) | u >> U(63)) ^ v


PAIR_KEY = "(shiftleft(u, 1) | shiftrightunsigned(u, 63)) ^ v"


def distinct(x: np.ndarray):
    """(distinct numbers, a place of each, number of each place's)."""
    order = np.argsort(x)
    x = x[order]
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    which = np.empty(len(x), np.int32)
    which[order] = np.cumsum(new, dtype=np.int32) - 1
    return x[new], order[new], which


def token_pairs(hashes, tokens, end):
    """(keys, first, second, pair of each token): the distinct pairs of a token with the
    one before, by key; tokens and their words are numbers into the sorted ``hashes``."""
    start = np.searchsorted(hashes, end).astype(np.int32)
    before = np.concatenate([start, tokens[:-1]])
    # no name for the tokens' keys: distinct lets them go once sorted
    keys, at, which = distinct(pair_key(hashes, U(0))[before] ^ hashes[tokens])
    return keys, before[at], tokens[at], which


def packed(x: np.ndarray) -> bytes:
    """Numbers by byte planes, compressed: planes that hardly vary take no room."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T
    return pa.compress(np.ascontiguousarray(planes), codec="zstd", asbytes=True)


def unpacked(data: bytes, kind, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = pa.decompress(data, decompressed_size=n * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, n).T) \
        .view(kind).ravel()


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys, as the gaps between them."""
    return packed(np.concatenate([keys[:1], keys[1:] - keys[:-1]]))


def unpacked_keys(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpacked(data, U, n), dtype=U)


def key_ranges(keys: np.ndarray, parts: int):
    """(part, from, to) of sorted keys dealt to equal ranges; ``part_of`` is the same in SQL."""
    part = (keys >> U(32)) * U(parts) >> U(32)
    edge = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *edge], [*edge, len(keys)]):
        if b > a:
            yield int(part[a]), int(a), int(b)


def part_of(key: str, parts: int):
    return F.expr(f"cast(shiftright(shiftrightunsigned({key}, 32) * {parts}L, 32) as int)")


HEADS, WORDS = "head", "word"
BLOCKS = ("kind string, block long, doc_ids array<long>, n_tokens array<long>, train binary, "
          "n_words int, hashes binary, tokens binary, w binary, n long")


def text_blocks(docs: DataFrame, block_bytes: int = 16 << 20) -> DataFrame:
    """Rows of blocks of texts: a head with the texts' tokens as numbers of the block's
    words, and a row (w, n) per word with its occurrences in training texts, which may
    be none; the empty word is the end."""
    def run(batches):
        words, part, number = Words(), TaskContext.get().partitionId(), 0
        schema = pa.schema([
            ("kind", pa.string()), ("block", pa.int64()),
            *((c, pa.list_(pa.int64())) for c in ("doc_ids", "n_tokens")),
            ("train", pa.binary()), ("n_words", pa.int32()),
            *((c, pa.binary()) for c in ("hashes", "tokens", "w")), ("n", pa.int64())])

        def fresh():
            return {"ids": [], "sizes": [], "train": [], "tokens": [], "words": Vocabulary(),
                    "n_words": 0, "held": 0}

        def emit(st):
            nonlocal number
            hashes, n, text, which = st["words"].merged()
            tokens = which[np.concatenate(st["tokens"])]
            yield pa.RecordBatch.from_pylist([{
                "kind": HEADS, "block": (part << 32) + number,
                "doc_ids": [x for p in st["ids"] for x in p],
                "n_tokens": np.concatenate(st["sizes"]),
                "train": np.concatenate(st["train"]).tobytes(), "n_words": len(hashes),
                "hashes": packed_keys(hashes), "tokens": packed(tokens)}], schema=schema)
            number += 1
            for a in range(0, len(n), 100_000):
                w = text.slice(a, 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(WORDS, len(w)),
                     *(pa.nulls(len(w), f.type) for f in list(schema)[1:-2]), w,
                     pa.array(n[a:a + 100_000])], schema=schema)

        st = fresh()
        for batch in batches:
            data, offs = string_buffer(batch.column(1))
            train = batch.column(2).fill_null(False).to_numpy(zero_copy_only=False)
            for a, b in slices(offs):
                low, s, e, row, h = words(data[offs[a]:offs[b]], offs[a:b + 1] - offs[a])
                h = words.in_order(row, h, b - a)
                size = row_counts(row, b - a) + 1
                # the end tokens' bytes are none
                bounds = np.zeros((2, len(h)), np.int64)
                bounds[:, np.arange(len(s)) + row] = s, e
                uniq, first, which = distinct(h)
                n = np.bincount(which, weights=np.repeat(train[a:b], size))
                st["words"].add(uniq, n, gather_bytes(low, *bounds[:, first]))
                st["tokens"].append(which + np.int32(st["n_words"]))
                st["n_words"] += len(uniq)
                st["sizes"].append(size)
                st["train"].append(train[a:b].astype(np.int8))
                st["ids"].append(batch.column(0).slice(a, b - a).to_pylist())
                st["held"] += int(offs[b] - offs[a])
                if st["held"] >= block_bytes:
                    yield from emit(st)
                    st = fresh()
        if st["tokens"]:
            yield from emit(st)

    return docs.select("doc_id", "text", "train").transform(map_batches, run, BLOCKS)


class Head:
    """A block's words and tokens."""

    def __init__(self, row: dict):
        self.doc_ids = row.get("doc_ids")
        self.sizes = np.asarray(row["n_tokens"], np.int64)
        self.hashes = unpacked_keys(row["hashes"], row["n_words"])
        tokens = unpacked(row["tokens"], np.int32, int(self.sizes.sum()))
        self.keys, self.first, self.second, self.at = token_pairs(self.hashes, tokens, Words().end)


COUNTS, AGAIN = "counts", "again"


def pair_counts(heads: DataFrame, parts: int) -> DataFrame:
    """The blocks' pairs by key range, counted, in rows (kind, block, part, m, data, once,
    twice): of each block and range the codes of its ``m`` pairs in order of their keys,
    and the keys of those counted twice or more.

    A code is twice the count in training texts, and one more in the one block that
    stands for the pair; one row a range has its numbers of pairs counted once and twice.
    """
    def ask(batches):
        for batch in batches:
            for row in batch.to_pylist():
                head = Head(row)
                train = np.frombuffer(row["train"], np.int8).repeat(head.sizes)
                n = np.bincount(head.at, weights=train).astype(np.int64)
                got = [(p, row["block"], b - a, packed_keys(head.keys[a:b]), packed(n[a:b]))
                       for p, a, b in key_ranges(head.keys, parts)]
                for a in range(0, len(got), 100):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, t) for x, t in zip(zip(*got[a:a + 100]), (
                            pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()))],
                        names=["part", "block", "m", "keys", "n"])

    def count(asked: pa.Table) -> pa.Table:
        rows = sorted(asked.to_pylist(), key=lambda r: r["block"])
        keys = np.concatenate([unpacked_keys(r["keys"], r["m"]) for r in rows])
        n = np.concatenate([unpacked(r["n"], np.int64, r["m"]) for r in rows])
        uniq, first, which = distinct(keys)
        c = np.bincount(which, weights=n).astype(np.int64)
        code = 2 * c[which]
        code[first] += 1
        out, a = [], 0
        for r in rows:
            b = a + r["m"]
            out.append({"kind": COUNTS, "block": r["block"], "part": r["part"], "m": r["m"],
                        "data": packed(code[a:b]), "once": 0 if a else int((c == 1).sum()),
                        "twice": 0 if a else int((c == 2).sum())})
            again = keys[a:b][code[a:b] > 3]
            if len(again):
                out.append({"kind": AGAIN, "block": r["block"], "part": r["part"],
                            "m": len(again), "data": packed_keys(again)})
            a = b
        return pa.Table.from_pylist(out, schema=pa.schema([
            ("kind", pa.string()), ("block", pa.int64()), ("part", pa.int32()),
            ("m", pa.int32()), ("data", pa.binary()), ("once", pa.int64()),
            ("twice", pa.int64())]))

    return heads.select("block", "n_tokens", "train", "n_words", "hashes", "tokens") \
        .transform(map_batches, ask, "part int, block long, m int, keys binary, n binary") \
        .groupBy("part").applyInArrow(trimmed(count), "kind string, block long, part int, m int, "
                                             "data binary, once long, twice long")


def answered(answers: pa.Table, kind: str, columns: dict) -> list[np.ndarray]:
    """The columns of a block's answers of a kind, over all key ranges in order."""
    rows = sorted((r for r in answers.to_pylist() if r["kind"] == kind), key=lambda r: r["part"])
    return [np.concatenate([np.zeros(0, t), *(unpacked(r[c], t, r["m"]) for r in rows)])
            for c, t in columns.items()]


def counts_as_answers(counted: DataFrame) -> DataFrame:
    return counted.select("block", F.lit(COUNT).alias("kind"), "part", "m",
                          F.col("data").alias("a"))


SUMS = "sums"


def owned_pairs(heads: DataFrame, counted: DataFrame, single: bool = False) -> DataFrame:
    """(kind, u, v, c): the pairs counted twice or more (``single``: once), each by the one
    block that stands for it, of the kind ``AGAIN``; and by block ``SUMS``, the word ``u``
    with ``v`` contexts and ``c`` followers among all counted pairs it stands for."""
    def run(heads: pa.Table, answers: pa.Table) -> pa.Table:
        head = Head(heads.to_pylist()[0])
        code, = answered(answers, COUNT, {"a": np.int64})
        c = code >> 1
        own = (code & 1 == 1) & (c > 0)
        h = head.hashes.view(np.int64)
        listed = np.flatnonzero(own & ((c == 1) if single else (c > 1)))
        contexts, followers = (np.bincount(x[own], minlength=len(h))
                               for x in (head.second, head.first))
        some = np.flatnonzero(contexts + followers)
        return pa.Table.from_arrays(
            [pa.concat_arrays([pa.repeat(AGAIN, len(listed)), pa.repeat(SUMS, len(some))]),
             *(pa.array(np.concatenate(x)) for x in (
                 (h[head.first[listed]], h[some]), (h[head.second[listed]], contexts[some]),
                 (c[listed], followers[some])))], names=["kind", "u", "v", "c"])

    return heads.select("block", "n_tokens", "n_words", "hashes", "tokens") \
        .groupBy("block").cogroup(counts_as_answers(counted).groupBy("block")) \
        .applyInArrow(trimmed(run), "kind string, u long, v long, c long")


@dataclass
class WordModel:
    tokens: int
    types: int
    discount: float
    tables: float
    spelling: SpellingModel | None

    @property
    def new_table(self) -> float:
        return THETA + self.discount * self.tables

    def gibbs(self, data, starts, ends, c, sweeps: int = 24, keep: int = 12):
        """(averaged tables, last tables, log10 of the spelling) of each word."""
        base = self.spelling.log10(data, starts, ends)
        mean, last = seating(c, self.new_table * 10.0 ** base, self.discount,
                             WordHasher(43)(data, starts, ends), sweeps, keep)
        return mean, last, base

    def log10(self, c, tables, base):
        return np.log10((c - self.discount * tables + self.new_table * 10.0 ** base)
                        / (THETA + self.tokens))

    @property
    def new_mass(self) -> float:
        """log10 of the share of new tables."""
        return np.log10(self.new_table / (THETA + self.tokens))

    def unseen(self, data, starts, ends):
        """log10 probability of words without customers."""
        return self.new_mass + self.spelling.log10(data, starts, ends)


def _cells(words: DataFrame, model: WordModel | None) -> DataFrame:
    """(context, symbol, n): spelling counts, a customer per table (one without a model)."""
    shared = Shared(words.sparkSession, model)

    def run(batches):
        model = shared.value
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in gathered(batches):
            data, offs = string_buffer(batch.column(0))
            c = batch.column(1).to_numpy()
            t = np.ones(len(c), np.int64) if model is None else \
                model.gibbs(data, offs[:-1], offs[1:], c)[1]
            sym, _, _, three, word = byte_contexts(data, offs[:-1], offs[1:])
            k, inv = np.unique(np.concatenate([keys, three * BYTES + sym]), return_inverse=True)
            counts = np.bincount(inv, weights=np.concatenate([counts, t[word]]),
                                 minlength=len(k)).astype(np.int64)
            keys = k
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys // BYTES), pa.array(keys % BYTES), pa.array(counts)],
            names=["context", "symbol", "n"])

    return words.select("w", "c").transform(map_batches, run, "context long, symbol long, n long") \
        .groupBy("context", "symbol").agg(F.sum("n").alias("n"))


def _spell(words: DataFrame, model: WordModel | None) -> tuple[SpellingModel, int]:
    got = _cells(words, model).toPandas().sort_values(["context", "symbol"])
    context, symbol, n = (got[k].to_numpy() for k in ("context", "symbol", "n"))
    return spelling_model(context, symbol, n), int(n[symbol == END].sum())


def train(words: DataFrame, start: WordModel | None = None) -> WordModel:
    """Sample the seating over a saved table (w, c) of words and their customers,
    from the spelling model of ``start`` or of one table a word."""
    facts = words.agg(F.sum("c"), F.count("*"), F.sum((F.col("c") == 1).cast("long")),
                      F.sum((F.col("c") == 2).cast("long"))).first()
    customers, types, once, twice = (int(x or 0) for x in facts)
    d = discount(once, twice)
    spelling = start.spelling if start else _spell(words, None)[0]
    guess = words.agg(F.sum(F.pow("c", F.lit(d)))).first()[0] or 0.0
    model = WordModel(customers, types, d, float(guess), spelling)
    spelling, tables = _spell(words, model)
    return WordModel(customers, types, d, float(tables), spelling)


def hashed(words: DataFrame) -> DataFrame:
    """(w, h, c): the word table with the hashes the texts' words are looked up by."""
    def run(batches):
        for batch in gathered(batches):
            data, offs = string_buffer(batch.column(0))
            h = WordHasher(41)(data, offs[:-1], offs[1:])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(h.view(np.int64)), batch.column(1)], ["w", "h", "c"])

    return map_batches(words.select("w", "c"), run, "w binary, h long, c long")


def word_scores(words: DataFrame, model: WordModel, d: float) -> DataFrame:
    """(h, c, lp, spelt, open) of words (w, h, c, customers, fan): log10 probability
    in the word restaurant, spelling probability, and the share that the word's own
    context restaurant, of ``fan`` tables and discount ``d``, leaves to new tables."""
    shared = Shared(words.sparkSession, model)

    def run(batches):
        model = shared.value
        for batch in gathered(batches):
            data, offs = string_buffer(batch.column(0))
            n, c = batch.column(3).to_numpy(), batch.column(2).to_numpy()
            tables, _, base = model.gibbs(data, offs[:-1], offs[1:], n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(model.log10(n, tables, base)),
                 pa.array(10.0 ** base),
                 pa.array((THETA + d * batch.column(4).to_numpy()) / (THETA + c))],
                names=["h", "c", "lp", "spelt", "open"])

    return map_batches(words.select("w", "h", "c", "customers", "fan"), run,
                       "h long, c long, lp double, spelt double, open double")


# -- context restaurants ---------------------------------------------------------

def _looked_up(rows: DataFrame, key: str, facts: DataFrame, top: DataFrame,
               column: str) -> DataFrame:
    """``rows`` with a column of the word ``key``: the most frequent words' by broadcast,
    the others' by a join, in which no key is frequent."""
    near = rows.join(F.broadcast(top.select(F.col("h").alias(key), column)), key, "left")
    far = near.where(F.col(column).isNull()).drop(column).join(
        facts.select(F.col("h").alias(key), column), key)
    return near.where(F.col(column).isNotNull()).unionByName(far)


def seat_pairs(pairs: DataFrame, facts: DataFrame, top: DataFrame, d: float) -> DataFrame:
    """(u, v, c, last, mean): sampled tables of pairs (u, v, c) that occur twice or more.

    A pair that occurs once has one table whatever the weights.
    """
    weights = facts.select("h", (F.col("open") * (F.col("c") + THETA)).alias("room"),
                           F.pow(F.lit(10.0), "lp").alias("p"), "c")
    chosen = weights.join(top.select("h"), "h", "left_semi")
    both = _looked_up(_looked_up(pairs, "u", weights, chosen, "room"), "v", weights, chosen, "p")

    def run(batches):
        for batch in gathered(batches):
            u, v = (batch.column(k).to_numpy().view(U) for k in (0, 1))
            mean, last = seating(batch.column(2).to_numpy(), batch.column(3).to_numpy(), d,
                                 mix64(pair_key(u, v)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(last), pa.array(mean)],
                names=["u", "v", "c", "last", "mean"])

    return map_batches(both.select("u", "v", "c", (F.col("room") * F.col("p")).alias("weight")),
                       run, "u long, v long, c long, last long, mean double")


def _customers(words: DataFrame, more: DataFrame) -> DataFrame:
    """Words (w, h, c) with their customers (tables of all contexts) and own contexts'
    tables, summed from (h, customers, fan); held-out words have none."""
    sums = more.groupBy("h").agg(F.sum("customers").alias("customers"), F.sum("fan").alias("fan"))
    return words.join(sums, "h", "left").fillna(0, ["customers", "fan"])


# -- scoring -------------------------------------------------------------------

DOCS = ("doc_id long, n_tokens long, n_known long, base_score double, score double, "
        "event_score double")
COUNT, MEAN, FACT = "count", "mean", "fact"
ANSWERS = "block long, kind string, part int, m int, a binary, b binary, c binary"


def unseen_words(words: DataFrame, model: WordModel) -> DataFrame:
    """(h, c, lp, open) of words (w, h) that training texts have not."""
    shared = Shared(words.sparkSession, model)

    def run(batches):
        model = shared.value
        for batch in gathered(batches):
            data, offs = string_buffer(batch.column(0))
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(np.zeros(n, np.int64)),
                 pa.array(model.unseen(data, offs[:-1], offs[1:])), pa.array(np.ones(n))],
                names=["h", "c", "lp", "open"])

    return map_batches(words.select("w", "h"), run, "h long, c long, lp double, open double")


def word_asks(heads: DataFrame, parts: int) -> DataFrame:
    """(block, part, m, keys): the blocks' words by key range."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                hashes = unpacked_keys(row["hashes"], row["n_words"])
                got = [(row["block"], p, b - a, packed_keys(hashes[a:b]))
                       for p, a, b in key_ranges(hashes, parts)]
                for a in range(0, len(got), 100):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, t) for x, t in zip(zip(*got[a:a + 100]), (
                            pa.int64(), pa.int32(), pa.int32(), pa.binary()))],
                        names=["block", "part", "m", "keys"])

    return heads.select("block", "n_words", "hashes").transform(
        map_batches, run, "block long, part int, m int, keys binary")


def answers(asks: DataFrame, table: DataFrame, kind: str, parts: int) -> DataFrame:
    """The columns of ``table`` (k, and up to three more) for the keys that blocks ask
    for, by key range; every key asked for is in the table."""
    names = [c for c in table.columns if c != "k"]

    def run(asked: pa.Table, rows: pa.Table) -> pa.Table:
        key = rows.column("k").to_numpy().view(U)
        order = np.argsort(key)
        key = key[order]
        values = [rows.column(c).to_numpy()[order] for c in names]
        out = []
        for r in asked.to_pylist():
            at = np.searchsorted(key, unpacked_keys(r["keys"], r["m"]))
            out.append({"block": r["block"], "kind": kind, "part": r["part"], "m": r["m"]} | {
                c: packed(x[at]) for c, x in zip("abc", values)})
        return pa.Table.from_pylist(out, schema=pa.schema([
            ("block", pa.int64()), ("kind", pa.string()), ("part", pa.int32()),
            ("m", pa.int32()), *((c, pa.binary()) for c in "abc")]))

    return asks.groupBy("part").cogroup(
        table.withColumn("part", part_of("k", parts)).groupBy("part")) \
        .applyInArrow(trimmed(run), ANSWERS)


def most_frequent(words: DataFrame, most: int) -> DataFrame:
    """The words over the lowest count (in eighths of a power of two) that leaves
    at most ``most`` of them; only the counts' histogram is gathered, no ranking."""
    level = F.floor(8 * F.log2("c")).cast("int")
    hist = sorted(((r["level"], r["n"]) for r in words.groupBy(level.alias("level")).agg(
        F.count("*").alias("n")).collect()), reverse=True)
    cut, held = 1 << 20, 0
    for at, n in hist:
        if held + n > most:
            break
        cut, held = at, held + n
    return words.where(level >= cut)


def block_scores(head: Head, answers: pa.Table, d: float, tokens: int, types: int,
                 unknown: float) -> pa.Table:
    """A block's texts, scored by what was answered of its pairs and words."""
    c, lp, share = answered(answers, FACT, {"a": np.int64, "b": float, "c": float})
    of_pair = answered(answers, COUNT, {"a": np.int64})[0] >> 1
    head.keys = None
    seat = np.where(of_pair > 0, of_pair - d, 0.0)
    again = np.flatnonzero(of_pair > 1)
    seat[again] = of_pair[again] - d * answered(answers, MEAN, {"a": float})[0]
    del of_pair, again
    seat /= THETA + c[head.first]
    known = c[head.second] > 0
    share = np.log10(share)[head.first]
    back = share + lp[head.second]
    score = 10.0 ** back
    score += seat
    np.log10(np.maximum(score, 1e-300, out=score), out=score)
    score = np.where(seat > 0, score, back)
    del back, seat
    start = np.cumsum(head.sizes) - head.sizes

    def total(of_pair):
        return np.add.reduceat(of_pair[head.at], start)

    return pa.Table.from_arrays(
        [pa.array(head.doc_ids, pa.int64()), pa.array(head.sizes),
         pa.array(total(known.astype(np.int64))),
         pa.array(total(np.log10((c + 1.0) / (tokens + types + 1.0))[head.second])),
         pa.array(total(score)),
         # an unseen word has no seat in any context
         pa.array(total(np.where(known, score, share + unknown)))],
        names=["doc_id", "n_tokens", "n_known", "base_score", "score", "event_score"])


@dataclass
class Fit:
    """Saved tables and numbers of a learned model; ``words`` also has held-out words."""
    heads: DataFrame
    counted: DataFrame
    again: DataFrame
    seated: DataFrame
    words: DataFrame
    facts: DataFrame
    top: DataFrame
    discount: float
    model: WordModel
    tokens: int
    types: int
    parts: int


def fitted(docs: DataFrame, block_bytes: int, shared_words: int, kept: Kept) -> Fit:
    heads, words = kept.saved_by(text_blocks(docs, block_bytes), "blocks", "kind",
                                 [HEADS, WORDS])
    n = heads.count()
    # a range holds about as many pairs as a quarter of a block, of very many blocks a block
    parts = max(min(4 * n, max(n, 512)), 1)
    types = kept.saved(hashed(words.groupBy("w").agg(F.sum("n").alias("c"))), "types")
    kept.drop(words)
    tokens, n_types = types.agg(F.sum("c"), F.sum((F.col("c") > 0).cast("long"))).first()
    counted, again = kept.saved_by(pair_counts(heads, parts), "counted", "kind", [COUNTS, AGAIN])
    d = discount(*(int(x or 0) for x in counted.agg(F.sum("once"), F.sum("twice")).first()))
    pairs, sums = kept.saved_by(owned_pairs(heads, counted), "owned", "kind", [AGAIN, SUMS])

    def restaurant(words, start):
        seen = words.where("customers > 0")
        model = train(seen.select("w", F.col("customers").alias("c")), start)
        facts = kept.saved(word_scores(seen, model, d), "scored")
        return facts, most_frequent(facts, shared_words), model
    words = kept.saved(_customers(types, sums.select(
        F.col("u").alias("h"), F.col("v").alias("customers"),
        F.col("c").cast("double").alias("fan"))), "customers")
    kept.drop(types, sums)
    facts, top, model = restaurant(words, None)
    seated = kept.saved(seat_pairs(pairs, facts, top, d), "seated")
    kept.drop(pairs, facts)
    # what pairs have beyond the one table of the first round
    more = seated.select(F.col("v").alias("h"), (F.col("last") - 1).alias("customers"),
                         F.lit(0.0).alias("fan")).unionByName(
        seated.select(F.col("u").alias("h"), F.lit(0).cast("long").alias("customers"),
                      (F.col("mean") - 1).alias("fan")))
    first, words = words, kept.saved(_customers(
        words.withColumnsRenamed({"customers": "was", "fan": "had"}), more).select(
            "w", "h", "c", (F.col("was") + F.col("customers")).alias("customers"),
            (F.col("had") + F.col("fan")).alias("fan")), "customers")
    kept.drop(first)
    facts, top, model = restaurant(words, model)
    return Fit(heads, counted, again, seated, words, facts, top, d, model, int(tokens or 0),
               int(n_types or 0), parts)


def learned(docs: DataFrame, block_bytes: int, shared_words: int):
    """(word facts, shared words, seated pairs, their discount, word model, tokens, types)."""
    fit = fitted(docs, block_bytes, shared_words, Kept(docs.sparkSession))
    single = owned_pairs(fit.heads, fit.counted, single=True).where(F.col("kind") == AGAIN) \
        .drop("kind").withColumns({"last": F.lit(1).cast("long"), "mean": F.lit(1.0)})
    return (fit.facts, fit.top, fit.seated.unionByName(single), fit.discount, fit.model,
            fit.tokens, fit.types)


def score_texts(docs: DataFrame, shared_words: int = 1 << 17,
                block_bytes: int = 16 << 20) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score, event_score) of
    documents (doc_id, text, train), learned from those with ``train``."""
    kept = Kept(docs.sparkSession)
    with kept:
        fit = fitted(docs, block_bytes, shared_words, kept)
        d, tokens, types, parts = fit.discount, fit.tokens, fit.types, fit.parts
        means = kept.saved(answers(
            fit.again.select("block", "part", "m", F.col("data").alias("keys")),
            fit.seated.select(F.expr(PAIR_KEY).alias("k"), "mean"), MEAN, parts), "means")
        kept.drop(fit.seated, fit.again)
        known = fit.facts.select(F.col("h").alias("k"), "c", "lp", "open").unionByName(
            unseen_words(fit.words.where("c = 0"), fit.model).withColumnRenamed("h", "k"))
        facts = kept.saved(answers(word_asks(fit.heads, parts), known, FACT, parts), "facts")
        spelt = fit.facts.agg(F.sum("spelt")).first()[0] or 0.0
        unknown = float(np.log10(max(1 - spelt, 1e-9)) + fit.model.new_mass)
        kept.drop(fit.words, fit.facts)
    got = counts_as_answers(fit.counted).unionByName(means, allowMissingColumns=True) \
        .unionByName(facts, allowMissingColumns=True)

    def finish(heads: pa.Table, got: pa.Table) -> pa.Table:
        return block_scores(Head(heads.to_pylist()[0]), got, d, tokens, types, unknown)

    return fit.heads.select("block", "doc_ids", "n_tokens", "n_words", "hashes", "tokens") \
        .groupBy("block").cogroup(got.groupBy("block")).applyInArrow(trimmed(finish), DOCS)\
        .withColumn("train_tokens", F.lit(tokens).cast("long"))
