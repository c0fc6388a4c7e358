"""Language identification by scripts, word scores and Viterbi spans (operator 2).

A word's script narrows the languages it may belong to. Within them the word
is scored by smoothed log-probabilities of its letter n-grams. Viterbi over
a text's words, with a penalty for each switch of language, labels spans;
the language whose spans hold most letters is predicted, with its share of
the letters as score.

Fitting reads a bounded sample: about ``sample_docs`` texts a language,
picked by a hash of the row (a documented bound; prediction covers all rows).
The model is a table of ``2^BITS`` hashed n-grams a language, counted in
Spark, so its size depends on the number of languages alone.

Edge cases: a null text or one without a letter is ``und`` with score 0 and
no spans; a script that no learned language uses leaves all languages open;
ties go to the language first in the alphabet; repeated rows are labelled
alike; without labelled texts every row is ``und``; an empty table gives no
rows; other columns are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.llm.frames import map_batches, Shared
from visitlens.llm.text import U, WordHasher, row_counts, slices, string_buffer, word_bounds

BITS = 17
ORDERS = (1, 2, 3, 4)
CHUNK = 32
PART_BYTES = 1 << 18     # of text at a time; a pass over it takes about 70 times that

# Unicode block ranges of scripts.
SCRIPTS = [
    ("latin", 0x0041, 0x024F), ("ipa", 0x0250, 0x02FF), ("greek", 0x0370, 0x03FF),
    ("cyrillic", 0x0400, 0x052F), ("armenian", 0x0530, 0x058F), ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x077F), ("devanagari", 0x0900, 0x097F), ("bengali", 0x0980, 0x09FF),
    ("gurmukhi", 0x0A00, 0x0A7F), ("gujarati", 0x0A80, 0x0AFF), ("tamil", 0x0B80, 0x0BFF),
    ("telugu", 0x0C00, 0x0C7F), ("kannada", 0x0C80, 0x0CFF), ("malayalam", 0x0D00, 0x0D7F),
    ("thai", 0x0E00, 0x0E7F), ("lao", 0x0E80, 0x0EFF), ("georgian", 0x10A0, 0x10FF),
    ("ethiopic", 0x1200, 0x137F), ("khmer", 0x1780, 0x17FF), ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x1F00, 0x1FFF), ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF), ("other", 0x10000, 0x10FFFF)]
NAMES = sorted({s[0] for s in SCRIPTS} | {"other"})


def letter_table() -> np.ndarray:
    t = np.zeros(256, bool)
    t[65:91] = t[97:123] = True
    t[128:] = True
    return t


def script_of(word: str) -> int:
    """Script number of the first letter, -1 without a letter."""
    for ch in word:
        if ch.isalpha():
            c = ord(ch)
            for name, lo, hi in SCRIPTS:
                if lo <= c <= hi:
                    return NAMES.index(name)
            return NAMES.index("other")
    return -1


def normal_words(words: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """Lower-cased words and their scripts."""
    latin = NAMES.index("latin")
    out, scripts = [], np.full(len(words), latin, np.int64)
    for i, w in enumerate(words):
        if w.isascii():
            out.append(w.lower())
        else:
            text = w.decode("utf-8", "replace")
            scripts[i] = script_of(text)
            out.append(text.lower().encode())
    return out, scripts


def gram_buckets(words: list[bytes]):
    """For each order: (bucket per byte position, validity), and the words' starts."""
    size = np.array([len(w) + 2 for w in words], np.int64)
    start = np.cumsum(size) - size
    buf = np.frombuffer(b"".join(b" " + w + b" " for w in words), np.uint8).astype(U)
    end = np.repeat(start + size, size)
    at = np.arange(len(buf))
    value = np.zeros(len(buf), U)
    grams = []
    for n in range(1, max(ORDERS) + 1):
        value[:len(buf) - n + 1] = (value[:len(buf) - n + 1] << U(8)) | buf[n - 1:]
        if n in ORDERS:
            h = (value + U(n << 40)) * U(0x9E3779B97F4A7C15)
            h = (h ^ (h >> U(29))) * U(0xBF58476D1CE4E5B9)
            grams.append(((h >> U(64 - BITS)).astype(np.int64), at + n <= end))
    return grams, start


def unique_words(hasher, data, offs, table):
    """Bounds, rows and hashes of words, with the distinct ones' first places."""
    s, e, row = word_bounds(data, offs, table)
    uniq, first, inv = np.unique(hasher(data, s, e), return_index=True, return_inverse=True)
    return s, e, row, uniq, first, inv


@dataclass
class LanguageModel:
    langs: list[str]
    logp: np.ndarray        # buckets x languages
    allowed: np.ndarray     # scripts x languages

    def score(self, words: list[bytes]) -> np.ndarray:
        """Log-score of each word per language; rows of -inf have no letter."""
        normal, scripts = normal_words(words)
        total = np.zeros((len(words), len(self.langs)), np.float32)
        grams, start = gram_buckets(normal)
        for bucket, ok in grams:
            total += np.add.reduceat(np.where(ok[:, None], self.logp[bucket], 0), start)
        total *= 0.5
        total[~self.allowed[scripts]] -= 50
        total[scripts < 0] = -np.inf
        return total


def fit(labelled: DataFrame, sample_docs: int = 2000, text_col: str = "text",
        lang_col: str = "lang", row_key: Column | None = None) -> LanguageModel:
    """Fit on about ``sample_docs`` texts of each language.

    ``row_key`` decides which rows are sampled (default: the text's hash).
    """
    rows = labelled.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    counts = {r[lang_col]: r["n"] for r in rows.groupBy(lang_col)
              .agg(F.count("*").alias("n")).collect()}
    langs = sorted(counts)
    if not langs:
        return LanguageModel([], np.zeros((1 << BITS, 0), np.float32),
                             np.zeros((len(NAMES), 0), bool))
    share = F.create_map(*(F.lit(x) for lang in langs for x in
                           (lang, min(1.0, sample_docs / counts[lang]))))
    key = row_key if row_key is not None else F.xxhash64(text_col)
    rows = rows.where(F.pmod(key, F.lit(1 << 20)) < share[F.col(lang_col)] * (1 << 20))
    number = F.create_map(*(F.lit(x) for i, lang in enumerate(langs) for x in (lang, i)))
    width = 1 << BITS

    def count(batches):
        hasher, table = WordHasher(11), letter_table()
        grams_of = np.zeros((len(langs), width), np.int64)
        scripts_of = np.zeros((len(langs), len(NAMES)), np.int64)
        for batch in batches:
            data, offs = string_buffer(batch.column(0))
            lang = batch.column(1).to_numpy()
            for a, b in slices(offs, PART_BYTES):
                part = data[offs[a]:offs[b]]
                s, e, row, uniq, first, inv = unique_words(
                    hasher, part, offs[a:b + 1] - offs[a], table)
                if not len(uniq):
                    continue
                raw = part.tobytes()
                words, scripts = normal_words([raw[x:y] for x, y in zip(
                    s[first].tolist(), e[first].tolist())])
                grams, start = gram_buckets(words)
                size = np.diff(np.append(start, len(grams[0][0])))
                for k in np.unique(lang[a:b]):
                    times = np.bincount(inv[lang[a:b][row] == k], minlength=len(uniq))
                    times[scripts < 0] = 0
                    np.add.at(scripts_of[k], scripts, times)
                    weight = np.repeat(times, size)
                    for bucket, ok in grams:
                        grams_of[k] += np.bincount(bucket, weights=np.where(ok, weight, 0),
                                                   minlength=width).astype(np.int64)
        for kind, table_ in ((0, grams_of), (1, scripts_of)):
            i, j = np.nonzero(table_)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(i), kind, np.int32)), pa.array(i.astype(np.int32)),
                pa.array(j.astype(np.int32)), pa.array(table_[i, j])],
                names=["kind", "lang", "slot", "n"])

    got = rows.select(text_col, number[F.col(lang_col)].alias("lang")).transform(map_batches,
        count, "kind int, lang int, slot int, n long").groupBy("kind", "lang", "slot").agg(
        F.sum("n").alias("n")).toPandas()
    grams_of = np.zeros((len(langs), width))
    scripts_of = np.zeros((len(langs), len(NAMES)))
    for kind, table_ in ((0, grams_of), (1, scripts_of)):
        part = got[got["kind"] == kind]
        table_[part["lang"], part["slot"]] = part["n"]
    used = (grams_of.sum(0) > 0).sum()
    prob = (grams_of + 0.1) / (grams_of.sum(1, keepdims=True) + 0.1 * max(used, 1))
    allowed = scripts_of / np.maximum(scripts_of.sum(1, keepdims=True), 1) >= 0.01
    allowed = allowed.T
    allowed[~allowed.any(1)] = True
    return LanguageModel(langs, np.log(prob).T.astype(np.float32).copy(), allowed)


def viterbi(score: np.ndarray, doc_start: np.ndarray, doc_size: np.ndarray,
            penalty: float) -> np.ndarray:
    """Best state of each word; a switch between words of a text costs ``penalty``.

    Texts are cut into chunks. All chunks' transfer matrices (best score from
    each state before to each state after) are made at once, ``CHUNK`` steps
    in all; a pass over each text's chunks finds the states between chunks;
    a second pass inside all chunks finds the words' states. The result is
    that of the plain recursion.
    """
    states = score.shape[1]
    out = np.zeros(len(score), np.int64)
    live = np.flatnonzero(doc_size)
    limit = max(1, (1 << 22) // (states * states))
    chunks_of = -(-doc_size[live] // CHUNK)
    group = np.cumsum(chunks_of) // max(limit, 1)
    for g in np.unique(group):
        docs = live[group == g]
        per = chunks_of[group == g]
        first = np.cumsum(per) - per
        doc = np.repeat(np.arange(len(docs)), per)
        k = np.arange(len(doc)) - first[doc]
        at = (doc_start[docs][doc] + k * CHUNK)[:, None] + np.arange(CHUNK)
        ok = (k * CHUNK)[:, None] + np.arange(CHUNK) < doc_size[docs][doc][:, None]
        s = np.where(ok[:, :, None], score[np.minimum(at, len(score) - 1)], 0)
        m = np.full((len(doc), states, states), -np.inf, np.float32)
        m[:, np.arange(states), np.arange(states)] = 0
        for t in range(CHUNK):
            m = np.maximum(m, m.max(2, keepdims=True) - penalty) + s[:, t, None, :]
        # between the chunks of each text, longest texts first
        order = np.argsort(-per, kind="stable")
        value = np.zeros((len(docs), states))
        came = np.zeros((len(doc), states), np.int32)
        alive = np.searchsorted(-per[order], -np.arange(per.max()), side="left")
        for step in range(int(per.max())):
            d = order[:alive[step]]
            c = first[d] + step
            total = value[d][:, :, None] + m[c]
            came[c] = total.argmax(1)
            value[d] = total.max(1)
        before = np.zeros(len(doc), np.int64)
        after = np.zeros(len(doc), np.int64)
        state = value.argmax(1)
        for step in range(int(per.max()) - 1, -1, -1):
            d = order[:alive[step]]
            c = first[d] + step
            after[c] = state[d]
            before[c] = came[c, state[d]]
            state[d] = before[c]
        v = np.full((len(doc), states), -np.inf, np.float32)
        v[np.arange(len(doc)), before] = 0
        back = np.zeros((CHUNK, len(doc), states), np.int32)
        own = np.arange(states)
        for t in range(CHUNK):
            best = v.argmax(1)
            jump = v[np.arange(len(doc)), best] - penalty
            stay = v >= jump[:, None]
            back[t] = np.where(stay, own, best[:, None])
            v = np.where(stay, v, jump[:, None]) + s[:, t]
        label = np.zeros((len(doc), CHUNK), np.int64)
        state = after
        for t in range(CHUNK - 1, -1, -1):
            label[:, t] = state
            state = back[t][np.arange(len(doc)), state]
        out[at[ok]] = label[ok]
    return out


class ScoreCache:
    """Score rows of words by their hash, emptied beyond ``limit`` words."""

    def __init__(self, model: LanguageModel, limit: int = 300_000):
        self.model, self.limit = model, limit
        self.keys = np.zeros(0, U)
        self.rows = np.zeros((0, len(model.langs)), np.float32)

    def get(self, keys: np.ndarray, words_at) -> np.ndarray:
        """Rows of ascending ``keys``; ``words_at(i)`` gives the words of new ones."""
        k = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        new = np.flatnonzero(self.keys[k] != keys) if len(self.keys) else np.arange(len(keys))
        if len(self.keys) + len(new) > self.limit:
            self.keys, self.rows = self.keys[:0], self.rows[:0]
            new = np.arange(len(keys))
        if len(new):
            rows = self.model.score(words_at(new))
            self.keys = np.concatenate([self.keys, keys[new]])
            order = np.argsort(self.keys, kind="stable")
            self.keys = self.keys[order]
            self.rows = np.concatenate([self.rows, rows])[order]
        return self.rows[np.searchsorted(self.keys, keys)]


LABELS = "lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>"


def identify(docs: DataFrame, model: LanguageModel, penalty: float = 6.0,
             text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and spans (ranges of the text's letter words)."""
    shared = Shared(docs.sparkSession, model)

    def run(batches):
        model = shared.value
        hasher, table, cache = WordHasher(11), letter_table(), ScoreCache(model)
        names = pa.array(model.langs + ["und"], pa.string())
        und = len(model.langs)
        for batch in batches:
            data, offs = string_buffer(batch.column(text_col))
            for a, b in slices(offs, PART_BYTES):
                part = data[offs[a]:offs[b]]
                s, e, row, uniq, first, inv = unique_words(
                    hasher, part, offs[a:b + 1] - offs[a], table)
                n = b - a
                pred = np.full(n, und)
                share = np.zeros(n)
                run_row = run_lang = run_s = run_e = np.zeros(0, np.int64)
                if len(uniq) and und:
                    raw = part.tobytes()
                    at = cache.get(uniq, lambda new: [raw[x:y] for x, y in zip(  # noqa: B023
                        s[first[new]].tolist(), e[first[new]].tolist())])  # noqa: B023
                    score = at[inv]
                    has = np.isfinite(score[:, 0])
                    # letters, not bytes: bytes that begin a character
                    begun = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])
                    score, row, size = score[has], row[has], (begun[e] - begun[s])[has]
                    counts = row_counts(row, n)
                    begin = np.cumsum(counts) - counts
                    label = viterbi(score, begin, counts, penalty)
                    letters = np.bincount(row * und + label, weights=size,
                                          minlength=n * und).reshape(n, und)
                    some = counts > 0
                    pred[some] = letters[some].argmax(1)
                    share[some] = letters[some].max(1) / letters[some].sum(1)
                    head = np.ones(len(row), bool)
                    head[1:] = (row[1:] != row[:-1]) | (label[1:] != label[:-1])
                    run_at = np.flatnonzero(head)
                    run_row, run_lang = row[run_at], label[run_at]
                    run_s = run_at - begin[run_row]
                    run_e = np.append(run_at[1:], len(row)) - begin[run_row]
                spans = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(row_counts(run_row, n))])
                             .astype(np.int32)),
                    pa.StructArray.from_arrays([
                        pa.array(run_s.astype(np.int32)), pa.array(run_e.astype(np.int32)),
                        names.take(pa.array(run_lang))], names=["start", "end", "lang"]))
                cols = {c: batch.column(c).slice(a, n) for c in batch.schema.names}
                cols |= {"lang_pred": names.take(pa.array(pred)), "score": pa.array(share),
                         "spans": spans}
                yield pa.RecordBatch.from_pydict(cols)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields
                       if f.name not in ("lang_pred", "score", "spans"))
    return map_batches(docs.drop("lang_pred", "score", "spans"), run, f"{fields}, {LABELS}")
