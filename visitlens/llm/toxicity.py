"""Toxicity by multiple-instance learning over sentences (operator 8).

A document's label says only that some sentence is toxic. Each sentence has
a logistic score over its words and the document's score is their noisy-or,
1 - prod(1 - p_sentence); the weights are trained from document labels
through the noisy-or, so that the sentences that explain a label get the
blame. Scoring returns each text's probability and the sentences over the
threshold.

Fitting reads at most about ``sample_docs`` labelled texts and ``sample_bytes`` of
them, picked by a hash of the row, none longer than a sixteenth of that (a
documented bound, as the driver holds the sample); words are features when they occur in
``min_docs`` sampled texts, at most ``features`` of them by a fixed order.
Scoring covers every row and whole texts.

Edge cases: a null or empty text, or one without known words, has the score
of no sentence speaking (the bias of one sentence); null labels are left
out; a sample without both classes gives a constant score; repeated rows are
scored alike; an empty table gives no rows; other columns are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.llm.frames import map_batches, Shared
from visitlens.llm.text import (U, WordHasher, byte_table, lower_table, mix64, slices,
                                string_buffer, word_bounds)


def sentence_marks() -> np.ndarray:
    """Bytes that end a sentence."""
    t = np.zeros(256, bool)
    t[[10, 13, 33, 46, 63]] = True
    return t


class Sentences:
    """Words (lower-cased, digits and letters) with their sentence numbers in a slice."""

    def __init__(self):
        self.hash, self.table = WordHasher(21), byte_table("alnum")
        self.lower, self.marks = lower_table(), sentence_marks()

    def __call__(self, data, offs):
        """(word hash, word row, sentence of word, sentence rows, sentence byte ranges)."""
        low = self.lower[data]
        s, e, row = word_bounds(low, offs, self.table)
        if not len(s):
            z = np.zeros(0, np.int64)
            return np.zeros(0, U), z, z, z, z, z
        ends = np.concatenate([[0], np.cumsum(self.marks[data])])[s]
        head = np.ones(len(s), bool)
        head[1:] = (ends[1:] != ends[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(head)
        last = np.append(first[1:], len(s)) - 1
        return (self.hash(low, s, e), row, np.cumsum(head) - 1, row[first], s[first], e[last])


@dataclass
class ToxicityModel:
    keys: np.ndarray        # ascending word hashes
    weights: np.ndarray
    bias: float

    def sentence_scores(self, words, sentence, count):
        """Probability of each of ``count`` sentences; a word counts once in a sentence."""
        if not len(self.keys):
            return np.full(count, 1 / (1 + np.exp(-self.bias)))
        k = np.minimum(np.searchsorted(self.keys, words), len(self.keys) - 1)
        known = self.keys[k] == words
        pair = np.unique(sentence[known] * len(self.keys) + k[known])
        logit = self.bias + np.bincount(pair // len(self.keys),
                                        weights=self.weights[pair % len(self.keys)],
                                        minlength=count)
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def train_noisy_or(doc: np.ndarray, pairs: np.ndarray, labels: np.ndarray, features: int,
                   rounds: int = 300, rate: float = 0.1, l2: float = 0.1,
                   l1: float = 1.0) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam on the noisy-or log-likelihood.

    ``doc`` is each sentence's document, ``pairs`` (sentence, feature) rows.
    """
    sent, feat = pairs[:, 0], pairs[:, 1]
    n = len(labels)
    w = np.zeros(features)
    per = np.bincount(doc, minlength=n)
    base = np.clip(labels.mean(), 1e-3, 0.999)
    b = float(np.log(base / max(np.mean(per), 1.0)) - 1)
    m, v = np.zeros(features + 1), np.zeros(features + 1)
    for t in range(1, rounds + 1):
        z = b + np.bincount(sent, weights=w[feat], minlength=len(doc))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        stay = np.bincount(doc, weights=np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=n)
        clean = np.exp(stay)
        # d(-log likelihood)/dz: p for clean documents, -p * P(clean)/P(toxic) for toxic ones
        part = np.where(labels > 0, -clean / np.maximum(1 - clean, 1e-9), 1.0)
        dz = p * part[doc]
        g = np.append(np.bincount(feat, weights=dz[sent], minlength=features)
                      + l2 * w + l1 * np.sign(w), dz.sum())
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-6)
        w = w - step[:-1]
        b = float(b - step[-1])
    w[np.abs(w) < 2e-2] = 0
    return w, b


def fit(labelled: DataFrame, sample_docs: int = 6000, min_docs: int = 5, features: int = 50_000,
        text_col: str = "text", label_col: str = "toxic", row_key: Column | None = None,
        sample_bytes: int = 64 << 20) -> ToxicityModel:
    """Train on about ``sample_docs`` of the labelled rows (text, label 0/1), and on about
    ``sample_bytes`` of text at most."""
    size = F.octet_length(text_col)
    rows = labelled.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull()
                          & (size <= sample_bytes // 16))
    total = rows.select(label_col).count()
    key = row_key if row_key is not None else F.xxhash64(text_col)

    def sample(share):
        return rows if share >= 1 else rows.where(
            F.pmod(key, F.lit(1 << 20)) < int((1 << 20) * share))
    # the bytes of the sampled texts alone are summed, so that no other text is moved
    share = min(1.0, sample_docs / max(total, 1))
    held = sample(share).agg(F.sum(size)).first()[0] or 0
    rows = sample(share * min(1.0, sample_bytes / max(held, 1)))

    def sentences(batches):
        split = Sentences()
        for batch in batches:
            data, offs = string_buffer(batch.column(0))
            for a, b in slices(offs):
                words, row, sent, sent_row, *_ = split(data[offs[a]:offs[b]],
                                                       offs[a:b + 1] - offs[a])
                size = np.bincount(row, minlength=b - a)
                at = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                first = np.zeros(b - a, np.int64)
                if len(sent):
                    has = size > 0
                    first[has] = sent[at[:-1][has]]
                yield pa.RecordBatch.from_arrays([
                    batch.column(1).slice(a, b - a), batch.column(2).slice(a, b - a),
                    pa.ListArray.from_arrays(pa.array(at), pa.array(words.view(np.int64))),
                    pa.ListArray.from_arrays(pa.array(at), pa.array(
                        (sent - first[row]).astype(np.int32)))],
                    names=["row", "label", "words", "sent"])

    got = rows.select(text_col, key.alias("row"), F.col(label_col).cast("int")).transform(map_batches,
        sentences, "row long, label int, words array<long>, sent array<int>").toArrow()
    label = got.column("label").to_numpy()
    words = got.column("words").combine_chunks()
    sent = got.column("sent").combine_chunks().flatten().to_numpy()
    size = np.diff(np.asarray(words.offsets))
    words = words.flatten().to_numpy().view(U)
    # a fixed order of the rows, whatever order the tasks returned them in
    order = np.lexsort((label, got.column("row").to_numpy()))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    label = label[order]
    if len(label) == 0 or label.min() == label.max():
        base = float(label.mean()) if len(label) else 0.0
        base = min(max(base, 1e-3), 1 - 1e-3)
        return ToxicityModel(np.zeros(0, U), np.zeros(0), float(np.log(base / (1 - base))))
    doc = np.repeat(place, size)
    uniq, inv = np.unique(words, return_inverse=True)
    seen = np.unique(inv * len(label) + doc)
    df = np.bincount(seen // len(label), minlength=len(uniq))
    keep = np.flatnonzero(df >= min_docs)
    if len(keep) > features:
        keep = np.sort(keep[np.lexsort((mix64(uniq[keep]), -df[keep]))][:features])
    number = np.full(len(uniq), -1)
    number[keep] = np.arange(len(keep))
    key2 = doc * (int(sent.max(initial=0)) + 1) + sent
    sentence_key, sentence = np.unique(key2, return_inverse=True)
    feat = number[inv]
    pair = np.unique(sentence[feat >= 0] * max(len(keep), 1) + feat[feat >= 0])
    pairs = np.stack([pair // max(len(keep), 1), pair % max(len(keep), 1)], 1)
    w, b = train_noisy_or(sentence_key // (int(sent.max(initial=0)) + 1), pairs,
                          label.astype(float), len(keep))
    used = w != 0
    return ToxicityModel(uniq[keep][used], w[used], b)


def score(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5,
          text_col: str = "text") -> DataFrame:
    """``docs`` with score and offenders: sentences with at least ``threshold``."""
    shared = Shared(docs.sparkSession, model)

    def run(batches):
        model, split = shared.value, Sentences()
        silent = float(model.sentence_scores(np.zeros(0, U), np.zeros(0, np.int64), 1)[0])
        for batch in batches:
            data, offs = string_buffer(batch.column(text_col))
            for a, b in slices(offs):
                part = data[offs[a]:offs[b]]
                words, _, sent, sent_row, s, e = split(part, offs[a:b + 1] - offs[a])
                p = model.sentence_scores(words, sent, len(sent_row))
                stay = np.bincount(sent_row, weights=np.log1p(-np.minimum(p, 1 - 1e-12)),
                                   minlength=b - a)
                total = np.where(np.bincount(sent_row, minlength=b - a) > 0,
                                 1 - np.exp(stay), silent)
                bad = np.flatnonzero(p >= threshold)
                raw = part.tobytes()
                text = [raw[x:y].decode() for x, y in zip(s[bad].tolist(), e[bad].tolist())]
                at = np.concatenate([[0], np.cumsum(np.bincount(sent_row[bad], minlength=b - a))])
                cols = {c: batch.column(c).slice(a, b - a) for c in batch.schema.names}
                cols |= {"score": pa.array(total), "offenders": pa.ListArray.from_arrays(
                    pa.array(at.astype(np.int32)), pa.StructArray.from_arrays(
                        [pa.array(text, pa.string()), pa.array(p[bad])],
                        names=["sentence", "score"]))}
                yield pa.RecordBatch.from_pydict(cols)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields
                       if f.name not in ("score", "offenders"))
    return docs.drop("score", "offenders").transform(map_batches,
        run, f"{fields}, score double, offenders array<struct<sentence:string,score:double>>")
