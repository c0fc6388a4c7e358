"""Operator 6: exact token ids, gapless sequences, the linear program."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from visitlens.llm import packing
from visitlens.llm.queries import tokenizer_json
from visitlens.llm.text import string_buffer
from edge_rows import edge_docs, no_docs  # noqa: F401


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_str(tokenizer_json())


def test_chunked_tokens_equal_the_tokenizer(tokenizer):
    rng = random.Random(1)
    parts = ["don't", "a'b", "'s", "é", "É.", "×", "a×", "÷.", "ñ,", "<|endoftext|>",
             "<|startoftext|>", "abc<|endoftext|>", "́", "é", "é.", "≠", "中文", "”.",
             "a”.", "12", "1a.", " ", "\x1c", "\x85", "ß!", "İ", "İ$", "ΑΣ.", "🙂", "''", "it's.",
             "...", "$%&", "the", "The.", "they're", "\x00", "‍", "a­b"]
    cache = packing.WordCache(tokenizer, 300)
    for _ in range(400):
        texts = ["".join(rng.choice(parts) + rng.choice(["", "", " ", "\n", "\t", "\x0b"])
                         for _ in range(rng.randint(0, 14))) for _ in range(5)]
        ids, n = cache.encode(*string_buffer(pa.array(texts)))
        want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert ids.tolist() == sum(want, []) and n.tolist() == [len(w) for w in want]


def test_patterns_hold_the_histogram():
    rng = np.random.default_rng(3)
    for units, most in ((16, 300), (64, 40), (64, 1)):
        hist = {int(c): int(n) for c, n in zip(range(1, units + 1),
                                               rng.integers(0, most + 1, units)) if n}
        plan = packing.plan_patterns(hist, units)
        used = {}
        for pattern, times in plan:
            assert sum(c * a for c, a in pattern.items()) <= units and times > 0
            for c, a in pattern.items():
                used[c] = used.get(c, 0) + a * times
        assert used == hist
        size = np.array(sorted(hist))
        _, x = packing.solve_patterns(size, np.array([float(hist[c]) for c in size]), units)
        # no fewer than the linear program, and rounding costs less than a sequence a class
        assert x.sum() * 0.99 <= sum(t for _, t in plan) <= x.sum() + len(hist)


def test_column_generation_refreshes_its_basis_in_a_spark_driver(spark):
    rng = np.random.default_rng(5)
    a = rng.random((256, 256)) + np.diag(rng.random(256))
    a[3, 3] = a[0, 0] = 0.0
    assert np.abs(np.einsum("ij,jk->ik", packing.inverse(a), a) - np.eye(256)).max() < 1e-7
    size = np.arange(1, 257)
    count = rng.integers(1, 10**6, 256).astype(float)
    swaps = []
    best = packing.best_pattern

    def counted(*args):
        swaps.append(1)
        return best(*args)

    packing.best_pattern = counted
    try:
        patterns, x = packing.solve_patterns(size, count, 256, gap=1e-5)
        few, y = packing.solve_patterns(size, count, 256, gap=1e-5, refresh=50)
    finally:
        packing.best_pattern = best
    assert len(swaps) >= 400, len(swaps)
    assert np.allclose((patterns * x[:, None]).sum(axis=0), count)
    assert x.sum() >= (size * count).sum() / 256 - 1e-6
    assert np.allclose((few * y[:, None]).sum(axis=0), count)
    assert abs(x.sum() - y.sum()) < 0.02 * x.sum()


def test_packing_is_exact_and_dense(spark, tokenizer):
    rng = random.Random(6)
    docs = [(i, " ".join(rng.choice(["tree", "Haus.", "éé,", "x" * 9])
                         for _ in range(rng.choice([0, 3, 30, 300])))) for i in range(120)]
    docs += [(500, None), (501, ""), docs[0]]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    out = packing.pack(df, tokenizer_json(), capacity=256, grain=4, digest=F.crc32("ids"))
    rows = out.placement.collect()
    ids = {d: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
           for d, t in docs}
    seqs, starts = {}, {}
    for r in rows:
        piece = ids[r.doc_id][r.start:r.start + r.length]
        assert r.doc_tokens == len(ids[r.doc_id]) and r.digest == zlib.crc32(piece.tobytes())
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length, piece))
        starts.setdefault(r.doc_id, []).append((r.start, r.length))
    for d, v in ids.items():
        copies = sum(x == d for x, _ in docs)
        assert sum(n for _, n in starts[d]) == copies * len(v)
    for parts in seqs.values():
        at = 0
        for offset, length, _ in sorted(parts, key=lambda p: p[0]):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(len(ids[d]) for d, _ in docs)
    assert len(seqs) * 256 < 1.06 * total + 256
    packed = {r.sequence_id: bytes(r.ids) for r in out.sequences().collect()}
    assert packed == {s: b"".join(p.tobytes() for _, _, p in sorted(v, key=lambda p: p[0]))
                      for s, v in seqs.items()}


def test_edge_rows(spark, edge_docs, no_docs):
    out = packing.pack(edge_docs, tokenizer_json())
    assert out.placement.select("doc_id").distinct().count() == 9
    assert packing.pack(no_docs, tokenizer_json()).placement.count() == 0
