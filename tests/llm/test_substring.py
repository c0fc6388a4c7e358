"""Operator 3 against brute force; the suffix automaton on random strings."""

import collections
import random

import pytest

from visitlens.llm.automaton import SuffixAutomaton
from visitlens.llm.substring import remove_repeats
from edge_rows import edge_docs, no_docs  # noqa: F401


def brute(docs, win):
    count = collections.Counter()
    for _, t in docs:
        w = (t or "").split()
        count.update(tuple(w[i:i + win]) for i in range(len(w) - win + 1))
    out = []
    for d, t in docs:
        w = (t or "").split()
        gone = set()
        for i in range(len(w) - win + 1):
            if count[tuple(w[i:i + win])] > 1:
                gone |= set(range(i, i + win))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out)


def test_matching_statistics():
    rng = random.Random(1)
    for _ in range(30):
        seqs = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 12))) for _ in range(4)]
        auto = SuffixAutomaton()
        for s in seqs:
            auto.add(s)
        auto.finish()

        def places(x):
            return sum(s.startswith(x, i) for s in seqs for i in range(len(s)))  # noqa: B023
        for s in seqs:
            want = [max(n for n in range(e + 1) if n == 0 or places(s[e - n:e]) >= 2)
                    for e in range(1, len(s) + 1)]
            assert auto.matching(s) == want


@pytest.mark.parametrize("win,cap", [(8, 3), (8, 4000), (35, 2), (35, 4000)])
def test_removed_words_match_brute_force(spark, win, cap):
    rng = random.Random(win * cap)
    vocab = [f"w{i}" for i in range(6)]
    base = [rng.choice(vocab) for _ in range(120)]
    docs = []
    for d in range(50):
        t = []
        for _ in range(rng.randint(0, 4)):
            if rng.random() < .6:
                a = rng.randint(0, 110)
                t += base[a:a + rng.randint(3, 60)]
            else:
                t += [rng.choice(vocab + [f"u{rng.randint(0, 10**6)}"])
                      for _ in range(rng.randint(1, 40))]
        docs.append((d, " ".join(t) if rng.random() > .05 else None))
    docs += docs[:3]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept)
                 for r in remove_repeats(df, window=win, shard_contexts=cap).collect())
    assert got == brute(docs, win)


def test_a_common_anchor_is_dealt_anew_by_longer_ones(spark):
    """600 different contexts of one anchor, some with a window in common."""
    rng = random.Random(9)
    hot = [f"h{i}" for i in range(6)]
    tails = [[f"t{k}w{i}" for i in range(40)] for k in range(5)]
    docs = []
    for d in range(600):
        before = [f"u{rng.randint(0, 10**9)}" for _ in range(rng.randint(0, 40))]
        after = tails[d % 5][:rng.randint(0, 40)] if d % 3 == 0 else \
            [f"v{rng.randint(0, 10**9)}" for _ in range(40)]
        docs.append((d, " ".join(before + hot + after)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    for cap in (5, 60):
        got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept)
                     for r in remove_repeats(df, shard_contexts=cap).collect())
        assert got == brute(docs, 35) and sum(r[2] for r in got) > 1000


def test_layout_and_edge_rows(spark, edge_docs, no_docs):
    docs = spark.createDataFrame([(1, "a b\n c  d e"), (2, "x b\n c y")], "doc_id long, text string")
    got = {r.doc_id: r.kept for r in remove_repeats(docs, window=2, keep_layout=True).collect()}
    assert got == {1: "a  d e", 2: "x y"}
    rows = {(r.doc_id, r.n_words): r.n_removed for r in remove_repeats(edge_docs, 5).collect()}
    assert rows[(1, 13)] == 13 and rows[(5, 30_000)] == 30_000 and rows[(2, 0)] == 0
    assert remove_repeats(no_docs).count() == 0
