"""Operator 1 against brute force; the FM-index on random sequences."""

import random
import re

import numpy as np
import pytest

from visitlens.llm.decontaminate import removal_spans, without_spans
from visitlens.llm.fmindex import FMIndex
from edge_rows import edge_docs, no_docs  # noqa: F401

RULE = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(t):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return re.findall(RULE, (t or "").translate(low))


def brute(docs, bench, width=10):
    out = []
    for d, t in docs:
        w, hit, items = words(t), set(), set()
        for item, b in bench:
            bw = words(b)
            for p in ([bw] if 0 < len(bw) <= width else
                      [bw[i:i + width] for i in range(len(bw) - width + 1)]):
                for i in range(len(w) - len(p) + 1):
                    if p and w[i:i + len(p)] == p:
                        hit |= set(range(i, i + len(p)))
                        items |= {str(item)} if item is not None else set()
        out.append((d, len(w), len(hit), sorted(items)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_fm_index_counts_and_locates(seed):
    rng = np.random.default_rng(seed)
    text = rng.integers(0, 5, 400)
    text[0] = 0
    index = FMIndex(text, 5)
    patterns = rng.integers(1, 5, (40, 4))
    size = rng.integers(1, 5, 40)
    for i in range(40):
        patterns[i, :4 - size[i]] = 0
    sp, ep = index.search(patterns, size)
    for i in range(40):
        p = patterns[i, 4 - size[i]:]
        want = [k for k in range(len(text) - len(p) + 1) if (text[k:k + len(p)] == p).all()]
        assert sorted(index.locate(np.arange(sp[i], ep[i])).tolist()) == want


@pytest.mark.parametrize("block", [100_000, 7])
def test_hits_match_brute_force(spark, block):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(12)]
    bench = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([1, 4, 10, 25]))))
             for i in range(1, 9)] + [(9, None), (10, "--"), (None, "null item here"), (2, "w1 w2")]
    docs = []
    for d in range(30):
        t = [rng.choice(vocab + ["other", "X"]) for _ in range(rng.randint(0, 60))]
        if rng.random() < .7:
            at = rng.randint(0, len(t))
            t[at:at] = rng.choice([x for _, x in bench if x]).split()
        docs.append((d, ", ".join(t).upper() if rng.random() < .5 else " ".join(t)))
    docs += [(50, "Null item, HERE and null"), (51, None), (52, ""), docs[0]]
    found = removal_spans(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                          spark.createDataFrame(bench, "item_id int, text string"),
                          block_phrases=block)
    got = sorted(((r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans),
                   sorted(r["items"])) for r in found.collect()), key=repr)
    assert got == brute(docs, bench)


def test_spans_are_cut_out(spark):
    docs = spark.createDataFrame([(1, "Keep this. One two THREE! keep that"), (2, "nothing é"),
                                  (3, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "one two three")], "item_id int, text string")
    got = {r.doc_id: r.text for r in without_spans(removal_spans(docs, bench)).collect()}
    assert got == {1: "Keep this. ! keep that", 2: "nothing é", 3: None}


def test_edge_rows(spark, edge_docs, no_docs):
    bench = spark.createDataFrame([(1, "the cat sat")], "item_id int, text string")
    none = bench.limit(0)
    assert removal_spans(edge_docs, bench).where("size(spans) > 0").count() == 2
    assert removal_spans(edge_docs, none).where("size(spans) > 0").count() == 0
    assert removal_spans(no_docs, bench).count() == 0
