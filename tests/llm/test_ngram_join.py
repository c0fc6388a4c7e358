"""Operator 9 against all pairs; connected components."""

import random
import re

from visitlens.llm.frames import components
from visitlens.llm.ngram_join import similar_documents
from edge_rows import edge_docs, no_docs  # noqa: F401

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, n=4):
    sets = []
    for _, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
        sets.append(frozenset([tuple(w[i:i + n]) for i in range(len(w) - n + 1)]
                              or ([tuple(w)] if w else [])))
    root = list(range(len(docs)))
    links = [0] * len(docs)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                a, b = sorted((find(i), find(j)))
                root[b] = a
    ids = {}
    for i, (d, _) in enumerate(docs):
        ids.setdefault(find(i), []).append(d)
    return sorted((d, len(sets[i]), min(ids[find(i)]), links[i]) for i, (d, _) in enumerate(docs))


def near_copies(seed, groups=6, size=14):
    rng = random.Random(seed)
    docs = []
    for _ in range(groups):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([3, 12, 60, 200]))]
        for _ in range(size):
            t = list(base)
            for _ in range(rng.randint(0, max(1, len(t) // 40))):
                t[rng.randrange(len(t))] = f"x{rng.randint(0, 10**6)}"
            docs.append((0, " ".join(t).upper() if rng.random() < .2 else "\t".join(t)))
    docs += [(0, None), (0, ""), (0, " \n"), docs[0], docs[-1]]
    ids = list(range(len(docs)))
    rng.shuffle(ids)
    return [(i, t) for i, (_, t) in zip(ids, docs)]


def test_links_and_components_match_all_pairs(spark):
    for seed, block in ((1, 512), (2, 5)):
        docs = near_copies(seed)
        df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
        got = sorted((r.doc_id, r.n_shingles, r.component_id, r.n_links)
                     for r in similar_documents(df, block=block).collect())
        assert got == brute(docs)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a long, b long"))
           .collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)}


def test_edge_rows(spark, edge_docs, no_docs):
    rows = similar_documents(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    by_id = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in rows
             if r.doc_id is not None}
    assert by_id[1][1:] == (1, 1) and by_id[6][1:] == (5, 1) and by_id[2] == (0, 2, 0)
    assert similar_documents(no_docs).count() == 0
