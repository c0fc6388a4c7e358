"""The five stages against plain versions on a small corpus, and their table contract."""

import random

from pyspark.sql import functions as F

import corpus_pipeline as P
from edge_rows import edge_docs, no_docs  # noqa: F401
from test_decontaminate import brute as brute_hits
from test_ngram_join import brute as brute_components
from test_substring import brute as brute_repeats

COLS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(12)
    en = "the house street old town river stone and of by with under".split()
    de = "das haus straße alte stadt fluss stein und von bei mit unter".split()
    bench = [(i, " ".join(rng.choice(en) + str(rng.randint(0, 99)) for _ in range(14)))
             for i in range(4)]
    passage = " ".join(rng.choice(en) for _ in range(45))
    docs = []
    for i in range(60):
        words = [rng.choice(en if i % 3 else de) for _ in range(rng.randint(5, 120))]
        if i % 7 == 0:
            words[3:3] = passage.split()
        if i % 11 == 0:
            words[5:5] = bench[i % 4][1].split()
        docs.append((i, " ".join(words), "en" if i % 3 else "de", "s", 0))
    docs += [(100 + i, docs[i][1], docs[i][2], "copy", 1) for i in range(6)]
    near = docs[12][1].split()
    docs += [(200, " ".join(near + ["extra"]), "de", "near", 1), (201, "12 34", "en", None, None),
             (202, None, "en", "s", 0), (203, "", None, None, None), docs[1],
             (None, docs[2][1] + " more words here", "en", "s", 0)]
    return docs, bench


def test_stages_match_plain_versions(spark, tmp_path):
    docs, bench = corpus()
    spark.createDataFrame(docs, COLS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id int, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    out = {}
    for name, stage in P.STAGES:
        stage(spark, now, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        out[name] = now.collect()
        if name != P.STAGES[-1][0]:
            assert now.columns == P.COLUMNS
            assert all(r.n_chars == len(r.text or "") or name in ("language_id", "ngram_jaccard")
                       for r in out[name])
    pair = lambda rows: sorted(((r.doc_id, r.text) for r in rows), key=repr)
    # 1: only texts without a letter go
    kept = [(d, t) for d, t, *_ in docs if d not in (201, 202, 203)]
    assert pair(out["language_id"]) == sorted(kept, key=repr)
    # 2: one row of each component, that of the smallest id
    assert pair(out["ngram_jaccard"]) == sorted(_first_of_each(kept), key=repr)
    # 3: repeated passages
    two = [(r.doc_id, r.text) for r in out["ngram_jaccard"]]
    plain = {(d, len(t.split())): k for (d, t), k in
             zip(two, [x[3] for x in _in_order(two)])}
    for r, (d, t) in zip(sorted(out["substring_dedup"], key=_key), sorted(two, key=_key2)):
        assert " ".join((r.text or "").split()) == plain[d, len(t.split())]
    # 4: benchmark phrases are gone, texts without any are untouched
    three = {r.doc_id: r.text for r in out["substring_dedup"]}
    hits = {d: n for d, _, n, _ in brute_hits(list(three.items()), bench)}
    four = {r.doc_id: r.text for r in out["decontamination"]}
    assert four.keys() == three.keys() and any(hits.values())
    for d, t in four.items():
        assert (t == three[d]) == (hits[d] == 0)
    assert not any(n for _, _, n, _ in brute_hits(list(four.items()), bench))
    # 5: every document packed whole
    assert {r.doc_id for r in out["packing"]} == set(four)


def _first_of_each(rows):
    """Distinct (id, text) rows that are the first of their component, null ids last."""
    rows = sorted(set(rows), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    first = {i: c for i, _, c, _ in brute_components([(i, t) for i, (_, t) in enumerate(rows)])}
    return [x for i, x in enumerate(rows) if first[i] == i]


def test_rows_are_told_apart_by_id_and_text(spark):
    """One id on two texts loses neither; copies without id are reduced to one."""
    rng = random.Random(3)
    text = lambda: " ".join(f"w{rng.randint(0, 500)}" for _ in range(60))
    a, b, c, d, e = (text() for _ in range(5))
    rows = [(1, a), (2, b), (2, c), (3, b + " end"), (5, c), (7, d), (7, d), (7, d + " end"),
            (None, e), (None, e + " end"), (None, e), (None, a + " end"), (None, "alone"),
            (8, None), (9, "")]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], COLS).repartition(4)
    got = [(r.doc_id, r.text) for r in P.ngram_jaccard(spark, df, "").collect()]
    assert {(1, a), (2, b), (2, c), (None, "alone"), (8, None), (9, "")} <= set(got)
    rest = [x for x in got if x not in {(1, a), (2, b), (2, c), (None, "alone"), (8, None), (9, "")}]
    # of the others' two components one row each: texts of one id, and copies without id
    assert len(rest) == 2 and len(got) == 8
    assert {x[0] for x in rest} == {7, None}
    assert {x[1].removesuffix(" end") for x in rest} == {d, e}


def _key(r):
    return repr(r.doc_id)


def _key2(x):
    return repr(x[0])


def _in_order(docs):
    """Brute-force results in the order of ``docs`` (ids may be null)."""
    by = {i: r for i, r in enumerate(brute_repeats(list(enumerate(t for _, t in docs)), 35))}
    return [by[i] for i in range(len(docs))]


def test_texts_of_several_languages_stay(spark):
    texts = {"en": "the house and the street of the old town", "de": "das haus und die straße",
             "ru": "дом и улица старого города стоят"}
    rows = [(4 * i + k, texts[lang], lang, "s", 0) for i in range(20)
            for k, lang in enumerate(texts)]
    rows += [(900, " . ".join([texts["en"], texts["de"], texts["de"], texts["ru"]]), None, "s", 0),
             (901, "12 34", "en", "s", 0)]
    got = P.language_id(spark, spark.createDataFrame(rows, COLS), "").collect()
    assert {r.doc_id for r in got} == {r[0] for r in rows} - {901}


def test_run_is_the_stages(spark, tmp_path):
    docs, bench = corpus()
    spark.createDataFrame(docs, COLS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id int, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    got = P.run(spark, str(tmp_path))
    assert got.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0
    assert got.count() > 50


def test_edge_tables(spark, edge_docs, no_docs, tmp_path):
    spark.createDataFrame([], "item_id int, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    for table in (edge_docs, no_docs):
        now = table
        for _, stage in P.STAGES:
            now = stage(spark, now, str(tmp_path))
        now.collect()
