"""Learned operators (2, 5, 7, 8, 10): their parts against plain versions, accuracy, edge rows."""

import math
import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from visitlens.llm import language, pitman_yor, quality, toxicity, urls
from visitlens.llm import queries as Q
from visitlens.session import scratch_dir
from edge_rows import edge_docs, no_docs  # noqa: F401

SF_MID = "/root/testdata/sf0.01"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# -- language ------------------------------------------------------------------

@pytest.mark.parametrize("states,penalty", [(2, 1.0), (4, 3.0)])
def test_chunked_viterbi_is_the_plain_recursion(states, penalty):
    rng = np.random.default_rng(states)
    size = np.array([0, 1, 31, 32, 33, 200, 0, 5])
    score = rng.normal(size=(size.sum(), states)).astype(np.float32)
    start = np.cumsum(size) - size
    got = language.viterbi(score, start, size, penalty)

    def value(path, s):
        return sum(s[i, p] for i, p in enumerate(path)) - penalty * sum(
            a != b for a, b in zip(path, path[1:]))
    for a, n in zip(start, size):
        s = score[a:a + n]
        best = np.zeros(states)
        for row in s:
            best = np.maximum(best, best.max() - penalty) + row
        if n:
            assert value(got[a:a + n].tolist(), s) == pytest.approx(best.max(), abs=1e-3)


def test_language_spans_scripts_and_edges(spark, edge_docs, no_docs):
    rows = [("the house and the street of the old town", "en"),
            ("das haus und die straße der alten stadt", "de"),
            ("дом и улица старого города стоят", "ru")] * 4
    model = language.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert model.langs == ["de", "en", "ru"]
    texts = [(1, "the street of the town. das haus und die stadt der straße. the old house"),
             (2, "улица старого дома"), (3, "123 !?"), (4, None), (5, "")]
    got = {r.doc_id: r for r in language.identify(
        spark.createDataFrame(texts, "doc_id long, text string"), model, penalty=3.0).collect()}
    assert [s.lang for s in got[1].spans] == ["en", "de", "en"] and got[1].lang_pred == "en"
    assert got[2].lang_pred == "ru" and got[2].score == 1.0
    assert [(got[i].lang_pred, got[i].score, got[i].spans) for i in (3, 4, 5)] == [("und", 0, [])] * 3
    found = language.identify(edge_docs, model)
    assert found.count() == edge_docs.count() and found.where("lang_pred = 'und'").count() == 5
    empty = language.fit(no_docs)
    assert {r.lang_pred for r in language.identify(edge_docs, empty).collect()} == {"und"}
    assert language.identify(no_docs, model).count() == 0


def test_language_share_counts_letters_not_bytes(spark):
    """Cyrillic letters have two bytes each: by bytes the Russian part would win."""
    rows = [("the house and the street of the old town", "en"),
            ("дом и улица старого города стоят", "ru")] * 4
    model = language.fit(spark.createDataFrame(rows, "text string, lang string"))
    en, ru = "the house and the street of the old town", "дом и улица старого города"
    letters = [sum(c.isalpha() for c in t) for t in (en, ru)]
    assert len(ru.replace(" ", "").encode()) > letters[0] > letters[1]
    got = language.identify(spark.createDataFrame([(1, f"{en} {ru}")], "doc_id long, text string"),
                            model, penalty=3.0).first()
    assert got.lang_pred == "en" and [s.lang for s in got.spans] == ["en", "ru"]
    assert got.score == pytest.approx(letters[0] / sum(letters))


def test_language_held_out_accuracy(spark):
    got = Q.op2_language(spark, SF_MID).join(
        spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "lang"), "doc_id") \
        .where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert got > 0.98


# -- quality rules -----------------------------------------------------------------

def plain_stats(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    three = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    hit = {j for i, x in enumerate(three) if three.count(x) > 1 for j in (i, i + 1, i + 2)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit), len(seen)
            + dup, len(set(w)))


def test_text_statistics(spark, edge_docs, no_docs):
    rng = random.Random(2)
    texts = [None, "", "\n\n", "a", "a b c a b c", "x\nx\n x\nx\n", "é ß|<>\r\n", "a a a a a"]
    texts += ["".join(rng.choice(["a ", "b ", "é ", "#", "\n", "the cat sat ", "\t"])
                      for _ in range(rng.randint(0, 60))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                          "n_repeat_words", "n_lines", "n_distinct"))
           for r in quality.text_stats(df).collect()}
    assert got == {i: plain_stats(t) for i, t in enumerate(texts)}
    assert quality.text_stats(edge_docs).count() == edge_docs.count()
    assert quality.text_stats(no_docs).count() == 0


def test_decision_list_finds_thresholds(spark, no_docs):
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    bad = (x[:, 0] > 0.8) | ((x[:, 1] <= 0.2) & (x[:, 2] > 0.5))
    rules = quality.learn_list(x, bad, ["n_words", "mean_word", "symbol_ratio"])
    index = {"n_words": 0, "mean_word": 1, "symbol_ratio": 2}
    got = np.zeros(len(x), bool)
    for r in rules.rules:
        got |= quality._covers(x, r, index)
    assert (got == bad).mean() > 0.97 and 2 <= len(rules.rules) <= 6
    assert "drop if" in str(rules)
    none = quality.fit(no_docs.withColumn("quality", F.lit(None).cast("int")))
    assert none.rules == []
    judged = quality.judge(quality.text_stats(no_docs), rules)
    assert judged.count() == 0 and {"base_failed", "rule", "kept"} <= set(judged.columns)


def test_quality_rules_on_held_out_texts(spark):
    """Labelled texts of sf0.1 that the list was not learned from."""
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").join(
        spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality"), "doc_id")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    rules = quality.fit(docs.where(~held), row_key=F.xxhash64("doc_id"))
    got = quality.judge(quality.text_stats(docs.where(held)), rules).groupBy("quality").agg(
        F.count("*").alias("n"), F.avg(F.col("kept").cast("int")).alias("kept"))
    by = {r.quality: r for r in got.collect()}
    assert by[0].n > 100 and by[0].kept < 0.1 and by[1].kept > 0.9


# -- urls ----------------------------------------------------------------------------

def plain_parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(LOW), re.match(r"[^?#]*", rest[len(host):])[0]


def test_url_rules(spark):
    list_ = [None, "", "no scheme", "http://A.ORG", "http://A.ORG/", "https://x.example.org/es/1",
             "http://example.org/en/1?x", "http://notexample.org/en/1", "http://b.com/fr/a#c",
             "http://b.com/de/a", "ftp://com/de/", "http://b.com?/de/", "http://é.com/fr/\nx",
             "a://b://c.org/x", "http://example.org/en/2"]
    rules = Q.url_rules()
    df = spark.createDataFrame(list(enumerate(list_)), "page_id long, url string")
    for r in urls.with_rules(urls.parsed(df), rules).collect():
        host, path = plain_parse(r.url)
        fits = [x for x in rules if (host == x.host or host.endswith("." + x.host))
                and path.startswith(x.path)]
        best = max(fits, key=lambda x: len(x.text), default=None)
        assert (r.host, r.path, r.rule, r.rule_verdict) == (
            host, path, best and best.text, best and best.verdict), r


def test_url_trees_learn_and_edge_tables(spark):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        bad = i % 2
        rows.append((i, f"http://{'win-' if bad else 'blog.'}h{rng.randint(0, 50)}.net/"
                        f"{'x' * rng.randint(20, 40) if bad else 'a'}?p={i}", bad))
    df = urls.lexical(urls.parsed(spark.createDataFrame(rows, "n long, url string, label int")))
    got = urls.fit(df, trees=5).predict(df)
    assert got.where("blocked = label").count() > 380
    text = "http://aab.net/é?a=1&b=2#c"
    one = urls.lexical(urls.parsed(spark.createDataFrame([(text,)], "url string"))).first()
    p = [text.count(c) / len(text) for c in set(text)]
    assert one.f_entropy == pytest.approx(-sum(x * math.log2(x) for x in p))
    assert (one.f_params, one.f_depth, one.f_fragment) == (2, 1, 1)
    nulls = df.withColumn("label", F.lit(None).cast("int"))
    assert urls.fit(nulls).predict(df).where("blocked = 0").count() == 400
    assert urls.fit(df.limit(0)).predict(df.limit(0)).count() == 0
    one_class = df.withColumn("label", F.lit(1))
    assert urls.fit(one_class).predict(df).where("blocked = 1").count() == 400


def test_url_trees_cannot_read_the_label_off_the_rates(spark):
    rng = random.Random(6)
    rows = []
    for i in range(900):
        host, bad = ("a.com", i % 2) if i % 3 else ("x.org", int(i % 9 == 0))
        long = bad != (rng.random() < 0.1)      # one path in ten misleads
        rows.append((i, f"http://{host}/{'q' * 9 + '/z/' if long else 'q'}{rng.randint(1, 9999)}",
                     bad))
    df = urls.lexical(urls.parsed(spark.createDataFrame(rows, "n long, url string, label int")))
    held = F.pmod(F.crc32("url"), F.lit(4)) == 0
    model = urls.fit(df.where(~held), trees=10)
    got = model.predict(df.where(held))
    assert got.where("blocked = label").count() > 0.8 * got.count()
    rates = model.with_rates(df.where(~held).withColumn("fold", F.pmod(F.crc32("url"), F.lit(5))
                                                        .cast("int")), "fold")
    assert rates.groupBy("s1", "fold").agg(F.countDistinct("f_rate1").alias("n")) \
        .where("n > 1").count() == 0


def test_url_trees_beat_the_majority_on_held_out_urls(spark):
    """Labelled URLs of sf0.1 that neither the rates nor the trees were learned from."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    ruled = urls.lexical(urls.with_rules(urls.parsed(pages), Q.url_rules())).where(
        "rule_verdict is not null").withColumn("label", (F.col("rule_verdict") == "block")
                                               .cast("int"))
    held = F.pmod(F.crc32("url"), F.lit(4)) == 0
    got = urls.fit(ruled.where(~held)).predict(ruled.where(held)).agg(
        F.count("*").alias("n"), F.avg((F.col("blocked") == F.col("label")).cast("int"))
        .alias("right"), F.avg(F.lit(1) - F.col("label")).alias("allowed")).first()
    assert got.n > 150 and got.right > max(got.allowed, 1 - got.allowed) + 0.1


def test_url_edge_rows(spark):
    """Repeated rows, clashing names, very long and odd URLs."""
    rng = random.Random(8)
    rows = [(i, f"http://h{i % 9}.com/{'de' if i % 2 else 'fr'}/{rng.randint(0, 99)}", i % 2)
            for i in range(200)]
    rows += rows[:3] + [(900, "http://x.com/" + "ab1%" * 50_000, None), (901, None, None),
                        (902, "no scheme", None), (903, "://", None), (904, "http://a..b/", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, label int")
    for name in ("blocked", "_x", "_fold", "_n", "_bad", "k", "n", "rate", "_y", "s1"):
        df = df.withColumn(name, F.lit("x"))
    ready = urls.lexical(urls.parsed(df))
    got = urls.fit(ready, trees=5).predict(ready).collect()
    assert len(got) == len(rows) and {r.blocked for r in got} <= {0.0, 1.0}
    by_id = {}
    for r in got:
        by_id.setdefault(r.page_id, set()).add(r.blocked)
        if r.page_id < 200:
            assert r.blocked == r.label
    assert all(len(v) == 1 for v in by_id.values())


# -- toxicity ----------------------------------------------------------------------------

def test_noisy_or_finds_the_offending_sentences(spark, edge_docs, no_docs):
    rng = random.Random(5)
    clean = ["sun", "tree", "house", "river", "stone", "cloud", "field", "road"]
    rows = []
    for i in range(300):
        lines = [" ".join(rng.choice(clean) for _ in range(6)) for _ in range(5)]
        if i % 3 == 0:
            lines[rng.randrange(5)] += " " + rng.choice(["vile", "scumbag"])
        rows.append((i, ". ".join(lines), int(i % 3 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(4)
    model = toxicity.fit(df)
    again = toxicity.fit(df.repartition(7))
    assert np.array_equal(model.keys, again.keys) and np.allclose(model.weights, again.weights)
    got = toxicity.score(df, model).collect()
    assert sum((r.score >= 0.5) == r.toxic for r in got) > 295
    for r in got:
        for o in r.offenders:
            assert "vile" in o.sentence or "scumbag" in o.sentence
    out = toxicity.score(edge_docs, model)
    assert out.count() == edge_docs.count()
    assert out.where("score is null or score < 0 or score > 1").count() == 0
    nothing = toxicity.fit(no_docs.withColumn("toxic", F.lit(None).cast("int")))
    assert toxicity.score(edge_docs, nothing).where("score > 0.5").count() == 0
    assert toxicity.score(no_docs, model).count() == 0


# -- language model ---------------------------------------------------------------------------

def _plain_noisy_or(model, text):
    """1 - prod(1 - p) over the sentences with words, and their p, one word at a time."""
    weight = dict(zip(model.keys.tolist(), model.weights.tolist()))
    hasher = toxicity.Sentences().hash
    logistic = lambda z: 1 / (1 + math.exp(-min(max(z, -30), 30)))
    scores = []
    for sentence in re.split(rb"[\n\r!.?]", (text or "").translate(LOW).encode()):
        words = set(re.findall(rb"[0-9a-z\x80-\xff]+", sentence))
        if words:
            hashes = [int(hasher(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0])
                      for w in words]
            scores.append(logistic(model.bias + sum(weight.get(h, 0.0) for h in hashes)))
    if not scores:
        return logistic(model.bias), []
    return 1 - math.prod(1 - min(p, 1 - 1e-12) for p in scores), scores


def test_toxicity_scores_equal_a_plain_noisy_or(spark, edge_docs):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    model = toxicity.fit(docs.join(labels, "doc_id").select("text", "toxic"))
    assert len(model.keys) > 20
    rows = toxicity.score(docs.unionByName(edge_docs.select("doc_id", "text")), model).collect()
    some = 0
    for r in sorted(rows, key=lambda r: -r.score)[:60] + rows[:200] + rows[-11:]:
        want, parts = _plain_noisy_or(model, r.text)
        assert r.score == pytest.approx(want, abs=1e-9)
        assert [o.score for o in r.offenders] == pytest.approx([p for p in parts if p >= 0.5])
        some += len(r.offenders)
    assert some > 5


def test_toxicity_sample_is_bounded_in_bytes(spark):
    rows = [(i, ("bad " if i % 2 else "good ") * 50, i % 2) for i in range(400)] + [
        (1000, "huge " * 100_000, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    few = toxicity.fit(df, sample_bytes=20_000, min_docs=2, row_key=F.xxhash64("doc_id"))
    huge = int(toxicity.Sentences().hash(np.frombuffer(b"huge", np.uint8), np.array([0]),
                                         np.array([4]))[0])
    assert len(few.keys) and huge not in few.keys.tolist()
    found = {r.doc_id: r.score for r in toxicity.score(df, few).collect()}
    assert found[1] > 0.5 > found[0]


def test_stirling_table_and_gibbs_steps():
    d = 0.5
    alone = pitman_yor.alone_table(d, 8)
    s = {(0, 0): 1.0}
    for c in range(1, 9):
        for t in range(1, c + 1):
            s[c, t] = s.get((c - 1, t - 1), 0) + (c - 1 - d * t) * s.get((c - 1, t), 0)
            assert alone[c, t] == pytest.approx(s.get((c - 1, t - 1), 0) / s[c, t])
    rng = np.random.default_rng(0)
    c = np.array([1, 2, 7, 200, 5000])
    t = np.ones(5, np.int64)
    full = pitman_yor.alone_table(d)
    for _ in range(200):
        t = pitman_yor.gibbs_step(c, t, np.full(5, 2.0), d, full, rng.random(5), rng.random(5))
        assert (t >= 1).all() and (t <= c).all() and t[0] == 1


def test_spelling_model_sums_to_one():
    rng = np.random.default_rng(1)
    words = [bytes(rng.choice(list(b"abcd"), rng.integers(0, 6)).tolist()) for _ in range(500)]
    ends = np.cumsum([len(w) for w in words])
    starts = ends - np.array([len(w) for w in words])
    data = np.frombuffer(b"".join(words), np.uint8)
    sym, _, _, three, _ = pitman_yor.byte_contexts(data, starts, ends)
    key, n = np.unique(three * pitman_yor.BYTES + sym, return_counts=True)
    model = pitman_yor.spelling_model(key // pitman_yor.BYTES, key % pitman_yor.BYTES, n)
    assert np.allclose((10.0 ** model.table).sum(1), 1, atol=1e-3)
    seen = model.log10(data, starts, ends).mean()
    odd = model.log10(np.frombuffer(b"zzzz", np.uint8), np.array([0]), np.array([4]))[0]
    assert odd < seen - 3


@pytest.mark.parametrize("shared,block", [(1 << 17, 16 << 20), (0, 40), (5, 200)])
def test_scores_of_small_texts(spark, shared, block):
    rng = random.Random(7)
    vocab = [f"w{i}" for i in range(30)] + ["É", "x" * 50]
    docs = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 12))), i % 3 != 0)
            for i in range(60)] + [(60, None, True), (61, "", False), (62, "new words", False),
                                   (None, "W1 w2", None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, train boolean").repartition(3)
    got = {r.doc_id: r for r in pitman_yor.score_texts(df, shared, block).collect()}
    words = {d: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW)) + [""]
             for d, t, _ in docs}
    count = {}
    for d, _, train in docs:
        for w in words[d] if train else ():
            count[w] = count.get(w, 0) + 1
    n, v = sum(count.values()), len(count)
    assert len(got) == len(docs)
    for d, _, _ in docs:
        r = got[d]
        base = sum(math.log10((count.get(w, 0) + 1) / (n + v + 1)) for w in words[d])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (
            len(words[d]), sum(w in count for w in words[d]), n)
        assert r.base_score == pytest.approx(base) and r.score <= 0


def test_language_model_beats_the_base_on_held_out(spark):
    got = Q.op10_pitman_yor(spark, SF_MID).where("held_out").agg(
        F.sum("base_score"), F.sum("score")).first()
    assert got[1] > got[0]


def test_language_model_edge_rows(spark, edge_docs, no_docs):
    out = pitman_yor.score_texts(edge_docs.withColumn("train", F.col("doc_id") < 5))
    assert out.count() == edge_docs.count() and out.where("score is null").count() == 0
    untrained = pitman_yor.score_texts(edge_docs.withColumn("train", F.lit(False)))
    assert untrained.where("base_score <> 0 or train_tokens <> 0").count() == 0
    assert pitman_yor.score_texts(no_docs.withColumn("train", F.lit(True))).count() == 0


def test_language_model_uses_word_order_and_spelling(spark):
    rng = random.Random(3)
    pairs = [("red", "house"), ("old", "stone"), ("long", "river"), ("green", "tree")]
    docs = [(i, " ".join(" ".join(rng.choice(pairs)) for _ in range(8)), True) for i in range(80)]
    docs += [(100, "red house old stone", False), (101, "house red stone old", False),
             (102, "red greener", False), (103, "red zq\u00e9x#7w", False)]
    df = spark.createDataFrame(docs, "doc_id long, text string, train boolean").repartition(3)
    for shared in (1 << 17, 0):
        got = {r.doc_id: r for r in pitman_yor.score_texts(df, shared).collect()}
        assert got[100].score > got[101].score + 2
        assert got[102].n_known == got[103].n_known == 2
        assert got[102].score > got[103].score + 1
        assert got[102].event_score == pytest.approx(got[103].event_score)


def test_word_probabilities_sum_to_one_in_every_context(spark):
    rng = random.Random(8)
    vocab = [f"w{int(rng.expovariate(0.1))}" for _ in range(60)]
    docs = [(i, " ".join(rng.choice(vocab) for _ in range(30)), True) for i in range(50)]
    df = spark.createDataFrame(docs, "doc_id long, text string, train boolean").repartition(3)
    facts, _, seats, d, model, tokens, types = pitman_yor.learned(df, 500, 5)
    words = {r.h: r for r in facts.collect()}
    left, count = {h: 0.0 for h in words}, {h: 0 for h in words}
    for r in seats.collect():
        assert 1 <= r["last"] <= r.c
        left[r.u] += r.c - d * r["mean"]
        count[r.u] += r.c
    assert types == len(words) and tokens == sum(count.values()) == 50 * 31
    known = sum(10.0 ** r.lp for r in words.values())
    rest = 10.0 ** model.new_mass * (1 - sum(r.spelt for r in words.values()))
    assert known + rest == pytest.approx(1, abs=0.02)
    for h, r in words.items():
        assert count[h] == r.c
        assert left[h] / (pitman_yor.THETA + r.c) + r.open == pytest.approx(1)


def test_packed_keys_and_ranges():
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(0, 2 ** 64 - 1, 1000, dtype=np.uint64))
    got = pitman_yor.unpacked_keys(pitman_yor.packed_keys(keys), len(keys))
    assert got.dtype == np.uint64 and (got == keys).all()
    for x in (rng.integers(-5, 5, 7), rng.normal(size=3), np.array([2 ** 40]),
              np.arange(9, dtype="i4")):
        assert (pitman_yor.unpacked(pitman_yor.packed(x), x.dtype, len(x)) == x).all()
    for parts in (1, 7, 5000):
        ranges = list(pitman_yor.key_ranges(keys, parts))
        assert [a for _, a, _ in ranges] == [0, *(b for _, _, b in ranges[:-1])]
        assert ranges[-1][2] == len(keys)
        assert all(int(k) * parts >> 64 == p for p, a, b in ranges for k in keys[a:b])
    assert list(pitman_yor.key_ranges(keys[:0], 3)) == []


def test_pair_counts_are_the_plain_ones(spark):
    rng = random.Random(9)
    docs = [(i, " ".join(f"w{int(rng.expovariate(0.2))}" for _ in range(rng.randint(0, 20))),
             i % 4 != 0) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string, train boolean").repartition(3)
    hasher, want = pitman_yor.Words(), {}

    def hashed(w):
        data = np.frombuffer(w.encode() + b" ", np.uint8)
        h = hasher.hash(data, np.array([0]), np.array([len(data) - 1]))
        return int(h.view(np.int64)[0])
    for _, text, train in docs:
        words = [hashed(w) for w in ["", *text.split(), ""]]
        for pair in zip(words, words[1:]) if train else ():
            want[pair] = want.get(pair, 0) + 1
    for block in (200, 16 << 20):
        seats = pitman_yor.learned(df, block, 5)[2].collect()
        assert len(seats) == len(want) and {(r.u, r.v): r.c for r in seats} == want


def test_language_model_steps_leave_little_on_disk(spark):
    rng = random.Random(10)
    docs = [(i, " ".join(f"w{int(rng.paretovariate(0.5)) % 50_000}" for _ in range(300)),
             i % 7 != 0) for i in range(1500)]
    df = spark.createDataFrame(docs, "doc_id long, text string, train boolean").repartition(2)
    probe = scratch_dir(spark, "probe").replace("file:", "", 1)
    base, before = os.path.dirname(probe), set(os.listdir(os.path.dirname(probe)))
    out = pitman_yor.score_texts(df)
    assert out.count() == len(docs)
    left = sum(os.path.getsize(os.path.join(d, f)) for x in set(os.listdir(base)) - before
               for d, _, files in os.walk(os.path.join(base, x)) for f in files)
    print("scratch bytes by text bytes", left / sum(len(t) for _, t, _ in docs))
    assert left < 2 * sum(len(t) for _, t, _ in docs)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_folds_are_by_crc32(spark):
    rows = spark.range(40).select("id", Q.held_fold(F.col("id"), 7).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 7 for r in rows)


def test_language_steps_hold_little_beside_the_text(spark, monkeypatch):
    """A pass over a batch of long texts takes memory by parts of it, not by the batch."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa
    from visitlens.llm import language
    rng = np.random.default_rng(3)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    words = ["".join(rng.choice(letters, 6)) for _ in range(4000)]
    texts = [" ".join(rng.choice(words, 3000)) for _ in range(100)]        # 2.1 MB
    docs = spark.createDataFrame([(t, "xy"[i % 2]) for i, t in enumerate(texts[:4])],
                                 "text string, lang string")
    model = language.fit(docs)
    steps = {}
    monkeypatch.setattr(language, "Shared", lambda _, value: type("S", (), {"value": value})())
    monkeypatch.setattr(language, "map_batches",
                        lambda df, fn, schema: steps.setdefault("run", fn))
    language.identify(docs.select("text"), model)
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    tracemalloc.start()
    try:
        got = [x for out in steps["run"](iter([batch])) for x in out.column("lang_pred").to_pylist()]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(got) == 100 and set(got) <= {"x", "y"}
    assert peak < 40 << 20, peak
