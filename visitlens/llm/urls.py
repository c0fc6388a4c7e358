"""URL filter: host and path rules, and boosted trees on lexical features (operator 7).

The longest rule that fits decides; where none fits, gradient-boosted trees
over the URL's letters do. They are trained from labelled URLs (a 0/1
column; the registered query labels with the rules' own verdicts, the only
labelled URLs among the tables). Features: lengths, path depth, digit ratio,
entropy, parameter counts, and block rates of the host's suffixes of one to three
labels, of the path's first segment, and of that with the host's last label. Rates
are taken over all labelled URLs and kept in ``2^SUFFIX_BITS`` hashed counters a
kind and fold, so their size is fixed. A URL the trees learn from gets the rates of the other
folds of a URL hash, so that its own label is not in its features.

Fitting reads at most about ``sample_urls`` labelled rows, picked by the
URL's hash (a documented bound); rules and trees are applied to all rows.

Edge cases: a null URL or one without ``://`` has an empty host and path and
fits no rule, and the trees judge its (empty) features; labels of one class
give that constant verdict, and without labels all is allowed; among rules of
one length the first in text order wins; repeated rows are judged alike; an
empty table gives no rows; other columns are kept, but for those named like an
output, a feature (``f_...``, ``s1``) or a helper (``_n``, ``_bad``, ``_x``).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.llm.frames import saved

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL_RE = r"(?s)^.*?://([^/?#]*)([^?#]*)"
SUFFIX_BITS = 12
FOLDS = 5
RATES = (1, 2, 3, 4, 5)     # host suffixes of 1 to 3 labels, path segment, segment and last label


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def parsed(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """``urls`` with host (lower case) and path; both empty without ``://``."""
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    return urls.withColumns({
        "host": F.translate(F.regexp_extract(url, URL_RE, 1), UPPER, LOWER),
        "path": F.regexp_extract(url, URL_RE, 2)})


def with_rules(urls: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add rule (text) and rule_verdict of the longest rule that fits host and path."""
    text = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (-len(r.text), r.text), reverse=True):
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & \
            F.col("path").startswith(r.path)
        text = F.when(fits, F.lit(r.text)).otherwise(text)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return urls.withColumns({"rule": text, "rule_verdict": verdict})


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def entropy(text: Column) -> Column:
    """Bits a character, from the text's own character frequencies."""
    chars = F.split(text, "")
    n = F.length(text)
    return F.when(n == 0, F.lit(0.0)).otherwise(F.aggregate(
        F.array_distinct(chars), F.lit(0.0),
        lambda a, c: a - (F.size(F.filter(chars, lambda x: x == c)) / n)
        * F.log2(F.size(F.filter(chars, lambda x: x == c)) / n)))


def lexical(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """Add the feature columns (doubles) and the hashed parts of host and path."""
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    host, path = F.col("host"), F.col("path")
    columns = {
        "f_length": F.length(url), "f_host": F.length(host), "f_path": F.length(path),
        "f_depth": _count(path, "/"), "f_labels": _count(host, r"\."),
        "f_digits": _count(url, "[0-9]") / F.greatest(F.length(url), F.lit(1)),
        "f_hyphens": _count(host, "-"), "f_params": _count(query, "=") + 0,
        "f_query": F.length(query), "f_escapes": _count(url, "%"),
        "f_fragment": F.contains(url, F.lit("#")).cast("int"),
        "f_secure": F.startswith(F.lower(url), F.lit("https://")).cast("int"),
        "f_entropy": entropy(url), "f_host_entropy": entropy(host)}
    labels = F.split(host, r"\.")
    segment = F.regexp_extract(path, "(?s)^/*([^/]*)", 1)
    parts = {k: F.array_join(F.slice(labels, F.greatest(F.size(labels) - k + 1, F.lit(1)), k), ".")
             for k in (1, 2, 3)}
    parts |= {4: segment, 5: F.concat(parts[1], F.lit("/"), segment)}
    suffix = {f"s{k}": F.pmod(F.xxhash64(F.lit(k), v), F.lit(1 << SUFFIX_BITS)).cast("int")
              for k, v in parts.items()}
    return urls.withColumns({k: v.cast("double") for k, v in columns.items()} | suffix)


FEATURES = ["f_length", "f_host", "f_path", "f_depth", "f_labels", "f_digits", "f_hyphens",
            "f_params", "f_query", "f_escapes", "f_fragment", "f_secure", "f_entropy",
            "f_host_entropy", *(f"f_rate{k}" for k in RATES)]


@dataclass
class UrlModel:
    suffixes: DataFrame         # (k, s, fold, n, bad): len(RATES) * FOLDS * 2^SUFFIX_BITS at most
    rate: float
    trees: Any                  # fitted classifier, or None for a constant verdict

    def with_rates(self, urls: DataFrame, fold: str | None = None) -> DataFrame:
        """Add smoothed block rates per part; ``fold`` names a column of the row's
        own fold, to leave out."""
        urls = urls.drop("_n", "_bad", "_own_n", "_own_bad")
        total = self.suffixes.groupBy("k", "s").agg(F.sum("n").alias("_n"),
                                                    F.sum("bad").alias("_bad"))
        for k in RATES:
            urls = urls.join(F.broadcast(total.where(F.col("k") == k).select(
                F.col("s").alias(f"s{k}"), "_n", "_bad")), f"s{k}", "left")
            n, bad = F.coalesce("_n", F.lit(0)), F.coalesce("_bad", F.lit(0))
            if fold is not None:
                urls = urls.join(F.broadcast(self.suffixes.where(F.col("k") == k).select(
                    F.col("s").alias(f"s{k}"), F.col("fold").alias(fold),
                    F.col("n").alias("_own_n"), F.col("bad").alias("_own_bad"))),
                    [f"s{k}", fold], "left")
                n = n - F.coalesce("_own_n", F.lit(0))
                bad = bad - F.coalesce("_own_bad", F.lit(0))
            urls = urls.withColumn(f"f_rate{k}", ((bad + 10 * self.rate) / (n + 10))
                                   .cast("double")).drop("_n", "_bad", "_own_n", "_own_bad")
        return urls

    def predict(self, urls: DataFrame) -> DataFrame:
        """Add blocked (0/1) to lexical URLs."""
        if self.trees is None:
            return urls.withColumn("blocked", F.lit(1.0 if self.rate >= 0.5 else 0.0))
        from pyspark.ml.feature import VectorAssembler
        urls = urls.drop("rawPrediction", "probability", "blocked", "_blocked", "_x")
        x = VectorAssembler(inputCols=FEATURES, outputCol="_x").transform(self.with_rates(urls))
        return self.trees.transform(x).withColumnRenamed("_blocked", "blocked") \
            .drop("_x", "rawPrediction", "probability")


def fit(labelled: DataFrame, sample_urls: int = 50_000, trees: int = 20, depth: int = 4,
        label_col: str = "label", url_col: str = "url") -> UrlModel:
    """Boosted trees from lexical URLs with a 0/1 label (1: block)."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    rows = labelled.where(F.col(label_col).isNotNull()).withColumn("_fold", F.pmod(F.xxhash64(
        F.lit("fold"), F.coalesce(F.col(url_col).cast("string"), F.lit(""))),
        F.lit(FOLDS)).cast("int"))
    suffix = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.col(f"s{k}").alias("s"))
                                 for k in RATES)))
    stats = saved(rows.select(suffix.alias("x"), "_fold", label_col).groupBy(
        "x.k", "x.s", F.col("_fold").alias("fold")).agg(
        F.count("*").alias("n"), F.sum(label_col).alias("bad")), "suffixes")
    total = stats.where("k = 1").agg(F.sum("n"), F.sum("bad")).first()
    n, bad = total[0] or 0, total[1] or 0
    rate = bad / n if n else 0.0
    model = UrlModel(stats, rate, None)
    if 0 < bad < n:
        if n > sample_urls:
            rows = rows.where(F.pmod(F.xxhash64(url_col), F.lit(1 << 20))
                              < int((1 << 20) * sample_urls / n))
        x = model.with_rates(rows, "_fold").select(
            F.col(label_col).cast("double").alias("_y"), *FEATURES)
        x = VectorAssembler(inputCols=FEATURES, outputCol="_x").transform(saved(x, "urls"))
        model.trees = GBTClassifier(
            labelCol="_y", featuresCol="_x", predictionCol="_blocked", maxIter=trees,
            maxDepth=depth, stepSize=0.2, seed=7).fit(x)
    return model
