"""Quality rules as a learned decision list (operator 5).

Text statistics are counted over whole texts. From labelled statistics,
sequential covering learns an ordered list of rules for the poor class: a
rule grows threshold conditions by information gain on two thirds of the
uncovered rows, is pruned back from its end on the other third, and is kept
while its precision there is high enough. The list is emitted as one Spark
conditional expression, so applying it is a projection.

Learning reads at most about ``sample_docs`` labelled rows, picked by a hash
of the row (a documented bound), as numbers; the list is applied to all rows.

Edge cases: null and empty texts have zero counts (and fail the base rule);
null labels are left out; without both classes the list is empty and drops
nothing; ties between conditions go to the earlier feature and threshold;
repeated rows count alike; an empty table gives no rows; other columns stay.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.llm.frames import map_batches
from visitlens.llm.text import (Rolling, U, WordHasher, byte_table, mix64, row_counts, slices,
                                string_buffer, word_bounds)

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
         "n_upper", "n_digits", "n_marks", "n_distinct"]
SYMBOLS = b"#*$%&|<>"


def _member(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


def text_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with the counts of ``STATS`` (all long)."""
    others = [f for f in docs.schema.fields if f.name != text_col and f.name not in STATS]

    def run(batches):
        table, hasher, lines_of, three = byte_table("space"), WordHasher(31), WordHasher(32), \
            Rolling(33)
        symbol, upper = _member(SYMBOLS), _member(bytes(range(65, 91)))
        digit, mark = _member(bytes(range(48, 58))), _member(b".,;:!?")
        for batch in batches:
            data, offs = string_buffer(batch.column(text_col))
            for a, b in slices(offs):
                part, at = data[offs[a]:offs[b]], offs[a:b + 1] - offs[a]
                n = b - a
                s, e, row = word_bounds(part, at, table)

                def per_row(flags):
                    c = np.concatenate([[0], np.cumsum(flags)])
                    return c[at[1:]] - c[at[:-1]]  # noqa: B023

                def twice(key, keys_row):
                    """Which keys occur more than once in their row, and the distinct number."""
                    both = mix64(key ^ mix64(keys_row.astype(U)))
                    _, inv, cnt = np.unique(both, return_inverse=True, return_counts=True)
                    return cnt[inv] > 1 if len(both) else np.zeros(0, bool)

                def distinct(key, keys_row):
                    pair = np.unique(np.stack([keys_row.astype(U), key], 1), axis=0)
                    return row_counts(pair[:, 0].astype(np.int64), n)  # noqa: B023

                words = hasher(part, s, e)
                first = np.flatnonzero(row[2:] == row[:-2]) if len(s) > 2 else s[:0]
                again = twice(three.ranges(words, first, first + 3), row[first])
                change = np.zeros(len(s) + 1, np.int64)
                np.add.at(change, first[again], 1)
                np.add.at(change, first[again] + 3, -1)
                repeated = np.cumsum(change[:-1]) > 0
                # lines: from a row's start or after a line feed, up to the next one
                feed = np.flatnonzero(part == 10)
                feed_row = np.searchsorted(at, feed, side="right") - 1
                line_row = np.concatenate([np.arange(n), feed_row])
                line_start = np.concatenate([at[:-1], feed + 1])
                order = np.lexsort((line_start, line_row))
                line_row, line_start = line_row[order], line_start[order]
                line_end = np.empty(len(line_start), np.int64)
                line_end[:-1] = np.where(line_row[1:] == line_row[:-1], line_start[1:] - 1,
                                         at[line_row[:-1] + 1])
                line_end[-1:] = at[-1]
                has = np.searchsorted(s, line_end) > np.searchsorted(s, line_start)
                line_hash = lines_of(part, line_start[has], line_end[has])
                line_row = line_row[has]
                n_lines = row_counts(line_row, n)
                out = {
                    "n_words": row_counts(row, n),
                    "word_chars": per_row(table[part] & ((part & 0xC0) != 0x80)),
                    "n_symbols": per_row(symbol[part]),
                    "n_dup_lines": n_lines - distinct(line_hash, line_row),
                    "n_repeat_words": row_counts(row[repeated], n),
                    "n_lines": n_lines, "n_upper": per_row(upper[part]),
                    "n_digits": per_row(digit[part]), "n_marks": per_row(mark[part]),
                    "n_distinct": distinct(words, row)}
                cols = {f.name: batch.column(f.name).slice(a, n) for f in others}
                cols |= {k: pa.array(out[k].astype(np.int64)) for k in STATS}
                yield pa.RecordBatch.from_pydict(cols)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in others] + \
        [f"{c} long" for c in STATS]
    return docs.select(text_col, *(F.col(f"`{f.name}`") for f in others)).transform(map_batches,
        run, ", ".join(fields))


def features() -> dict[str, Column]:
    """The ratios that rules may test, as expressions over the counts."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))
    return {
        "n_words": F.col("n_words").cast("double"),
        "mean_word": F.col("word_chars") / words,
        "symbol_ratio": F.col("n_symbols") / words,
        "dup_line_ratio": F.col("n_dup_lines") / lines,
        "repeat_ratio": F.col("n_repeat_words") / words,
        "words_a_line": F.col("n_words") / lines,
        "upper_ratio": F.col("n_upper") / chars,
        "digit_ratio": F.col("n_digits") / chars,
        "mark_ratio": F.col("n_marks") / words,
        "distinct_ratio": F.col("n_distinct") / words}


@dataclass
class DecisionList:
    """Ordered rules; each is a list of (feature, '<=' or '>', threshold)."""
    rules: list[list[tuple[str, str, float]]]

    def expression(self) -> Column:
        """Number of the first rule that fits, from 1; null if none does."""
        known = features()
        out = F.lit(None).cast("int")
        for i in range(len(self.rules) - 1, -1, -1):
            fits = F.lit(True)
            for name, op, value in self.rules[i]:
                fits = fits & (known[name] <= value if op == "<=" else known[name] > value)
            out = F.when(fits, F.lit(i + 1)).otherwise(out)
        return out

    def __str__(self) -> str:
        return "\n".join(f"{i}: drop if " + " and ".join(f"{n} {o} {v:.6g}" for n, o, v in r)
                         for i, r in enumerate(self.rules, 1))


def _covers(x, rule, index):
    ok = np.ones(len(x), bool)
    for name, op, value in rule:
        col = x[:, index[name]]
        ok &= col <= value if op == "<=" else col > value
    return ok


def learn_list(x: np.ndarray, bad: np.ndarray, names: list[str], precision: float = 0.75,
               max_rules: int = 24, max_conditions: int = 4, min_cover: int = 4,
               cuts: int = 64) -> DecisionList:
    """Sequential covering of the ``bad`` rows (grow, prune, accept, remove)."""
    index = {n: i for i, n in enumerate(names)}
    left = np.arange(len(x))
    rules: list = []
    fold = np.arange(len(x)) % 3
    while len(rules) < max_rules:
        grow, prune = left[fold[left] != 0], left[fold[left] == 0]
        if bad[grow].sum() < min_cover:
            break
        rule: list = []
        inside = grow
        while len(rule) < max_conditions:
            p0, n0 = bad[inside].sum(), (~bad[inside]).sum()
            if n0 == 0:
                break
            best = (0.0, None)
            for f, name in enumerate(names):
                col = x[inside, f]
                values = np.unique(np.quantile(col, np.linspace(0, 1, cuts)))
                order = np.argsort(col, kind="stable")
                at = np.searchsorted(col[order], values, side="right")
                pos = np.concatenate([[0], np.cumsum(bad[inside][order])])
                for op in ("<=", ">"):
                    p = pos[at] if op == "<=" else p0 - pos[at]
                    size = at if op == "<=" else len(inside) - at
                    with np.errstate(divide="ignore", invalid="ignore"):
                        gain = p * (np.log2(p / size) - np.log2(p0 / (p0 + n0)))
                    gain = np.where(p >= min_cover, gain, 0)
                    k = int(np.argmax(gain))
                    if gain[k] > best[0] + 1e-9:
                        best = (float(gain[k]), (name, op, float(values[k])))
            if best[1] is None:
                break
            rule.append(best[1])
            inside = inside[_covers(x[inside], rule[-1:], index)]

        def worth(r):
            hit = prune[_covers(x[prune], r, index)]  # noqa: B023
            p, n = bad[hit].sum(), (~bad[hit]).sum()
            return ((p - n) / (p + n) if p + n else -1.0), p, n

        if not rule:
            break
        scores = [(worth(rule[:k])[0], -k, k) for k in range(1, len(rule) + 1)]
        rule = rule[:max(scores)[2]]
        hit = left[_covers(x[left], rule, index)]
        _, p, n = worth(rule)
        if p + n == 0 or p / (p + n) < precision or bad[hit].mean() < precision:
            break
        rules.append(rule)
        left = np.setdiff1d(left, hit, assume_unique=True)
    return DecisionList(rules)


def fit(labelled: DataFrame, sample_docs: int = 20_000, text_col: str = "text",
        label_col: str = "quality", row_key: Column | None = None) -> DecisionList:
    """Learn from about ``sample_docs`` rows (text, label: 0 is poor)."""
    rows = labelled.where(F.col(label_col).isNotNull())
    total = rows.select(label_col).count()
    key = row_key if row_key is not None else F.xxhash64(text_col)
    if total > sample_docs:
        rows = rows.where(F.pmod(key, F.lit(1 << 20)) < int((1 << 20) * sample_docs / total))
    known = features()
    got = text_stats(rows.select(text_col, key.alias("row"),
                                 F.col(label_col).cast("int").alias("label")), text_col).select(
        "row", "label", *(c.alias(n) for n, c in known.items())).toPandas()
    got = got.sort_values(["row", "label", *known], kind="stable")
    return learn_list(got[list(known)].to_numpy(float), got["label"].to_numpy() == 0, list(known))


def judge(stats: DataFrame, rules: DecisionList) -> DataFrame:
    """``stats`` with base_failed, rule (first rule that fits, else null) and kept."""
    return stats.withColumns({
        "base_failed": (F.col("n_words") < 50) |
                       (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        "rule": rules.expression()}) \
        .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
