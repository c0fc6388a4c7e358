"""Fixtures of awkward rows, imported by the tests of this folder."""

import pytest


@pytest.fixture(scope="module")
def edge_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing columns."""
    long_text = " ".join(f"word{i % 977}" for i in range(30_000))
    rows = [(1, "the cat sat on the mat and the dog sat on the rug", "en", None, None),
            (1, "the cat sat on the mat and the dog sat on the rug", "en", None, None),
            (2, None, None, "s", 0), (3, "", "en", "s", 0), (4, " \n\t ", None, None, 4),
            (5, long_text, "en", "s", 9), (6, long_text, None, None, None),
            (None, "der hund und die katze", "de", None, 3), (None, None, None, None, None),
            (7, "12 34 ... !!", "de", "s", 1), (8, "Über die Brücke läuft İstanbul’s Ἀθῆναι", "de", "s", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                     "n_chars long")
    for name in ("n_words", "score", "spans", "items", "kept", "facts", "words", "block",
                 "rule", "n", "bad", "label", "rank", "ids", "_k1", "ranges"):
        df = df.withColumn(name, df["source"])
    return df


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, "
                                     "n_chars long")
