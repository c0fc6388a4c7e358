"""Corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of documents (``COLUMNS``). ``run`` writes each
stage's rows as Parquet under the shared scratch folder and reads them back
as the next stage's documents, so a lost executor costs one stage at most.

Stage rules:

1. language ID: the model learns from the input's own ``lang`` labels; rows
   whose text is null or has no letter (language ``und``) are rejected, texts
   of several languages stay;
2. n-gram Jaccard join: of each component of similar documents one row
   stays, that of the smallest doc_id (of equal ids the one with the smallest
   text key; a row without id only where the whole component has none). Rows
   are told apart by id and text, so two texts of one id are judged each;
   rows without words are alone in their component, but of rows that repeat
   both id and text one stays;
3. substring dedup: repeated 35-word passages are cut out, kept words keep
   the blanks before them;
4. benchmark decontamination: the spans of benchmark phrases are cut out;
5. packing into sequences of 4096 tokens.

Texts that stages 3 and 4 empty stay as empty documents. ``n_chars`` follows
the text. Tables with more columns than ``COLUMNS`` lose the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm import decontaminate, language, ngram_join, packing, substring
from visitlens.llm.frames import read_table, saved, small_batches
from visitlens.llm.queries import learned_language_model, tokenizer_json

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _columns(docs: DataFrame) -> DataFrame:
    """The columns of documents, with the number of characters of the present text."""
    return docs.select("doc_id", "text", "lang", "source",
                       F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = docs.select(*COLUMNS)
    found = language.identify(docs, learned_language_model(docs))
    return found.where(F.col("lang_pred") != "und").select(*COLUMNS)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    rows = docs.select(*COLUMNS, F.xxhash64("text").alias("_k1"), F.hash("text").alias("_k2"))
    gone = saved(ngram_join.copies_to_drop(docs.select("doc_id", "text")), "gone").select(
        F.col("doc_id").alias("_id"), F.col("_k1").alias("_g1"), F.col("_k2").alias("_g2"))
    left = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("_id"))
                     & (F.col("_k1") == F.col("_g1")) & (F.col("_k2") == F.col("_g2")), "left_anti")
    # rows that repeat both id and text: one of them stays
    keys = [F.struct("doc_id").alias("_d"), "_k1", "_k2"]
    again = saved(left.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
                  .select("_d", "_k1", "_k2"), "again")
    if again.isEmpty():
        return left.select(*COLUMNS)
    keyed = left.withColumn("_d", F.struct("doc_id"))
    once = keyed.join(again, ["_d", "_k1", "_k2"]).groupBy("_d", "_k1", "_k2").agg(F.min(F.struct(
        *COLUMNS)).alias("r")).select("r.*")
    return keyed.join(again, ["_d", "_k1", "_k2"], "left_anti").select(*COLUMNS).unionByName(once)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    found = substring.remove_repeats(docs.select(*COLUMNS), keep_layout=True)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    return _columns(found.withColumn("text", text))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.removal_spans(docs.select(*COLUMNS),
                                        read_table(spark, sf_dir, "benchmark"))
    return _columns(decontaminate.without_spans(found))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return packing.pack(docs.select("doc_id", "text"), tokenizer_json(),
                        digest=F.crc32("ids")).placement.select(
        "doc_id", "start", "length", F.col("digest").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset")


STAGES = [("language_id", language_id), ("ngram_jaccard", ngram_jaccard),
          ("substring_dedup", substring_dedup), ("decontamination", decontamination),
          ("packing", pack_sequences)]

#: The language model and the tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
