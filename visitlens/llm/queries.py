"""Registered queries of the thirteen operators, with production parameters."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm import oracle
from visitlens.llm.frames import held_fold, read_table

TOKENIZER = "word_bpe_49k.json"


def tokenizer_json(path: str | None = None) -> str:
    """The tokenizer file's content; ``path`` defaults to the installed public one."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(TOKENIZER)
    return Path(path).read_text(encoding="utf-8")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from visitlens.llm.warc import archive_dir, read_archives, write_archives
    path = archive_dir(spark)
    write_archives(read_table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "error")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from visitlens.llm.quality import fit, judge, text_stats
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").groupBy("doc_id").agg(
        F.min("quality").alias("quality"))
    train = docs.join(labels, "doc_id").select("text", "quality", F.xxhash64("doc_id").alias("row"))
    return judge(text_stats(docs), fit(train, row_key=F.col("row"))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "rule")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from visitlens.llm.packing import pack
    return pack(read_table(spark, sf_dir, "documents"), tokenizer_json(),
                digest=F.crc32("ids")).placement.select(
        "doc_id", "start", "length", F.col("digest").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from visitlens.llm.decontaminate import removal_spans
    found = removal_spans(read_table(spark, sf_dir, "documents").select("doc_id", "text"),
                          read_table(spark, sf_dir, "benchmark")).drop("text")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))


def learned_language_model(docs: DataFrame):
    """Fitted on the documents outside the held-out quarter of ids."""
    from visitlens.llm.language import fit
    train = docs.where(held_fold(F.col("doc_id"), 4) != 2)
    return fit(train.select("text", "lang", F.xxhash64("doc_id").alias("row")),
               row_key=F.col("row"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from visitlens.llm.language import identify
    docs = read_table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), learned_language_model(docs))
    return found.select("doc_id", F.coalesce(held_fold(F.col("doc_id"), 4) == 2, F.lit(False))
                        .alias("held_out"), "lang_pred", "score")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from visitlens.llm.substring import remove_repeats
    return remove_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def url_rules():
    from visitlens.llm.urls import Rule
    return [Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"),
            Rule("block", "example.org", "/en/1"), Rule("allow", "com", "/fr/"),
            Rule("block", "com", "/de/")]


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from visitlens.llm.urls import fit, lexical, parsed, with_rules
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    ruled = lexical(with_rules(parsed(pages), url_rules()))
    label = F.when(F.col("rule_verdict") == "block", 1).when(F.col("rule_verdict") == "allow", 0)
    judged = fit(ruled.withColumn("label", label)).predict(ruled)
    return judged.select(
        "page_id", "host", "path", "rule",
        F.coalesce("rule_verdict", F.when(F.col("blocked") > 0.5, "block").otherwise("allow"))
        .alias("verdict"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from visitlens.llm.toxicity import fit, score
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").where(held_fold(F.col("doc_id"), 5) != 0) \
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    train = docs.join(labels, "doc_id").select("text", "toxic", F.xxhash64("doc_id").alias("row"))
    found = score(docs, fit(train, row_key=F.col("row"))).drop("text")
    return found.select(
        "doc_id", F.coalesce(held_fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("offenders").alias("n_offenders"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from visitlens.llm.ngram_join import similar_documents
    return similar_documents(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    from visitlens.llm.pitman_yor import score_texts
    held_out = F.coalesce(held_fold(F.col("doc_id"), 7) == 2, F.lit(False))
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text",
                                                         (~held_out).alias("train"))
    return score_texts(docs).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score")


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from visitlens.llm.token_files import token_digests
    from visitlens.session import scratch_dir
    return token_digests(read_table(spark, sf_dir, "documents"),
                         scratch_dir(spark, "token-files"), tokenizer_json())


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from visitlens.llm.whitening import whiten
    return whiten(read_table(spark, sf_dir, "embeddings"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from visitlens.llm.hard_negatives import mine
    label = F.col("label").cast("long")
    table = read_table(spark, sf_dir, "embeddings").withColumn("label", F.when(
        F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return mine(table, is_anchor=F.col("vec_id") % 100 == 0)


QUERIES = {"op1_decontamination": op1_decontamination,
           "op2_language": op2_language,
           "op3_substring_dedup": op3_substring_dedup,
           "op4_warc": op4_warc,
           "op5_quality_rules": op5_quality_rules,
           "op6_packing": op6_packing,
           "op7_url_filter": op7_url_filter,
           "op8_toxicity": op8_toxicity,
           "op9_ngram_join": op9_ngram_join,
           "op10_pitman_yor": op10_pitman_yor,
           "op11_token_files": op11_token_files,
           "op12_whitening": op12_whitening,
           "op13_hard_negatives": op13_hard_negatives}
ORACLE: dict[str, str] = {"op1_decontamination": oracle.OP1,
                          "op3_substring_dedup": oracle.OP3,
                          "op4_warc": oracle.OP4,
                          "op13_hard_negatives": oracle.OP13}
