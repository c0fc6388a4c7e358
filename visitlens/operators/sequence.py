"""Previous row and running sums within a key's ordered sequence, safe for hot keys.

``lag(v) OVER (PARTITION BY key ORDER BY ...)`` sends every row of a key to
one task; a session holding a third of all rows would make that task a
third of the job. Here a key's rows are dealt out by ``(key, time bucket)``:
the bucket is computed from the row's own time, so every use of the frame,
a retried task or a plan without exchange reuse gives the same buckets. The
lag is taken within ``(key, bucket)``; the first row of a bucket gets the
last value of the key's bucket before, from a table with one row per
``(key, bucket)``, joined on the same two columns. The log itself is
shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def time_bucket(df: DataFrame, time_col: str, seconds: int) -> Column:
    """Number of the ``seconds`` long bucket of a TIMESTAMP_NTZ or a number of
    seconds; null time: the lowest bucket."""
    t = F.col(time_col)
    if dict(df.dtypes)[time_col] == "timestamp_ntz":
        t = F.timestamp_diff("SECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), t)
    return F.coalesce(F.floor(t / seconds), F.lit(-(1 << 62))).cast("bigint")


def previous_in_sequence(df: DataFrame, key: str, order: list[str], value: str,
                         out: str = "prev", bucket_seconds: int = 60) -> DataFrame:
    """Add ``out`` = ``value`` of the preceding row of the same ``key``.

    ``order`` starts with a TIMESTAMP_NTZ (or seconds) column and must make rows of a key
    unique (add an id as the last column). The first row of every key gets
    null; rows with a null key are one sequence. ``bucket_seconds`` must be
    fine enough that a hot key's bucket fits one task.
    """
    # A struct is never null, so no null filter is inferred for the carry branch
    # alone and both branches can read one exchange of the log.
    dealt = df.withColumns({"_key": F.struct(F.col(key).alias("k")),
                            "_bucket": time_bucket(df, order[0], bucket_seconds)}).drop(key)
    w = Window.partitionBy("_key", "_bucket").orderBy(*order)
    local = (dealt.withColumn("_prev", F.lag(value).over(w))
             .withColumn("_pos", F.row_number().over(w))
             .withColumn("_is_last", F.lead(F.lit(1)).over(w).isNull()))
    by_key = Window.partitionBy("_key").orderBy("_bucket")
    carry = (local.where("_is_last")
             .select(F.col("_key").alias("_c_key"), F.col("_bucket").alias("_c_bucket"),
                     F.lag(value).over(by_key).alias("_carry"),
                     F.lag(F.lit(1)).over(by_key).isNotNull().alias("_has_prev"))
             .where("_has_prev").drop("_has_prev"))
    joined = local.join(carry, (F.col("_key") == F.col("_c_key"))
                        & (F.col("_bucket") == F.col("_c_bucket")), "left")
    return joined.select(
        *(F.col("_key")["k"].alias(key) if c == key else F.col(c) for c in df.columns),
        F.when(F.col("_pos") == 1, F.col("_carry")).otherwise(F.col("_prev")).alias(out))


def running_steps(deltas: DataFrame, key: str, position: str, value: str, chunk: int) -> DataFrame:
    """Steps of a running sum: rows (``key``, ``position``, ``until``, ``value``).

    ``deltas`` holds changes, at most one row per (``key``, ``position``), the
    position a whole number. From ``position`` up to, not including, ``until``
    (null after the key's last change) the sum is ``value``. A key's rows are
    dealt out by chunks of ``chunk`` positions; what a chunk needs from the
    others, the sum before it and the first position after it, comes from a
    table of one row per (``key``, chunk).
    """
    # As above a struct is never null: null keys are one sequence.
    dealt = deltas.select(F.struct(F.col(key).alias("k")).alias("_key"),
                          F.floor(F.col(position) / chunk).cast("bigint").alias("_chunk"),
                          F.col(position), F.col(value))
    w = Window.partitionBy("_key", "_chunk").orderBy(position)
    local = (dealt.withColumn("_sum", F.sum(value).over(w))
             .withColumn("_next", F.lead(position).over(w)))
    by_key = Window.partitionBy("_key").orderBy("_chunk")
    chunks = (dealt.groupBy("_key", "_chunk").agg(F.sum(value).alias("_total"),
                                                  F.min(position).alias("_first"))
              .select(F.col("_key").alias("_c_key"), F.col("_chunk").alias("_c_chunk"),
                      F.sum("_total").over(by_key.rowsBetween(Window.unboundedPreceding, -1))
                      .alias("_before"),
                      F.lead("_first").over(by_key).alias("_after")))
    joined = local.join(chunks, (F.col("_key") == F.col("_c_key"))
                        & (F.col("_chunk") == F.col("_c_chunk")))
    return joined.select(
        F.col("_key")["k"].alias(key), F.col(position),
        F.coalesce("_next", "_after").alias("until"),
        (F.col("_sum") + F.coalesce("_before", F.lit(0))).alias(value))
