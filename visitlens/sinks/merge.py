"""Result tables of the batch jobs (K1); the streams' K2-K6 are in
:mod:`visitlens.sinks.deltas`."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def with_task_id(df: DataFrame, task_id: int) -> DataFrame:
    """K1: result rows keyed by the task that produced them."""
    return df.select(F.lit(task_id).cast("bigint").alias("task_id"), *df.columns)


def append_results(df: DataFrame, path: str, task_id: int) -> None:
    """K1: store a task's result rows under ``path``, partitioned by task id.

    Only the ``task_id=<id>`` partition is replaced (dynamic partition
    overwrite), so other tasks' rows stay and re-running a task after a
    failure leaves one copy of its rows, not two.
    """
    (with_task_id(df, task_id).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("task_id").parquet(path))
