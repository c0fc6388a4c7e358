"""JDBC dimension read (S4) and result write (K1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_city_info(spark: SparkSession, url: str, table: str = "city_info",
                   properties: dict[str, str] | None = None) -> DataFrame:
    """``city_info(city_id int, city_name, area)`` from a database.

    The id is widened to bigint so it joins the action log's city ids.
    """
    df = spark.read.jdbc(url, table, properties=properties or {})
    return df.select(F.col("city_id").cast("bigint").alias("city_id"),
                     "city_name", "area")


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               properties: dict[str, str] | None = None, batch_size: int = 1000) -> None:
    """Append result rows through the Spark JDBC writer (batched inserts)."""
    props = dict(properties or {})
    props.setdefault("batchsize", str(batch_size))
    df.write.jdbc(url, table, mode=mode, properties=props)
