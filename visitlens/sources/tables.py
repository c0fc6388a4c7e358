"""Parquet table reads (S3, S5 and the driver's test tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events", "documents", "embeddings", "pages",
               "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """One table stored as ``<base_dir>/<name>.parquet`` (file or folder)."""
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy accessor: ``Tables(spark, sf_dir).events`` reads on first use."""

    def __init__(self, spark: SparkSession, base_dir: str):
        self.spark = spark
        self.base_dir = base_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TEST_TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.base_dir, name)
        return self._cache[name]


def write_partitioned(df: DataFrame, path: str, partition_col: str = "date",
                      mode: str = "overwrite") -> None:
    """Store a log partitioned by ``partition_col`` (the day).

    Rows are range-partitioned on (day, row hash): each task writes one or
    two day folders instead of one file per (task, day), and a day holding
    a large share of the rows is still split over several tasks. A
    date-range read of the result prunes whole folders (``PartitionFilters``
    in the plan) before any file is opened.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartitionByRange(n, F.col(partition_col), F.xxhash64(*df.columns))
       .write.mode(mode).partitionBy(partition_col).parquet(path))


def read_log(spark: SparkSession, path: str, fmt: str = "parquet", schema=None,
             options: dict[str, str] | None = None) -> DataFrame:
    """Read a log stored as parquet, orc, csv or json, or a catalog table.

    Text formats are read with the given schema (no inference pass over
    the data); ``fmt="table"`` reads ``path`` as a catalog table name.
    """
    if fmt == "table":
        return spark.table(path)
    reader = spark.read.format(fmt).options(**(options or {}))
    if fmt in ("csv", "json"):
        if schema is None:
            raise ValueError(f"{fmt} needs an explicit schema")
        if fmt == "csv":
            reader = reader.option("header", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)
