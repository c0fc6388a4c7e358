"""Small DataFrame helpers of the corpus operators."""

from __future__ import annotations

import ctypes
import inspect
import pickle
import sys
import types

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.session import drop_paths, materialize, scratch_dir


def small_batches(spark: SparkSession) -> None:
    """Bound the rows and bytes of the batches handed to Python, as a row may be long.

    Always the same values: the settings act when a query runs, not when it is built.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; Python steps over it get small batches."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Shared:
    """A broadcast value that executors can load without this package.

    Classes of this subpackage are pickled by value, as its functions are.
    """

    def __init__(self, spark: SparkSession, value):
        self._data = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        return pickle.loads(self._data.value)


def worker_state() -> dict:
    """A dict that lives as long as the Python worker process, for what tasks may share.

    Only for caches: tasks must give the same rows with an empty one. Functions
    are shipped by value, so globals of this package do not outlive a task.
    """
    name = "_visitlens_worker_state"
    return vars(sys.modules.setdefault(name, types.ModuleType(name)))


def map_batches(df: DataFrame, fn, schema) -> DataFrame:
    """``mapInArrow`` that gives memory back when a task ends.

    Python workers serve one task after another, and both allocators keep
    what a task has freed; two workers share an executor with the JVM.
    """
    def run(batches):
        try:
            yield from fn(batches)
        finally:
            give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def trimmed(fn):
    """A step of ``applyInArrow`` that gives memory back after a group, as ``map_batches``."""
    def one(a: pa.Table) -> pa.Table:
        try:
            return fn(a)
        finally:
            give_back()

    def two(a: pa.Table, b: pa.Table) -> pa.Table:
        try:
            return fn(a, b)
        finally:
            give_back()

    return one if len(inspect.signature(fn).parameters) == 1 else two


def held_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null id: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: later steps restart from files."""
    return materialize(df, f"llm-{name}")


class Kept:
    """Saved steps of one job that are deleted once their readers are written.

    Within ``with`` Spark also deletes a step's shuffle files as soon as it is written,
    instead of when the driver next collects its garbage, and ``saved_by`` writes the
    values' files side by side, without sorting the rows by them.
    """

    SETTINGS = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
                "spark.sql.maxConcurrentOutputFileWriters": "4"}

    def __init__(self, spark: SparkSession):
        self._spark, self._paths = spark, []

    def __enter__(self):
        self._was = {k: self._spark.conf.get(k, None) for k in self.SETTINGS}
        for k, v in self.SETTINGS.items():
            self._spark.conf.set(k, v)
        return self

    def __exit__(self, *exc):
        for k, v in self._was.items():
            if v is None:
                self._spark.conf.unset(k)
            else:
                self._spark.conf.set(k, v)

    def saved(self, df: DataFrame, name: str) -> DataFrame:
        written: list[str] = []
        out = materialize(df, f"llm-{name}", written)
        self._paths.append((out, written))
        return out

    def saved_by(self, df: DataFrame, name: str, kind: str, values: list[str]) -> list[DataFrame]:
        """The rows of each value of the column ``kind``, to be dropped one by one."""
        path = scratch_dir(self._spark, f"llm-{name}")
        df.write.mode("overwrite").partitionBy(kind).parquet(path)
        rows = self._spark.read.schema(df.schema).parquet(path)
        out = [rows.where(F.col(kind) == v).drop(kind) for v in values]
        self._paths += [(x, [f"{path}/{kind}={v}"]) for x, v in zip(out, values)]
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Nothing that is still to run may read them."""
        for out, written in self._paths:
            if any(out is t for t in tables):
                drop_paths(self._spark, written)
        self._paths = [x for x in self._paths if not any(x[0] is t for t in tables)]


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a, b): rows (node, comp), comp the smallest node.

    Alternating large-star and small-star steps, each one aggregate over the
    nodes, which shorten paths to stars in a logarithmic number of rounds;
    every round is written to the shared folder, and its smallest neighbours are, so
    that both sides of the join by centre are stored rows and a common centre's
    neighbours can be split over tasks. Only a checksum of the edges
    reaches the driver. Rows with a = b or nulls are ignored.
    """
    e = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                           F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    for _ in range(max_rounds):
        # large star: every larger neighbour of a node goes to its smallest one
        both = e.select(F.col("a").alias("n"), F.col("b").alias("m")).unionByName(
            e.select(F.col("b").alias("n"), F.col("a").alias("m")))
        low = saved(both.groupBy("n").agg(F.min("m").alias("low")).select(
            "n", F.least("n", "low").alias("low")), "low")
        large = (both.where("m > n").join(low, "n").where("m <> low")
                 .select(F.col("m").alias("a"), F.col("low").alias("b")).distinct())
        # small star: every smaller neighbour, and the node itself, to the smallest
        low2 = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low2, "a").select(
            F.explode(F.array(F.struct(F.col("b").alias("x"), "low"),
                              F.struct(F.col("a").alias("x"), "low"))).alias("s"))
        nxt = saved(small.select(F.col("s.x").alias("a"), F.col("s.low").alias("b"))
                    .where("a <> b").distinct(), "edges")
        e, was, mark = nxt, mark, tuple(nxt.agg(
            F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())
        if mark == was:
            break
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())

