"""Per-batch result folders of a stream, by day (K2-K6).

A table is a folder of Parquet written by Spark. A table with a ``date`` has
one folder a day, others are one folder:

    <table>/date=<d>/kind=part/batch=<n>   the rows batch n wrote for the day
    <table>/date=<d>/kind=all/batch=<n>    the day's content up to batch n

Writing a batch replaces its own folders, so a re-delivered batch counts once,
and costs what the batch holds, however much is stored. A batch counts as
written when its manifest ``_batches/<n>`` is there, which names the days it
touched in each table; readers use whole batches only. Reading sums the
folders (or takes the latest row per key, or each group's newest version),
and a read for given dates lists and opens those days' folders only.

``compact`` folds the days touched since the last compaction, named by the
manifests, and leaves all other days as they are. Folders it replaced are
dropped by the next compaction, so a result read before stays readable
meanwhile.

The store remembers the streaming query it belongs to. A query with a new
checkpoint counts batches from 0 again and would overwrite or skip results,
so it is refused.
"""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

PARTITIONS = [T.StructField("kind", T.StringType()), T.StructField("batch", T.LongType())]


class DeltaStore:
    """Result tables under ``root``; ``schemas`` maps a table to its row type."""

    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, T.StructType]):
        self.spark, self.root, self.schemas = spark, root.rstrip("/"), schemas
        self._jvm = spark.sparkContext._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(
            spark.sparkContext._jsc.hadoopConfiguration())
        self._touched: dict[str, list[str]] = {}

    # -- small files -------------------------------------------------------

    def _put(self, name: str, text: str) -> None:
        out = self._fs.create(self._path(f"{self.root}/{name}"), True)
        out.write(bytearray(text.encode()))
        out.close()

    def _get(self, name: str) -> str:
        stream = self._fs.open(self._path(f"{self.root}/{name}"))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _numbers(self, folder: str) -> list[int]:
        """The numeric file names of a folder, ascending."""
        base = self._path(f"{self.root}/{folder}")
        if not self._fs.exists(base):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(base)]
        return sorted(int(n) for n in names if n.isdigit())

    def _folders(self, table: str, dates: Iterable[dt.date] | None = None
                 ) -> list[tuple[str, str, int, str]]:
        """(date or '', kind, batch, path) of a table's folders, of some days if given."""
        days = [""]
        if self.dated(table):
            days = ["date=*"] if dates is None else [f"date={d}" for d in sorted(set(dates))]
        out = []
        for day in days:
            pattern = "/".join(x for x in (self.root, table, day, "kind=*", "batch=*") if x)
            for f in self._fs.globStatus(self._path(pattern)) or ():
                path = f.getPath().toString()
                date, kind, batch = re.search(
                    r"/(?:date=([^/]+)/)?kind=(\w+)/batch=(\d+)$", path).groups()
                out.append((date or "", kind, int(batch), path))
        return out

    # -- writing -----------------------------------------------------------

    def dated(self, table: str) -> bool:
        return "date" in self.schemas[table].fieldNames()

    def bind(self, query_id: str) -> None:
        """Tie the folder to a streaming query; another query's folder is refused."""
        if not self._fs.exists(self._path(f"{self.root}/_query")):
            self._put("_query", query_id)
            return
        owner = self._get("_query")
        if owner != query_id:
            raise ValueError(f"{self.root} holds the results of streaming query {owner}, not of "
                             f"{query_id}: a new checkpoint needs a new result folder")

    def _write(self, table: str, kind: str, batch_id: int, rows: DataFrame) -> None:
        day = ["date"] if self.dated(table) else []
        if day:     # few files a day, and a large day in several
            rows = rows.hint("rebalance", "date")
        (rows.select(*self.schemas[table].fieldNames(), F.lit(kind).alias("kind"),
                     F.lit(batch_id).cast("bigint").alias("batch"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*day, "kind", "batch").parquet(f"{self.root}/{table}"))

    def write(self, table: str, batch_id: int, rows: DataFrame,
              dates: Iterable[dt.date] = ()) -> None:
        """Replace the batch's rows of a table; ``dates`` are the days of a dated table's rows."""
        self._write(table, "part", batch_id, rows)
        self._touched[table] = sorted(str(d) for d in dates) if self.dated(table) else [""]

    def finish(self, batch_id: int) -> None:
        """All tables of the batch are written: from now on readers see them."""
        self._put(f"_batches/{batch_id}", json.dumps(self._touched))
        self._touched = {}

    # -- reading -----------------------------------------------------------

    def last_batch(self) -> int | None:
        return max(self._numbers("_batches"), default=None)

    def _read(self, table: str, paths: list[str]) -> DataFrame:
        schema = self.schemas[table]
        names = [*schema.fieldNames(), "batch"]
        if not paths:
            return self.spark.createDataFrame([], T.StructType(
                [*schema.fields, PARTITIONS[1]])).select(*names)
        full = T.StructType([*schema.fields, *PARTITIONS])
        return (self.spark.read.schema(full).option("basePath", f"{self.root}/{table}")
                .parquet(*paths).select(*names))

    def rows(self, table: str, before: int | None = None,
             dates: Iterable[dt.date] | None = None) -> DataFrame:
        """All stored rows with ``batch``; of batches under ``before``, of some days, if given."""
        last = self.last_batch() if before is None else before - 1
        base: dict[str, int] = {}
        folders = [f for f in self._folders(table, dates) if last is not None and f[2] <= last]
        for day, kind, batch, _ in folders:
            if kind == "all":
                base[day] = max(base.get(day, -1), batch)
        paths = [path for day, kind, batch, path in folders
                 if (kind == "all" and batch == base[day])
                 or (kind == "part" and batch > base.get(day, -1))]
        found = self._read(table, paths)
        if dates is not None and self.dated(table):
            found = found.where(F.col("date").isin(sorted(set(dates))))
        return found

    def batch_rows(self, table: str, batch_id: int, dates: Iterable[dt.date] | None = None
                   ) -> DataFrame:
        """What one batch wrote, also before it is finished."""
        return self._read(table, [f[3] for f in self._folders(table, dates)
                                  if f[1:3] == ("part", batch_id)]).drop("batch")

    def total(self, table: str, keys: list[str], value: str = "click_count",
              before: int | None = None, dates: Iterable[dt.date] | None = None) -> DataFrame:
        """K2: the sum of the batches' partial counts per key."""
        return self.rows(table, before, dates).groupBy(*keys).agg(
            F.sum(value).cast("bigint").alias(value))

    def latest(self, table: str, keys: list[str], value: str = "click_count",
               before: int | None = None, dates: Iterable[dt.date] | None = None) -> DataFrame:
        """K3: the row of the last batch that wrote a key."""
        return self.rows(table, before, dates).groupBy(*keys).agg(
            F.max_by(value, "batch").alias(value))

    def newest(self, table: str, group: list[str], before: int | None = None,
               dates: Iterable[dt.date] | None = None) -> DataFrame:
        """K4: each group's rows as the last batch that wrote the group left them."""
        last = F.max("batch").over(Window.partitionBy(*group))
        return (self.rows(table, before, dates).withColumn("_last", last)
                .where(F.col("batch") == F.col("_last")).drop("batch", "_last"))

    def distinct(self, table: str, before: int | None = None) -> DataFrame:
        """K5: the union of the batches' rows."""
        return self.rows(table, before).drop("batch").distinct()

    # -- compaction --------------------------------------------------------

    def touched(self, table: str, after: int, upto: int) -> list[str]:
        """Days that batches ``after`` < n <= ``upto`` wrote, by their manifests."""
        days: set[str] = set()
        for n in self._numbers("_batches"):
            if after < n <= upto:
                days |= set(json.loads(self._get(f"_batches/{n}")).get(table, ()))
        return sorted(days)

    def compact(self, upto: int, folds: dict[str, Callable[[Iterable[dt.date] | None], DataFrame]]
                ) -> dict[str, list[str]]:
        """Fold the days touched since the last compaction, up to batch ``upto``.

        ``folds`` maps a table to a function from dates (None: undated) to its
        content up to that batch. Returns the days folded of each table. What
        the previous compaction replaced is deleted now.
        """
        done = [n for n in self._numbers("_compactions") if n < upto]
        after = done[-1] if done else -1
        folded: dict[str, list[str]] = {}
        for table, fold in folds.items():
            days = self.touched(table, after, upto)
            if not days:
                continue
            dates = [dt.date.fromisoformat(d) for d in days] if self.dated(table) else None
            self._write(table, "all", upto, fold(dates))
            folded[table] = days
        if done:
            for table, days in json.loads(self._get(f"_compactions/{after}")).items():
                dates = [dt.date.fromisoformat(d) for d in days] if self.dated(table) else None
                for _, kind, batch, path in self._folders(table, dates):
                    if (kind == "part" and batch <= after) or (kind == "all" and batch < after):
                        self._fs.delete(self._path(path), True)
            for n in self._numbers("_batches"):
                if n <= after:
                    self._fs.delete(self._path(f"{self.root}/_batches/{n}"), False)
        self._put(f"_compactions/{upto}", json.dumps(folded))
        return folded
