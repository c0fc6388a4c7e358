"""Real-time ad click statistics with Structured Streaming.

Query 1, one ``foreachBatch`` per micro-batch, in this fixed order:

* R2 drop clicks of users blacklisted by earlier batches: a Bloom filter of the
  blacklist lets all others pass where the batch is scanned, an exact anti
  join with the stored blacklist settles the rest,
* R3 write the batch's per-(date, user, ad) counts to ``ad_user_click_count``,
* R4 blacklist users whose total on one ad in one day reaches the threshold
  (it applies from the next batch on); only keys of this batch are looked up,
  in the folders of this batch's days (K6), and only new users are stored,
* R5 write the batch's per-(date, province, city, ad) counts to ``ad_stat``,
* R6 write the whole top list of each (date, province) the batch touched to
  ``ad_province_top3``; readers take each group's newest version (K4),
* count the malformed lines in ``ad_rejects``.

Each batch writes only its own rows (:class:`DeltaStore`) and reads what
earlier batches wrote for its days, so its cost follows the batch and its
days, not the history, and a re-delivered batch writes the same rows again.

Query 2 (R7): clicks per minute and ad on event time, a 1-minute tumbling
window with a watermark (late rows beyond it are dropped and counted, see
:func:`late_rows`; state below it is purged), emitted in update mode; the
latest row per minute wins.

Query 3: R5 as a stateful aggregate, running totals kept in the engine's
state store and upserted per batch.

Query 4: R4 in the state store: a counter per (date, user, ad); a key is stored
once, by the batch whose clicks take it over the threshold.

Query 5 (R8): the trend with a watermark of its own, so that clicks behind it
are not only dropped but counted per day.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from visitlens.functions.columns import epoch_millis, ntz_from_millis
from visitlens.operators import ads as AD
from visitlens.operators.bloom import BloomFilter
from visitlens.sinks.deltas import DeltaStore
from visitlens.sources.adlog import MS_PER_DAY, decode_ad_log, parse_ad_log, split_parsed

AD_TABLES = {
    "ad_user_click_count": T.StructType([
        T.StructField("date", T.DateType()), T.StructField("user_id", T.LongType()),
        T.StructField("ad_id", T.LongType()), T.StructField("click_count", T.LongType())]),
    "ad_blacklist": T.StructType([T.StructField("user_id", T.LongType())]),
    "ad_stat": T.StructType([
        T.StructField("date", T.DateType()), T.StructField("province", T.StringType()),
        T.StructField("city", T.StringType()), T.StructField("ad_id", T.LongType()),
        T.StructField("click_count", T.LongType())]),
    "ad_province_top3": T.StructType([
        T.StructField("date", T.DateType()), T.StructField("province", T.StringType()),
        T.StructField("ad_id", T.LongType()), T.StructField("click_count", T.LongType())]),
    # malformed lines per batch, by the (UTC) day the batch was processed
    "ad_rejects": T.StructType([T.StructField("processed", T.DateType()),
                                T.StructField("batch_id", T.LongType()),
                                T.StructField("rejected", T.LongType())]),
}

TREND_TABLES = {
    "ad_click_trend": T.StructType([
        T.StructField("date", T.DateType()), T.StructField("hour", T.StringType()),
        T.StructField("minute", T.StringType()), T.StructField("ad_id", T.LongType()),
        T.StructField("click_count", T.LongType())]),
}

BUCKET_TABLES = {
    "ad_click_bucket": T.StructType([
        T.StructField("bucket", T.LongType()), T.StructField("ad_id", T.LongType()),
        T.StructField("click_count", T.LongType())]),
}

STATEFUL_TABLES = {"ad_stat_state": AD_TABLES["ad_stat"]}

CROSSING_TABLES = {"ad_crossing": AD_TABLES["ad_user_click_count"]}

LATE_TABLES = {
    "ad_click_trend": TREND_TABLES["ad_click_trend"],
    "ad_lateness": T.StructType([
        T.StructField("date", T.DateType()), T.StructField("on_time", T.LongType()),
        T.StructField("late", T.LongType())]),
    # the newest click time seen up to a batch
    "ad_newest": T.StructType([T.StructField("newest_ms", T.LongType())]),
}

USER_KEYS = ["date", "user_id", "ad_id"]
STAT_KEYS = ["date", "province", "city", "ad_id"]
TREND_KEYS = ["date", "hour", "minute", "ad_id"]
TOP_GROUP = ["date", "province"]
KEYS = {"ad_user_click_count": USER_KEYS, "ad_stat": STAT_KEYS}


def read_table(store: DeltaStore, table: str) -> DataFrame:
    """A result table as of the last batch."""
    if table in KEYS:
        return store.total(table, KEYS[table])
    if table == "ad_blacklist":
        return store.rows(table).drop("batch")                                   # K5
    if table == "ad_province_top3":
        return store.newest(table, TOP_GROUP)                                    # R6, K4
    if table == "ad_click_trend" and "ad_newest" in store.schemas:
        return store.total(table, TREND_KEYS)
    if table == "ad_click_trend":
        return store.latest(table, TREND_KEYS)
    if table == "ad_click_bucket":
        return store.latest(table, ["bucket", "ad_id"])
    if table == "ad_stat_state":
        return store.latest(table, STAT_KEYS)
    if table == "ad_lateness":
        return _lateness(store.rows(table))
    return store.rows(table).drop("batch")


def _lateness(rows: DataFrame) -> DataFrame:
    return rows.groupBy("date").agg(F.sum("on_time").alias("on_time"), F.sum("late").alias("late"))


def _days(df: DataFrame) -> list[dt.date]:
    """The days of a batch's rows (a bounded number: click times are)."""
    return [r[0] for r in df.select("date").distinct().collect()]


def _query_id(batch: DataFrame) -> str:
    """The streaming query's id (kept in its checkpoint), or a mark for direct calls."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"


@dataclass
class AdStreamJob:
    """The per-batch body of query 1 (usable without a stream, e.g. in tests)."""

    store: DeltaStore
    threshold: int = 100
    compact_every: int = 50
    top_n: int = 3
    bloom_bits: int = 1 << 18
    _bloom: BloomFilter | None = None
    _bloom_upto: int = -1

    def process(self, batch: DataFrame, batch_id: int) -> None:
        store = self.store
        store.bind(_query_id(batch))
        self._compact(batch_id)
        parsed = parse_ad_log(batch).persist()       # the source is read once
        try:
            clicks, _ = split_parsed(parsed)
            days = _days(clicks)
            filtered = self.not_blacklisted(clicks, batch_id)                    # R2
            store.write("ad_user_click_count", batch_id,
                        AD.user_ad_click_counts(filtered), days)                 # R3
            store.write("ad_blacklist", batch_id, self._newly_blacklisted(batch_id, days))  # R4
            store.write("ad_stat", batch_id, AD.ad_stat(filtered), days)         # R5
            store.write("ad_province_top3", batch_id,
                        self._touched_top(batch_id, days), days)                 # R6
            today = F.lit(dt.datetime.now(dt.timezone.utc).date())
            store.write("ad_rejects", batch_id, parsed.agg(
                F.count_if(~F.col("valid")).alias("rejected")).select(
                today.alias("processed"), F.lit(batch_id).cast("bigint").alias("batch_id"),
                "rejected"))
            store.finish(batch_id)
        finally:
            parsed.unpersist()

    def not_blacklisted(self, clicks: DataFrame, batch_id: int) -> DataFrame:
        """The clicks of users that no batch before this one blacklisted."""
        blacklist = self.store.rows("ad_blacklist", before=batch_id)
        bloom = self._blacklist_bloom(batch_id)
        if not bloom:
            return clicks
        suspect = bloom.may_contain("user_id")
        return clicks.where(~suspect).unionByName(
            AD.filter_blacklisted(clicks.where(suspect), blacklist).select(*clicks.columns))

    def _blacklist_bloom(self, batch_id: int) -> BloomFilter:
        """The filter of the blacklist before the batch; a batch adds the users since the last."""
        stored = self.store.rows("ad_blacklist", before=batch_id)
        if self._bloom is None or self._bloom_upto >= batch_id:
            self._bloom, self._bloom_upto = BloomFilter(self.bloom_bits), -1
        if self._bloom_upto < batch_id - 1:
            self._bloom.add(stored.where(F.col("batch") > self._bloom_upto), "user_id")
            self._bloom_upto = batch_id - 1
        return self._bloom

    def _newly_blacklisted(self, batch_id: int, days: list[dt.date]) -> DataFrame:
        """Only keys that this batch raised can newly reach the threshold."""
        mine = self.store.batch_rows("ad_user_click_count", batch_id, days)
        before = self.store.rows("ad_user_click_count", before=batch_id, dates=days).drop("batch")
        totals = (before.join(mine.select(*USER_KEYS), USER_KEYS, "left_semi")
                  .unionByName(mine).groupBy(*USER_KEYS)
                  .agg(F.sum("click_count").alias("click_count")))
        return AD.blacklist_users(totals, self.threshold)

    def _touched_top(self, batch_id: int, days: list[dt.date]) -> DataFrame:
        """The top ads of each (date, province) with clicks in this batch."""
        mine = self.store.batch_rows("ad_stat", batch_id, days)
        before = self.store.rows("ad_stat", before=batch_id, dates=days).drop("batch")
        totals = before.join(mine.select(*TOP_GROUP).distinct(), TOP_GROUP, "left_semi")
        return AD.province_top_ads(totals.unionByName(mine), self.top_n)

    def _compact(self, batch_id: int) -> None:
        """Fold the batches before this one (all committed) every ``compact_every`` batches."""
        if not batch_id or batch_id % self.compact_every:
            return
        store = self.store
        folds = {table: (lambda dates, t=table, k=keys: store.total(t, k, before=batch_id,
                                                                    dates=dates))
                 for table, keys in KEYS.items()}
        folds["ad_province_top3"] = lambda dates: store.newest(
            "ad_province_top3", TOP_GROUP, before=batch_id, dates=dates)
        folds["ad_blacklist"] = lambda _: store.distinct("ad_blacklist", before=batch_id)
        store.compact(batch_id - 1, folds)
        self._bloom = None      # the fold renumbers the blacklist's rows


@dataclass
class UpsertJob:
    """Writes the rows a query emitted in a batch; the latest row per key is read back.

    Every ``compact_every`` batches the touched days are folded to one row a key.
    """

    store: DeltaStore
    table: str
    keys: list[str] | None = None
    compact_every: int = 50

    def process(self, batch: DataFrame, batch_id: int) -> None:
        store = self.store
        store.bind(_query_id(batch))
        if self.keys and batch_id and batch_id % self.compact_every == 0:
            store.compact(batch_id - 1, {self.table: lambda dates: store.latest(
                self.table, self.keys, before=batch_id, dates=dates)})
        batch = batch.persist()
        try:
            days = _days(batch) if store.dated(self.table) else ()
            store.write(self.table, batch_id, self.new_rows(batch, batch_id, days), days)
            store.finish(batch_id)
        finally:
            batch.unpersist()

    def new_rows(self, batch: DataFrame, batch_id: int, days: list[dt.date]) -> DataFrame:
        """The rows of the batch to store."""
        return batch


@dataclass
class CrossingJob(UpsertJob):
    """Writes the keys of :func:`crossing_stream` that no batch before this one stored.

    Only the stored keys of the batch's days are looked up, and only keys over the
    threshold are stored.
    """

    def new_rows(self, batch: DataFrame, batch_id: int, days: list[dt.date]) -> DataFrame:
        stored = self.store.rows(self.table, before=batch_id, dates=days)
        return batch.join(stored.select(*self.keys), self.keys, "left_anti")


@dataclass
class LateJob:
    """The per-batch body of query 5.

    The watermark of a batch is the newest click time of all batches before
    it less ``delay_ms``. Clicks from it on are counted per minute and ad;
    earlier ones are late and only counted per day. The batch's newest time is
    observed while the counts are written, so the log is read once.
    """

    store: DeltaStore
    delay_ms: int = 3_600_000
    compact_every: int = 50

    def _compact(self, batch_id: int) -> None:
        if not batch_id or batch_id % self.compact_every:
            return
        store = self.store
        store.compact(batch_id - 1, {
            "ad_click_trend": lambda dates: store.total("ad_click_trend", TREND_KEYS,
                                                        before=batch_id, dates=dates),
            "ad_lateness": lambda dates: _lateness(store.rows("ad_lateness", batch_id, dates)),
            "ad_newest": lambda _: store.rows("ad_newest", batch_id).agg(
                F.max("newest_ms").alias("newest_ms"))})

    def process(self, batch: DataFrame, batch_id: int) -> None:
        store = self.store
        store.bind(_query_id(batch))
        self._compact(batch_id)
        seen = store.rows("ad_newest", before=batch_id).agg(F.max("newest_ms")).first()[0]
        parsed = parse_ad_log(batch).persist()
        try:
            clicks, _ = split_parsed(parsed)
            late = F.lit(False) if seen is None else F.col("ts_ms") < seen - self.delay_ms
            found = Observation()
            marked = clicks.withColumn("late", late).observe(
                found, F.max("ts_ms").alias("newest_ms"), F.count(F.lit(1)).alias("n"))
            days = _days(clicks)
            store.write("ad_lateness", batch_id, marked.groupBy("date").agg(
                F.count_if(~F.col("late")).alias("on_time"),
                F.count_if("late").alias("late")), days)
            store.write("ad_click_trend", batch_id, AD.minute_trend(
                clicks.where(~late)), days)
            newest = found.get["newest_ms"] if days else None
            rows = [] if newest is None else [(max(newest, seen or newest),)]
            store.write("ad_newest", batch_id, batch.sparkSession.createDataFrame(
                rows, LATE_TABLES["ad_newest"]))
            store.finish(batch_id)
        finally:
            parsed.unpersist()


def minute_counts_stream(lines: DataFrame, watermark: str = "60 minutes") -> DataFrame:
    """R7 as a streaming aggregate: clicks per (1-minute window, ad)."""
    clicks, _ = decode_ad_log(lines)
    timed = clicks.withColumn("t", F.timestamp_millis("ts_ms"))
    counted = (timed.withWatermark("t", watermark)
               .groupBy(F.window("t", "1 minute").alias("w"), "ad_id")
               .agg(F.count(F.lit(1)).alias("click_count")))
    start = ntz_from_millis("start_ms")
    return (counted.withColumn("start_ms", F.unix_millis(F.col("w.start")))
            .select(F.to_date(start).alias("date"), F.date_format(start, "HH").alias("hour"),
                    F.date_format(start, "mm").alias("minute"), "ad_id", "click_count"))


def bucket_counts_stream(lines: DataFrame, slide_seconds: int = 10,
                         watermark: str = "60 minutes") -> DataFrame:
    """R7 sliding form: clicks per (slide bucket, ad), a tumbling window per slide.

    A click is counted once; :func:`visitlens.operators.ads.window_steps`
    makes the overlapping windows (60 min every 10 s: 360 per bucket) from the
    stored counts when they are read.
    """
    clicks, _ = decode_ad_log(lines)
    timed = clicks.withColumn("t", F.timestamp_millis("ts_ms"))
    return (timed.withWatermark("t", watermark)
            .groupBy(F.window("t", f"{slide_seconds} seconds").alias("w"), "ad_id")
            .agg(F.count(F.lit(1)).alias("click_count"))
            .select((F.unix_millis(F.col("w.start")) / (slide_seconds * 1000)).cast("bigint")
                    .alias("bucket"), "ad_id", "click_count"))


def stat_totals_stream(lines: DataFrame) -> DataFrame:
    """R5 as a stateful aggregate: running clicks per (date, province, city, ad).

    The engine keeps one counter per key in its state store and emits the
    keys a batch changed (update mode).
    """
    clicks, _ = decode_ad_log(lines)
    return clicks.groupBy(*STAT_KEYS).agg(F.count(F.lit(1)).alias("click_count"))


def crossing_stream(lines: DataFrame, threshold: int, lateness: str = "1 day") -> DataFrame:
    """R4 with its totals in the state store: rows (date, user_id, ad_id, click_count).

    A key is emitted with its running total by each batch that raises it and
    leaves it at the threshold or over; :class:`CrossingJob` stores its first row.
    The counter is the engine's own aggregate over windows of a (UTC) day, so
    clicks are counted before the exchange and a hot key sends a row a task.
    A key's counter is dropped when its day has been over for ``lateness``;
    later clicks of that day are behind the watermark and not counted (query 5
    counts those).
    """
    clicks, _ = decode_ad_log(lines)
    counted = (clicks.select("user_id", "ad_id", F.timestamp_millis("ts_ms").alias("t"))
               .withWatermark("t", lateness)
               .groupBy(F.window("t", "1 day").alias("w"), "user_id", "ad_id")
               .agg(F.count(F.lit(1)).alias("click_count")))
    return counted.where(F.col("click_count") >= threshold).select(
        F.date_from_unix_date(F.floor(F.unix_millis(F.col("w.start")) / MS_PER_DAY).cast("int"))
        .alias("date"), "user_id", "ad_id", "click_count")


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped behind the watermark, over the progress reports still kept."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress
               for op in p["stateOperators"])


def _trigger(writer, trigger: str | None):
    if trigger is None or trigger == "availableNow":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def _start(stream: DataFrame, mode: str, job, checkpoint: str,
           trigger: str | None) -> StreamingQuery:
    return _trigger(stream.writeStream.outputMode(mode).foreachBatch(job.process)
                    .option("checkpointLocation", checkpoint), trigger).start()


def start_ad_stream(spark: SparkSession, lines: DataFrame, state_root: str,
                    checkpoint: str, threshold: int = 100,
                    trigger: str | None = "5 seconds") -> tuple[StreamingQuery, DeltaStore]:
    """Run query 1 over a stream of log lines (column ``value``)."""
    store = DeltaStore(spark, state_root, AD_TABLES)
    return _start(lines, "append", AdStreamJob(store, threshold), checkpoint, trigger), store


def start_trend_stream(spark: SparkSession, lines: DataFrame, state_root: str,
                       checkpoint: str, watermark: str = "60 minutes",
                       trigger: str | None = "5 seconds") -> tuple[StreamingQuery, DeltaStore]:
    """Run query 2 over a stream of log lines (column ``value``)."""
    store = DeltaStore(spark, state_root, TREND_TABLES)
    return _start(minute_counts_stream(lines, watermark), "update",
                  UpsertJob(store, "ad_click_trend", TREND_KEYS), checkpoint, trigger), store


def start_sliding_stream(spark: SparkSession, lines: DataFrame, state_root: str,
                         checkpoint: str, slide_seconds: int = 10,
                         watermark: str = "60 minutes", trigger: str | None = "5 seconds"
                         ) -> tuple[StreamingQuery, DeltaStore]:
    """R7 sliding form: store the slide buckets' counts (``ad_click_bucket``)."""
    store = DeltaStore(spark, state_root, BUCKET_TABLES)
    return _start(bucket_counts_stream(lines, slide_seconds, watermark), "update",
                  UpsertJob(store, "ad_click_bucket", ["bucket", "ad_id"]), checkpoint, trigger), store


def start_stat_stream(spark: SparkSession, lines: DataFrame, state_root: str, checkpoint: str,
                      trigger: str | None = "5 seconds") -> tuple[StreamingQuery, DeltaStore]:
    """R5 stateful: run query 3 over a stream of log lines (column ``value``)."""
    store = DeltaStore(spark, state_root, STATEFUL_TABLES)
    return _start(stat_totals_stream(lines), "update", UpsertJob(store, "ad_stat_state", STAT_KEYS),
                  checkpoint, trigger), store


def start_crossing_stream(spark: SparkSession, lines: DataFrame, state_root: str,
                          checkpoint: str, threshold: int = 100, lateness: str = "1 day",
                          trigger: str | None = "5 seconds") -> tuple[StreamingQuery, DeltaStore]:
    """R4 stateful: run query 4 over a stream of log lines (column ``value``)."""
    store = DeltaStore(spark, state_root, CROSSING_TABLES)
    return _start(crossing_stream(lines, threshold, lateness), "update",
                  CrossingJob(store, "ad_crossing", USER_KEYS), checkpoint, trigger), store


def start_late_stream(spark: SparkSession, lines: DataFrame, state_root: str, checkpoint: str,
                      delay_ms: int = 3_600_000, trigger: str | None = "5 seconds"
                      ) -> tuple[StreamingQuery, DeltaStore]:
    """Run query 5 over a stream of log lines (column ``value``)."""
    store = DeltaStore(spark, state_root, LATE_TABLES)
    return _start(lines, "append", LateJob(store, delay_ms), checkpoint, trigger), store


def last_hour(trend: DataFrame, now_ms: int) -> DataFrame:
    """The reference's 60-minute view: minutes within the hour before ``now_ms``."""
    minute = F.to_timestamp_ntz(
        F.concat(F.col("date").cast("string"), F.lit(" "), F.col("hour"), F.lit(":"),
                 F.col("minute")), F.lit("yyyy-MM-dd HH:mm"))
    t = epoch_millis("_minute")
    return (trend.withColumn("_minute", minute)
            .where((t > F.lit(now_ms - 3_600_000)) & (t <= F.lit(now_ms)))
            .drop("_minute"))
