"""Ad click log decode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from visitlens.functions.columns import ntz_from_millis

MS_PER_DAY = 86_400_000
# Times a click may have: 1970-01-01 up to, not including, 2100-01-01. Anything
# else is a reject, so no later arithmetic can overflow and a batch touches a
# bounded number of days.
MIN_MS, MAX_MS = 0, 4_102_444_800_000


CLICK_COLUMNS = ["ts_ms", "date", "event_time", "province", "city", "user_id", "ad_id"]


def parse_ad_log(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Typed columns of every line plus ``valid`` (false for malformed lines)."""
    parts = F.split(F.col(value_col), "_")
    ms = F.get(parts, 0).try_cast("bigint")
    parsed = lines.select(
        "*",
        F.size(parts).alias("_n"),
        F.when((ms >= MIN_MS) & (ms < MAX_MS), ms).alias("ts_ms"),  # get(): null when short
        F.get(parts, 1).alias("province"),
        F.get(parts, 2).alias("city"),
        F.get(parts, 3).try_cast("bigint").alias("user_id"),
        F.get(parts, 4).try_cast("bigint").alias("ad_id"),
    )
    ok = ((F.col("_n") == 5) & F.col("ts_ms").isNotNull() & F.col("user_id").isNotNull()
          & F.col("ad_id").isNotNull())
    return parsed.select(
        F.col(value_col),
        F.coalesce(ok, F.lit(False)).alias("valid"),
        "ts_ms",
        F.date_from_unix_date(F.floor(F.col("ts_ms") / MS_PER_DAY).cast("int")).alias("date"),
        ntz_from_millis("ts_ms").alias("event_time"),
        "province", "city", "user_id", "ad_id",
    )


def split_parsed(parsed: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    return (parsed.where("valid").select(*CLICK_COLUMNS),
            parsed.where(~F.col("valid")).select(value_col))


def decode_ad_log(lines: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Split ``ts_province_city_user_ad`` lines into typed columns.

    Returns ``(clicks, rejects)``: lines without exactly five parts or
    with a non-numeric user or ad, or a time that is no number or out of
    range, go to ``rejects`` instead of
    failing the batch. ``date``, ``event_time`` are UTC, time-zone free.
    """
    return split_parsed(parse_ad_log(lines, value_col), value_col)


def kafka_ad_log(spark: SparkSession, bootstrap_servers: str, topics: str,
                 starting_offsets: str = "latest") -> DataFrame:
    """Ad log as a Kafka stream (needs the spark-sql-kafka package).

    ``topics`` is a comma list; key and value arrive as strings.
    """
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", topics)
            .option("startingOffsets", starting_offsets)
            .load()
            .select(F.col("key").cast("string").alias("key"),
                    F.col("value").cast("string").alias("value")))
