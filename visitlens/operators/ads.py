"""Ad click statistics as batch functions (R2-R7 bodies).

Each function maps decoded clicks (see
:func:`visitlens.sources.adlog.decode_ad_log`) to one result table; the
streaming job in :mod:`visitlens.streaming.ad_stream` applies them per
micro-batch. All are hash aggregates with partial aggregation, so a user
or ad holding a large share of clicks is combined map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from visitlens.functions.columns import format_time, ntz_from_millis
from visitlens.operators.sequence import running_steps
from visitlens.operators.topk import top_n_per_group
from visitlens.sources.adlog import MS_PER_DAY


def filter_blacklisted(clicks: DataFrame, blacklist: DataFrame) -> DataFrame:
    """R2 (J5 + P6): drop clicks of blacklisted users (anti join on user_id).

    AQE broadcasts the blacklist when its measured size allows. Beyond that
    it splits a hot user's clicks, which needs both sides to come straight
    from a shuffle: pass a stored blacklist, not one aggregated in the plan.
    """
    return clicks.join(blacklist.select("user_id"), "user_id", "left_anti")


def user_ad_click_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per (date, user, ad)."""
    return (clicks.groupBy("date", "user_id", "ad_id")
            .agg(F.count(F.lit(1)).alias("click_count")))


def blacklist_users(totals: DataFrame, threshold: int = 100) -> DataFrame:
    """P7 + A13: users with at least ``threshold`` clicks on one ad in one day."""
    return (totals.where(F.col("click_count") >= F.lit(threshold))
            .select("user_id").distinct())


def ad_stat(clicks: DataFrame) -> DataFrame:
    """R5 body: clicks per (date, province, city, ad)."""
    return (clicks.groupBy("date", "province", "city", "ad_id")
            .agg(F.count(F.lit(1)).alias("click_count")))


def province_top_ads(stat: DataFrame, n: int = 3) -> DataFrame:
    """R6 (A14 + W2): the n most clicked ads per (date, province).

    Ties are broken by the smaller ad id (window group limit plan).
    """
    by_province = (stat.groupBy("date", "province", "ad_id")
                   .agg(F.sum("click_count").alias("click_count")))
    return top_n_per_group(by_province, ["date", "province"],
                           [F.desc("click_count"), F.asc("ad_id")], n).drop("rn")


def minute_trend(clicks: DataFrame) -> DataFrame:
    """R7 (event time): clicks per (date, hour, minute, ad)."""
    t = ntz_from_millis("ts_ms")
    return (clicks.groupBy(F.col("date"), F.date_format(t, "HH").alias("hour"),
                           F.date_format(t, "mm").alias("minute"), "ad_id")
            .agg(F.count(F.lit(1)).alias("click_count")))


def slide_counts(clicks: DataFrame, slide_seconds: int) -> DataFrame:
    """Clicks per (slide bucket, ad)."""
    return (clicks.groupBy(F.floor(F.col("ts_ms") / (slide_seconds * 1000)).alias("bucket"),
                           "ad_id").agg(F.count(F.lit(1)).alias("click_count")))


def window_steps(buckets: DataFrame, window_seconds: int, slide_seconds: int,
                 chunk_seconds: int = 21_600) -> DataFrame:
    """Sliding windows as steps: rows (ad_id, bucket, until, click_count).

    Windows starting at slide buckets ``bucket`` up to, not including,
    ``until`` hold ``click_count`` clicks of the ad; those without clicks are
    left out. A bucket's count c is a difference array of two rows, +c where
    the first window that covers it starts and -c after the last, however
    many windows cover it. ``buckets`` come from :func:`slide_counts` or from
    the stream's stored counts. An ad's rows are dealt out by
    ``chunk_seconds`` of time, so a hot ad is split over tasks.
    """
    if window_seconds % slide_seconds:
        raise ValueError("window must be a multiple of the slide")
    copies = window_seconds // slide_seconds
    change = F.explode(F.array(
        F.struct((F.col("bucket") - (copies - 1)).alias("bucket"),
                 F.col("click_count").alias("n")),
        F.struct((F.col("bucket") + 1).alias("bucket"), (-F.col("click_count")).alias("n"))))
    deltas = (buckets.select("ad_id", change.alias("d"))
              .groupBy("ad_id", F.col("d.bucket").alias("bucket"))
              .agg(F.sum("d.n").alias("click_count")).where("click_count <> 0"))
    return running_steps(deltas, "ad_id", "bucket", "click_count",
                         max(1, chunk_seconds // slide_seconds)).where("click_count > 0")


def sliding_trend(clicks: DataFrame, window_seconds: int = 3600,
                  slide_seconds: int = 10) -> DataFrame:
    """Clicks per ad in sliding event-time windows ``[start, start + window)``.

    Equal to ``groupBy(window(t, window, slide), ad_id).count()``, but clicks
    are counted per slide bucket and summed as steps (:func:`window_steps`);
    only the finished steps are written out as one row a window.
    """
    return list_windows(window_steps(slide_counts(clicks, slide_seconds), window_seconds,
                                     slide_seconds), window_seconds, slide_seconds)


def list_windows(steps: DataFrame, window_seconds: int, slide_seconds: int) -> DataFrame:
    """One row a window: (window_start, window_end, ad_id, click_count)."""
    start_ms = F.col("bucket") * (slide_seconds * 1000)
    return (steps.select("ad_id", "click_count", F.explode(
        F.sequence("bucket", F.col("until") - 1)).alias("bucket"))
        .select(start_ms.alias("start_ms"),
                (start_ms + window_seconds * 1000).alias("end_ms"), "ad_id", "click_count")
        .select(format_time(ntz_from_millis("start_ms")).alias("window_start"),
                format_time(ntz_from_millis("end_ms")).alias("window_end"),
                "ad_id", "click_count"))


def peak_windows(steps: DataFrame, slide_seconds: int) -> DataFrame:
    """Per day and ad the most clicks a sliding window holds, and the first such window.

    A window belongs to the day it starts in; a step that lasts over midnight
    counts for each of its days, from the day's first window on.
    """
    slide_ms = slide_seconds * 1000
    day = F.explode(F.sequence(F.floor(F.col("bucket") * slide_ms / MS_PER_DAY),
                               F.floor((F.col("until") - 1) * slide_ms / MS_PER_DAY)))
    first = F.greatest("bucket", F.ceil(F.col("day") * MS_PER_DAY / slide_ms))
    return (steps.withColumn("day", day)
            .groupBy("day", "ad_id")
            .agg(F.max(F.struct("click_count", (-first).alias("start"))).alias("top"))
            .select((-F.col("top.start") * slide_ms).alias("start_ms"), "ad_id",
                    F.col("top.click_count").alias("click_count"))
            .select(F.substring(format_time(ntz_from_millis("start_ms")), 1, 10).alias("day"),
                    "ad_id", "click_count",
                    format_time(ntz_from_millis("start_ms")).alias("window_start")))
