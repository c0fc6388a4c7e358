"""Time-stratified session sample (B4: A4 + T4 + T5 + J8).

A sample of about ``n`` sessions is split evenly over the days present
(``n // days`` per day, integer division) and within a day in proportion
to each hour's sessions: ``quota = floor(hour_count / day_count *
per_day)``, capped at the hour's count. Within an hour the sessions with
the smallest ``md5(session_id || seed)`` (then session id) are taken, so
the sample is reproducible and retry-safe.

Plan: only the narrow keys (date, hour, sample order, session id) are
ranked. A stratum's sessions are dealt over ``SUB_GROUPS`` hash groups, each
keeps at most the stratum's quota, and the survivors are ranked again: at
most ``SUB_GROUPS`` times the sample's size in all, whatever the shuffle
partitions, so a hot hour does not land whole in one task. The drawn ids are
joined back to the sessions. The quota table has at most 24 rows per day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

SUB_GROUPS = 64


def with_start_hour(sessions: DataFrame) -> DataFrame:
    return sessions.withColumns({"date": F.to_date("start_time"),
                                 "hour": F.hour("start_time").cast("int")})


def session_hour_counts(sessions: DataFrame) -> DataFrame:
    """A4: number of sessions starting in each (date, hour)."""
    return (with_start_hour(sessions).groupBy("date", "hour")
            .agg(F.count(F.lit(1)).alias("session_count")))


def sample_quotas(hour_counts: DataFrame, n: int) -> DataFrame:
    """T4: sessions to draw from each (date, hour).

    The windows without partition run over the strata table, at most 24
    rows per day of data, never over sessions.
    """
    everything = Window.partitionBy()
    per_day = F.floor(F.lit(n) / F.col("_days"))
    day_count = F.sum("session_count").over(Window.partitionBy("date"))
    quota = F.floor((F.col("session_count").cast("double") / day_count.cast("double"))
                    * per_day)
    return (hour_counts
            .withColumn("_dr", F.dense_rank().over(Window.orderBy("date")))
            .withColumn("_days", F.max("_dr").over(everything))
            .select("date", "hour",
                    F.least(quota, F.col("session_count")).cast("bigint").alias("quota")))


def sample_sessions(sessions: DataFrame, n: int, seed: str,
                    sub_groups: int = SUB_GROUPS) -> DataFrame:
    """T5: the sampled sessions (all input columns), at most ``n`` rows."""
    quotas = sample_quotas(session_hour_counts(sessions), n).where("quota > 0")
    keys = (with_start_hour(sessions.select("session_id", "start_time"))
            .select("session_id", "date", "hour",
                    F.md5(F.concat(F.col("session_id"), F.lit(seed))).alias("_h"))
            .join(quotas, ["date", "hour"])
            .withColumn("_sub", F.pmod(F.xxhash64("session_id"), F.lit(sub_groups))))
    order = ["_h", "session_id"]
    within = Window.partitionBy("date", "hour", "_sub").orderBy(*order)
    stratum = Window.partitionBy("date", "hour").orderBy(*order)
    drawn = (keys.withColumn("_r", F.row_number().over(within))
             .where(F.col("_r") <= F.col("quota"))
             .withColumn("_r", F.row_number().over(stratum))
             .where(F.col("_r") <= F.col("quota")))
    return with_start_hour(sessions).join(drawn.select("session_id"), "session_id", "left_semi")
