"""Session analysis: aggregate (B1), filter (B2), statistics (B3), detail.

Shuffle plan: hash aggregates with partial aggregation map-side, so a
session holding a large share of the rows is combined before the exchange
(with its lists: first per distinct value, then per session), then a join to ``user_info`` on ``user_id`` that
AQE turns into a broadcast only when the measured user side is small.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from visitlens.functions.columns import action_timestamp, not_empty, ratio_half_up
from visitlens.params import TaskParams

# Bucket edges of the session statistics (fixed values). Visit length in
# seconds; a visit of 0 s falls in no bucket.
VISIT_BUCKETS = [
    ("visit_length_1s_3s_ratio", 1, 3),
    ("visit_length_4s_6s_ratio", 4, 6),
    ("visit_length_7s_9s_ratio", 7, 9),
    ("visit_length_10s_30s_ratio", 10, 30),
    ("visit_length_30s_60s_ratio", 31, 60),
    ("visit_length_1m_3m_ratio", 61, 180),
    ("visit_length_3m_10m_ratio", 181, 600),
    ("visit_length_10m_30m_ratio", 601, 1800),
    ("visit_length_30m_ratio", 1801, None),
]
STEP_BUCKETS = [
    ("step_length_1_3_ratio", 1, 3),
    ("step_length_4_6_ratio", 4, 6),
    ("step_length_7_9_ratio", 7, 9),
    ("step_length_10_30_ratio", 10, 30),
    ("step_length_30_60_ratio", 31, 60),
    ("step_length_60_ratio", 61, None),
]


def actions_in_range(actions: DataFrame, start_date: dt.date | None,
                     end_date: dt.date | None) -> DataFrame:
    """Actions with ``date`` in the closed range (either end optional).

    On a table partitioned by ``date`` this prunes partitions.
    """
    cond = F.lit(True)
    if start_date is not None:
        cond = cond & (F.col("date") >= F.lit(start_date))
    if end_date is not None:
        cond = cond & (F.col("date") <= F.lit(end_date))
    return actions.where(cond)


def session_aggregate(actions: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """B1: one row per session, joined (inner) with the user's attributes.

    Columns: session_id, user_id, search_keywords (sorted distinct
    array<string>), click_category_ids (sorted distinct array<bigint>),
    start_time, end_time (TIMESTAMP_NTZ), visit_length (s), step_length,
    and age, professional, city, sex when ``users`` is given.

    Two levels: one row per (session, keyword, category) with its counts and
    times, dealt out by all three, so a hot session is split over tasks; then
    one row a session from these. The sets hold a session's distinct
    keywords, so a row is as large as these; to filter or count sessions use
    :func:`session_facts`, which keeps none.
    """
    rows = actions.select(
        "session_id", "user_id", action_timestamp(actions).alias("t"),
        F.when(not_empty("search_keyword"), F.col("search_keyword")).alias("kw"),
        F.col("click_category_id").alias("cat"))
    # first one row a session and value, so that the lists are built from distinct values only
    values = rows.groupBy("session_id", "kw", "cat").agg(
        F.min("user_id").alias("user_id"), F.min("t").alias("start_time"),
        F.max("t").alias("end_time"), F.count(F.lit(1)).alias("n"))
    sessions = (
        values.groupBy("session_id")
        .agg(F.min("user_id").alias("user_id"),
             F.array_sort(F.collect_set("kw")).alias("search_keywords"),
             F.array_sort(F.collect_set("cat")).alias("click_category_ids"),
             F.min("start_time").alias("start_time"),
             F.max("end_time").alias("end_time"),
             F.sum("n").alias("step_length"))
        .withColumn("visit_length",
                    F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time")))
    )
    if users is None:
        return sessions
    return sessions.join(users.select("user_id", "age", "professional", "city", "sex"),
                         "user_id")


def session_facts(actions: DataFrame, users: DataFrame | None, params: TaskParams) -> DataFrame:
    """B1 + B2 without the sets: one row per session that passes the filters.

    The set filters (P3, P4) need only a flag per session, so the aggregate
    keeps fixed-size buffers (hash aggregate with partial sums) however many
    distinct keywords a session has. Columns as :func:`session_aggregate`
    but the two lists; :func:`with_lists` adds those for the rows of a report.
    """
    t = action_timestamp(actions)
    flags = []
    if params.keywords:
        flags.append(F.bool_or(F.col("search_keyword").isin(list(params.keywords)))
                     .alias("_keyword"))
    if params.category_ids:
        flags.append(F.bool_or(F.col("click_category_id").isin(list(params.category_ids)))
                     .alias("_category"))
    sessions = (actions.withColumn("_t", t).groupBy("session_id")
                .agg(F.min("user_id").alias("user_id"), F.min("_t").alias("start_time"),
                     F.max("_t").alias("end_time"), F.count(F.lit(1)).alias("step_length"),
                     *flags)
                .withColumn("visit_length", F.timestamp_diff(
                    "SECOND", F.col("start_time"), F.col("end_time"))))
    for flag in ("_keyword", "_category"):
        if flag in sessions.columns:
            sessions = sessions.where(F.coalesce(flag, F.lit(False))).drop(flag)
    if users is not None:
        sessions = sessions.join(users.select("user_id", "age", "professional", "city", "sex"),
                                 "user_id")
    return sessions.where(user_condition(params))


def with_lists(sessions: DataFrame, actions: DataFrame) -> DataFrame:
    """The sorted distinct keyword and category lists of the given sessions only.

    Values are deduplicated per session by a hash aggregate before they are
    collected, and only for the sessions of the report (pass stored ones).
    """
    text = F.when(not_empty("search_keyword"), F.col("search_keyword"))
    mine = actions.select("session_id", text.alias("kw"), F.col("click_category_id").alias("cat")) \
        .join(sessions.select("session_id"), "session_id", "left_semi")
    pairs = mine.distinct()
    lists = pairs.groupBy("session_id").agg(
        F.array_sort(F.collect_set("kw")).alias("search_keywords"),
        F.array_sort(F.collect_set("cat")).alias("click_category_ids"))
    return sessions.join(lists, "session_id")


def user_condition(params: TaskParams) -> Column:
    """The predicates on the session's user."""
    return session_filter_condition(params, sets=False)


def session_filter_condition(params: TaskParams, sets: bool = True) -> Column:
    """P1-P4 as one conjunction; an unset parameter adds no predicate.

    ``sets=False`` leaves out the keyword and category lists.
    """
    conds: list[Column] = []
    if params.start_age is not None and params.end_age is not None:
        conds.append(F.col("age").between(params.start_age, params.end_age))
    if params.professionals:
        conds.append(F.col("professional").isin(list(params.professionals)))
    if params.cities:
        conds.append(F.col("city").isin(list(params.cities)))
    if params.sex is not None:
        conds.append(F.col("sex") == F.lit(params.sex))
    if sets and params.keywords:
        conds.append(F.arrays_overlap(
            "search_keywords", F.array(*[F.lit(k) for k in params.keywords])))
    if sets and params.category_ids:
        conds.append(F.arrays_overlap(
            "click_category_ids",
            F.array(*[F.lit(c).cast("bigint") for c in params.category_ids])))
    return reduce(lambda a, b: a & b, conds, F.lit(True))


def filter_sessions(sessions: DataFrame, params: TaskParams) -> DataFrame:
    """B2: sessions passing every set parameter."""
    return sessions.where(session_filter_condition(params))


def _bucket(c: Column, lo: int, hi: int | None) -> Column:
    return c >= lo if hi is None else c.between(lo, hi)


def session_stats(filtered: DataFrame) -> DataFrame:
    """B3 (A2 + A3): session count and the share of each length bucket.

    One global aggregate of conditional counts; ratios are rounded
    half-up to two digits. No sessions -> count 0 and null ratios.
    """
    v, s = F.col("visit_length"), F.col("step_length")
    counts = filtered.agg(
        F.count(F.lit(1)).alias("session_count"),
        *[F.count_if(_bucket(v, lo, hi)).alias(name) for name, lo, hi in VISIT_BUCKETS],
        *[F.count_if(_bucket(s, lo, hi)).alias(name) for name, lo, hi in STEP_BUCKETS],
    )
    names = [b[0] for b in VISIT_BUCKETS + STEP_BUCKETS]
    return counts.select(
        "session_count",
        *[ratio_half_up(name, "session_count").alias(name) for name in names])


def session_detail(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """The actions of the given sessions (semi join on session_id).

    AQE splits a hot session's actions only when both sides come straight
    from a shuffle, so pass stored ``sessions``, not ones aggregated in the
    same plan.
    """
    return actions.join(sessions.select("session_id"), "session_id", "left_semi")
