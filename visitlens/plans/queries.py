"""Registered queries: ``(spark, sf_dir) -> DataFrame`` over the test tables.

Each builds the fixture inputs from the driver's tables, runs one
operator of the library and formats arrays/times as text so the result
compares column-for-column with the DuckDB oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from visitlens.functions.columns import (bad_action_time, date_hour_key, format_time,
                                         minute_key)
from visitlens.operators import ads as AD
from visitlens.operators import categories as C
from visitlens.operators import funnel as FN
from visitlens.operators import products as PR
from visitlens.operators import sampling as SA
from visitlens.operators import skew as SK
from visitlens.operators import sessions as S
from visitlens.params import params_from_task
from visitlens.plans import jobs as J
from visitlens.plans import params as P
from visitlens.plans import sql as SQL
from visitlens.sources import fixtures
from visitlens.sources.adlog import decode_ad_log, parse_ad_log
from visitlens.sinks.deltas import DeltaStore
from visitlens.sources.tables import Tables, read_log, write_partitioned
from visitlens.session import materialize, scratch_dir
from visitlens.streaming import ad_stream as STR


class Inputs:
    """Fixture views over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.t = Tables(spark, sf_dir)

    def actions(self) -> DataFrame:
        lo, hi = P.DATE_RANGE
        return S.actions_in_range(fixtures.user_visit_action(self.t.events, lo, hi), lo, hi)

    def users(self) -> DataFrame:
        return fixtures.user_info(self.t.customer)

    def products(self) -> DataFrame:
        return fixtures.product_info(self.t.part)

    def cities(self) -> DataFrame:
        return fixtures.city_info(self.t.nation, self.t.region)

    def ad_clicks(self) -> DataFrame:
        return decode_ad_log(fixtures.ad_log(self.t.events, self.t.nation, self.t.region))[0]

    def sessions(self) -> DataFrame:
        return S.session_aggregate(self.actions(), self.users())

    def filtered(self) -> DataFrame:
        """Sessions passing the filters, without their lists."""
        return S.session_facts(self.actions(), self.users(), P.SESSION_PARAMS)

    def stored_filtered(self) -> DataFrame:
        """As :meth:`filtered`, stored: joins with the log can then split a hot session."""
        return materialize(self.filtered(), "filtered-sessions")

    def detail(self) -> DataFrame:
        return S.session_detail(self.actions(), self.stored_filtered())

    def stored_detail(self) -> DataFrame:
        """The filtered sessions' actions, stored for a chain of reports: the log is
        read twice in all, whatever reads the detail."""
        return materialize(self.detail(), "session-detail")


def session_text(df: DataFrame) -> DataFrame:
    """Arrays and times of a session row as text."""
    return df.select(
        "session_id", "user_id",
        F.array_join("search_keywords", ",").alias("search_keywords"),
        F.array_join("click_category_ids", ",").alias("click_category_ids"),
        format_time("start_time").alias("start_time"),
        "visit_length", "step_length",
        *[c for c in ("age", "professional", "city", "sex") if c in df.columns])


def q_session_aggregate(spark, sf_dir):
    return session_text(Inputs(spark, sf_dir).sessions())


def q_session_filter(spark, sf_dir):
    inp = Inputs(spark, sf_dir)
    found = materialize(S.session_facts(inp.actions(), inp.users(), P.FILTER_PARAMS),
                        "filtered-sessions")
    return session_text(S.with_lists(found, inp.actions()))


def q_session_stats(spark, sf_dir):
    return S.session_stats(Inputs(spark, sf_dir).filtered())


def q_top10_category(spark, sf_dir):
    return C.top_categories(Inputs(spark, sf_dir).detail(), P.TOP_CATEGORIES)


def _top_sessions(detail: DataFrame) -> DataFrame:
    top = C.top_categories(detail, P.TOP_CATEGORIES)
    return C.top_sessions_per_category(detail, top, P.TOP_SESSIONS)


def q_top10_session(spark, sf_dir):
    return _top_sessions(Inputs(spark, sf_dir).stored_detail())


def q_top10_session_detail(spark, sf_dir):
    detail = Inputs(spark, sf_dir).stored_detail()
    return C.tagged_detail(detail, materialize(_top_sessions(detail), "top-sessions"),
                           ["category_id"])


def q_page_conversion(spark, sf_dir):
    return FN.page_conversion(Inputs(spark, sf_dir).actions(), P.TARGET_PAGE_FLOW)


def _click_basic(inp: Inputs) -> DataFrame:
    return PR.click_product_basic(PR.click_actions(inp.actions(), keep=("event_id",)),
                                  inp.cities())


def q_area_product_clicks(spark, sf_dir):
    return PR.area_product_clicks(_click_basic(Inputs(spark, sf_dir)))


def q_area_top3_product(spark, sf_dir):
    inp = Inputs(spark, sf_dir)
    full = PR.with_product_info(PR.area_product_clicks(_click_basic(inp)), inp.products())
    return PR.top_products_per_area(full, P.TOP_PRODUCTS)


def q_area_level_top3(spark, sf_dir):
    """P10 with levels for the test tables' own areas."""
    inp = Inputs(spark, sf_dir)
    full = PR.with_product_info(PR.area_product_clicks(_click_basic(inp)), inp.products())
    return PR.top_products_per_area(full, P.TOP_PRODUCTS, P.REGION_LEVELS)


def q_sql_area_top3_product(spark, sf_dir):
    """B8 by the SQL route: temp views and one statement."""
    inp = Inputs(spark, sf_dir)
    SQL.register_views(spark, inp.actions(), inp.users(), inp.products(), inp.cities())
    return spark.sql(SQL.area_top3_sql(*(d.isoformat() for d in P.DATE_RANGE), P.TOP_PRODUCTS))


def q_sql_ad_province_top3(spark, sf_dir):
    """R6 by the SQL route, over all clicks."""
    inp = Inputs(spark, sf_dir)
    SQL.register_views(spark, inp.actions(), inp.users(), inp.products(), inp.cities(),
                       inp.ad_clicks())
    return spark.sql(SQL.province_top3_sql(3))


def q_salted_area_product(spark, sf_dir):
    return SK.salted_area_product_clicks(_click_basic(Inputs(spark, sf_dir)), P.SALT_BUCKETS)


def q_skew_join_product(spark, sf_dir):
    """Clicks joined to products with a salted join, then counted."""
    inp = Inputs(spark, sf_dir)
    prod = inp.products().select("product_id", "product_name",
                                 PR.product_status("extend_info").alias("product_status"))
    joined = SK.skew_join(_click_basic(inp), prod, "product_id", P.SALT_BUCKETS, ["event_id"])
    return (joined.groupBy("area", "product_id", "product_name", "product_status")
            .agg(F.count(F.lit(1)).alias("click_count")))


def q_session_hour_counts(spark, sf_dir):
    return SA.session_hour_counts(Inputs(spark, sf_dir).filtered())


def q_session_hour_keys(spark, sf_dir):
    """sessions per date-hour key, with the first and last minute key of the hour."""
    start = F.col("start_time")
    return (Inputs(spark, sf_dir).filtered().groupBy(date_hour_key("start_time").alias("hour_key"))
            .agg(F.count(F.lit(1)).alias("sessions"),
                 F.min(minute_key(start)).alias("first_minute"),
                 F.max(minute_key(start)).alias("last_minute")))


def _sample(inp: Inputs) -> DataFrame:
    """The drawn sessions, stored (at most the sample's size)."""
    return materialize(SA.sample_sessions(inp.stored_filtered(), P.SAMPLE_SIZE, P.SAMPLE_SEED),
                       "sample")


def q_session_sample(spark, sf_dir):
    inp = Inputs(spark, sf_dir)
    return session_text(S.with_lists(_sample(inp), inp.actions())).select(
        "session_id", "start_time", "search_keywords", "click_category_ids")


def q_session_sample_detail(spark, sf_dir):
    inp = Inputs(spark, sf_dir)
    return C.tagged_detail(inp.actions(), _sample(inp), [])


def q_category_counts(spark, sf_dir):
    return C.category_counts(Inputs(spark, sf_dir).detail())


def q_session_detail(spark, sf_dir):
    from visitlens.schemas import DETAIL_COLUMNS
    return Inputs(spark, sf_dir).detail().select(*DETAIL_COLUMNS, "event_id")


def q_session_sample_quotas(spark, sf_dir):
    return SA.sample_quotas(SA.session_hour_counts(Inputs(spark, sf_dir).filtered()),
                            P.SAMPLE_SIZE)


def q_page_transitions(spark, sf_dir):
    return FN.page_transitions(Inputs(spark, sf_dir).actions()).select(
        "session_id", "event_id", "page_id", "prev_page")


CLICK_COLS = ["ts_ms", "date", "province", "city", "user_id", "ad_id"]


def q_ad_user_click_count(spark, sf_dir):
    return AD.user_ad_click_counts(Inputs(spark, sf_dir).ad_clicks())


def _blacklist(clicks: DataFrame) -> DataFrame:
    return AD.blacklist_users(AD.user_ad_click_counts(clicks), P.BLACKLIST_THRESHOLD)


def q_ad_blacklist(spark, sf_dir):
    return _blacklist(Inputs(spark, sf_dir).ad_clicks())


def _filtered_clicks(inp: Inputs) -> DataFrame:
    clicks = inp.ad_clicks()
    return AD.filter_blacklisted(clicks, materialize(_blacklist(clicks), "blacklist"))


def q_ad_filtered(spark, sf_dir):
    return _filtered_clicks(Inputs(spark, sf_dir)).select(*CLICK_COLS)


def q_ad_stat(spark, sf_dir):
    return AD.ad_stat(_filtered_clicks(Inputs(spark, sf_dir)))


def q_ad_province_top3(spark, sf_dir):
    return AD.province_top_ads(AD.ad_stat(_filtered_clicks(Inputs(spark, sf_dir))), 3)


def q_ad_click_trend(spark, sf_dir):
    return AD.minute_trend(Inputs(spark, sf_dir).ad_clicks())


def q_ad_trend_sliding(spark, sf_dir):
    return AD.sliding_trend(Inputs(spark, sf_dir).ad_clicks(), 3600, 600)


def q_ad_trend_peak_10s(spark, sf_dir):
    """R7 at 60 minutes every 10 seconds: each ad's busiest window of a day."""
    counts = AD.slide_counts(Inputs(spark, sf_dir).ad_clicks(), 10)
    return AD.peak_windows(AD.window_steps(counts, 3600, 10), 10)


def _ad_log_files(spark: SparkSession, sf_dir: str) -> str:
    """The derived ad log as text files (one line per click), by day of the click.

    Tasks hold ranges of event ids, which grow with time; their number
    follows the session's shuffle partitions, not a constant.
    """
    t = Tables(spark, sf_dir)
    path = scratch_dir(spark, "adlog")
    log = fixtures.ad_log(t.events, t.nation, t.region)
    (log.withColumn("day", F.date_from_unix_date(F.floor(
        F.substring_index("value", "_", 1).cast("bigint") / 86_400_000).cast("int")))
     .repartitionByRange("event_id").select("value", "day")
     .write.mode("overwrite").partitionBy("day").text(path))
    return path


def _replay(spark: SparkSession, path: str, batches: int = 4) -> DataFrame:
    """A stream over the log's files that delivers them in about ``batches`` batches."""
    files = len(spark.read.text(path).inputFiles())
    return spark.readStream.option("maxFilesPerTrigger", max(1, -(-files // batches))) \
        .text(path).select("value")


def _run_ad_stream(spark, sf_dir, threshold: int):
    root = scratch_dir(spark, "ad-stream")
    query, store = STR.start_ad_stream(
        spark, _replay(spark, _ad_log_files(spark, sf_dir)), f"{root}/state",
        f"{root}/checkpoint", threshold=threshold, trigger="availableNow")
    query.awaitTermination()
    return store


def q_stream_ad_stat(spark, sf_dir):
    """R1-R5 over several micro-batches; no user has 100 clicks on one ad in a day."""
    return STR.read_table(_run_ad_stream(spark, sf_dir, threshold=100), "ad_stat")


def q_stream_ad_user_click_count(spark, sf_dir):
    """R3 running totals per (date, user, ad) after the last micro-batch."""
    return STR.read_table(_run_ad_stream(spark, sf_dir, threshold=100), "ad_user_click_count")


def q_stream_ad_province_top3(spark, sf_dir):
    return STR.read_table(_run_ad_stream(spark, sf_dir, threshold=100), "ad_province_top3")


def q_stream_ad_blacklist(spark, sf_dir):
    """R4 feedback loop over several micro-batches; the final set is order-free."""
    return STR.read_table(_run_ad_stream(spark, sf_dir, threshold=P.BLACKLIST_THRESHOLD),
                          "ad_blacklist")


def _run_batches(spark, sf_dir, parts: list[Column], start: Callable) -> DeltaStore:
    """Run a stream that gets one part of the ad log after another, a micro-batch each.

    ``parts`` select rows by ``event_id`` and ``day``. The stream is stopped and
    restarted on its checkpoint for each, so a batch is exactly what arrived
    before it.
    """
    t = Tables(spark, sf_dir)
    log = fixtures.ad_log(t.events, t.nation, t.region).withColumn(
        "day", F.date_from_unix_date(F.floor(
            F.substring_index("value", "_", 1).cast("bigint") / 86_400_000).cast("int")))
    root = scratch_dir(spark, "batches")
    for part in parts:
        log.where(part).select("value").write.mode("append").text(f"{root}/log")
        query, store = start(spark.readStream.text(f"{root}/log"), f"{root}/state",
                             f"{root}/checkpoint")
        query.awaitTermination()
    return store


def _by_days() -> list[Column]:
    """Three batches of days."""
    day, (first, second) = F.col("day"), (F.lit(d).cast("date") for d in P.FEEDBACK_DAYS)
    return [day <= first, (day > first) & (day <= second), day > second]


def _with_stragglers() -> list[Column]:
    """The batches of days, but every fourth click comes one batch later."""
    on_time, days = F.col("event_id") % 4 != 0, _by_days()
    return [(days[0] & on_time), (days[1] & on_time) | (days[0] & ~on_time),
            (days[2] & on_time) | (days[1] & ~on_time), days[2] & ~on_time]


def q_stream_ad_click_trend(spark, sf_dir):
    """Watermarked 1-minute windows over four batches, update mode: clicks that come a
    batch later update their minute's row, and the latest row per minute counts."""
    store = _run_batches(spark, sf_dir, _with_stragglers(), lambda lines, state, checkpoint:
                         STR.start_trend_stream(spark, lines, state, checkpoint,
                                                P.TREND_WATERMARK, "availableNow"))
    return STR.read_table(store, "ad_click_trend")


def q_stream_ad_lateness(spark, sf_dir):
    """Clicks on time and late per day, over batches whose stragglers are partly behind
    the watermark, and what the minute trend of the clicks on time holds."""
    store = _run_batches(spark, sf_dir, _with_stragglers(), lambda lines, state, checkpoint:
                         STR.start_late_stream(spark, lines, state, checkpoint,
                                               P.LATE_DELAY_MS, "availableNow"))
    trend = STR.read_table(store, "ad_click_trend").groupBy("date").agg(
        F.count(F.lit(1)).alias("trend_rows"), F.sum("click_count").alias("trend_clicks"))
    return STR.read_table(store, "ad_lateness").join(trend, "date", "left").select(
        "date", "on_time", "late", F.coalesce("trend_rows", F.lit(0)).alias("trend_rows"),
        F.coalesce("trend_clicks", F.lit(0)).alias("trend_clicks"))


def q_stream_ad_peak_10s(spark, sf_dir):
    """R7 at 60 minutes every 10 seconds over a stream: counts per 10 seconds in the state
    store, updated by stragglers; each ad's busiest window of a day."""
    store = _run_batches(spark, sf_dir, _with_stragglers(), lambda lines, state, checkpoint:
                         STR.start_sliding_stream(spark, lines, state, checkpoint, 10,
                                                  P.TREND_WATERMARK, "availableNow"))
    counts = STR.read_table(store, "ad_click_bucket")
    return AD.peak_windows(AD.window_steps(counts, 3600, 10), 10)


def q_stream_ad_crossing(spark, sf_dir):
    """R4 in the state store: the (date, user, ad) that reach the threshold, each emitted once."""
    root = scratch_dir(spark, "crossing-stream")
    query, store = STR.start_crossing_stream(
        spark, _replay(spark, _ad_log_files(spark, sf_dir), 3), f"{root}/state",
        f"{root}/checkpoint", P.BLACKLIST_THRESHOLD, "60 days", "availableNow")
    query.awaitTermination()
    return STR.read_table(store, "ad_crossing").select("date", "user_id", "ad_id")


def q_stream_ad_stat_stateful(spark, sf_dir):
    """R5 in the engine's state store, upserted over several micro-batches (K3)."""
    root = scratch_dir(spark, "stat-stream")
    query, store = STR.start_stat_stream(
        spark, _replay(spark, _ad_log_files(spark, sf_dir)), f"{root}/state",
        f"{root}/checkpoint", trigger="availableNow")
    query.awaitTermination()
    return STR.read_table(store, "ad_stat_state")


def q_stream_feedback_stat(spark, sf_dir):
    """Totals after the blacklist feedback over three batches of days."""
    store = _run_batches(spark, sf_dir, _by_days(), lambda lines, state, checkpoint:
                         STR.start_ad_stream(spark, lines, state, checkpoint,
                                             P.BLACKLIST_THRESHOLD, "availableNow"))
    return STR.read_table(store, "ad_stat")


def stored_log_range(spark, sf_dir) -> DataFrame:
    """The action log stored by day, a date range of it."""
    path = scratch_dir(spark, "action-log")
    write_partitioned(fixtures.user_visit_action(Tables(spark, sf_dir).events), path)
    return S.actions_in_range(read_log(spark, path), *P.LOG_RANGE)


def q_stored_log_range(spark, sf_dir):
    """S1 on the log stored by day: actions, sessions and pages of each day in the range."""
    return (stored_log_range(spark, sf_dir).groupBy("date", "session_id", "page_id")
            .agg(F.count(F.lit(1)).alias("n"))
            .groupBy("date", "page_id").agg(F.sum("n").alias("actions"),
                                            F.count(F.lit(1)).alias("sessions")))


def q_task_run(spark, sf_dir):
    """Two tasks' page conversion by their rows of a task table, the first run twice."""
    tasks = spark.createDataFrame(P.TASKS, "task_id long, task_param string")
    actions = fixtures.user_visit_action(Tables(spark, sf_dir).events)
    out = scratch_dir(spark, "task-results")
    for task_id in (1, 2, 1):
        J.run_page_conversion(spark, actions, params_from_task(tasks, task_id), out, task_id)
    return spark.read.parquet(f"{out}/page_split_convert_rate").withColumn(
        "task_id", F.col("task_id").cast("bigint"))


def q_reject_counts(spark, sf_dir):
    """Unreadable rows are counted, not fatal: times out of range and no time at all."""
    t = Tables(spark, sf_dir)
    lines = fixtures.ad_log(t.events, t.nation, t.region).select(
        F.when(F.col("event_id") % 97 == 0, F.regexp_replace(
            "value", "^[0-9]+", "9223372036854775807")).otherwise(F.col("value")).alias("value"))
    actions = fixtures.user_visit_action(t.events).select(
        F.when(F.col("event_id") % 89 == 0, F.lit("2024-01-01 25:61:00"))
        .otherwise(F.col("action_time")).alias("action_time"))
    return parse_ad_log(lines).agg(
        F.lit("ad_log").alias("input"), F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~F.col("valid")).alias("rejected")).unionByName(actions.agg(
            F.lit("action_time").alias("input"), F.count(F.lit(1)).alias("n_rows"),
            F.count_if(bad_action_time(actions)).alias("rejected")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "session_aggregate": q_session_aggregate,
    "session_filter": q_session_filter,
    "session_stats": q_session_stats,
    "top10_category": q_top10_category,
    "top10_session": q_top10_session,
    "top10_session_detail": q_top10_session_detail,
    "page_conversion": q_page_conversion,
    "area_product_clicks": q_area_product_clicks,
    "area_top3_product": q_area_top3_product,
    "area_level_top3": q_area_level_top3,
    "sql_area_top3_product": q_sql_area_top3_product,
    "sql_ad_province_top3": q_sql_ad_province_top3,
    "salted_area_product": q_salted_area_product,
    "skew_join_product": q_skew_join_product,
    "session_hour_counts": q_session_hour_counts,
    "session_sample": q_session_sample,
    "session_sample_detail": q_session_sample_detail,
    "category_counts": q_category_counts,
    "session_detail": q_session_detail,
    "session_sample_quotas": q_session_sample_quotas,
    "page_transitions": q_page_transitions,
    "ad_user_click_count": q_ad_user_click_count,
    "ad_blacklist": q_ad_blacklist,
    "ad_filtered": q_ad_filtered,
    "ad_stat": q_ad_stat,
    "ad_province_top3": q_ad_province_top3,
    "ad_click_trend": q_ad_click_trend,
    "ad_trend_sliding": q_ad_trend_sliding,
    "ad_trend_peak_10s": q_ad_trend_peak_10s,
    "stream_ad_stat": q_stream_ad_stat,
    "stream_ad_user_click_count": q_stream_ad_user_click_count,
    "stream_ad_province_top3": q_stream_ad_province_top3,
    "stream_ad_blacklist": q_stream_ad_blacklist,
    "stream_ad_click_trend": q_stream_ad_click_trend,
    "stream_ad_stat_stateful": q_stream_ad_stat_stateful,
    "stream_feedback_stat": q_stream_feedback_stat,
    "stream_ad_lateness": q_stream_ad_lateness,
    "stream_ad_crossing": q_stream_ad_crossing,
    "stream_ad_peak_10s": q_stream_ad_peak_10s,
    "session_hour_keys": q_session_hour_keys,
    "stored_log_range": q_stored_log_range,
    "task_run": q_task_run,
    "reject_counts": q_reject_counts,
}
