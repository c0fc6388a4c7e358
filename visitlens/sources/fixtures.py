"""Derive the analysis inputs from the driver's tables (FIXTURES.md §2).

``k`` is the integer ``props.k`` of an event. Every expression here has
an equal DuckDB form in :mod:`visitlens.plans.oracle`; both are time-zone
free (``events.ts`` is TIMESTAMP_NTZ).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from visitlens.functions.columns import epoch_millis


def _k() -> F.Column:
    return F.get_json_object("props", "$.k").try_cast("bigint")


def _ts_range(events: DataFrame, start_date: dt.date | None,
              end_date: dt.date | None) -> DataFrame:
    # Plain comparisons on the raw column reach the Parquet reader as
    # PushedFilters (row-group skipping); the exact date filter follows.
    if start_date is not None:
        events = events.where(F.col("ts") >= F.lit(dt.datetime.combine(start_date, dt.time())))
    if end_date is not None:
        nxt = dt.datetime.combine(end_date + dt.timedelta(days=1), dt.time())
        events = events.where(F.col("ts") < F.lit(nxt))
    return events


def user_visit_action(events: DataFrame, start_date: dt.date | None = None,
                      end_date: dt.date | None = None) -> DataFrame:
    """One visit action per event; a session is one user's day."""
    ev = _ts_range(events, start_date, end_date).select(
        "event_id", "ts", "user_id", "event_type", _k().alias("k"))
    day = F.date_format("ts", "yyyy-MM-dd")
    k, eid, etype = F.col("k"), F.col("event_id"), F.col("event_type")
    return ev.select(
        F.to_date("ts").alias("date"),
        "user_id",
        F.concat(F.col("user_id").cast("string"), F.lit("-"), day).alias("session_id"),
        (k % 10).alias("page_id"),
        F.concat(day, F.lit(" "),
                 F.lpad((F.col("user_id") % 24).cast("string"), 2, "0"), F.lit(":"),
                 F.date_format("ts", "mm"), F.lit(":"),
                 F.date_format("ts", "ss")).alias("action_time"),
        F.when(etype == "view", F.concat(F.lit("kw"), (k % 10).cast("string")))
         .alias("search_keyword"),
        F.when(etype == "click", k).alias("click_category_id"),
        F.when(etype == "click", eid % 200).alias("click_product_id"),
        F.when(etype == "signup", F.concat(k.cast("string"), F.lit(","),
                                           ((k + eid) % 100).cast("string")))
         .alias("order_category_ids"),
        F.when(etype == "signup", (eid % 200).cast("string")).alias("order_product_ids"),
        F.when(etype == "purchase", k.cast("string")).alias("pay_category_ids"),
        F.when(etype == "purchase", (eid % 200).cast("string")).alias("pay_product_ids"),
        (eid % 25).alias("city_id"),
        "event_id",
        # the same instant as action_time, built by arithmetic (no parsing)
        F.make_timestamp_ntz(F.year("ts"), F.month("ts"), F.dayofmonth("ts"),
                             (F.col("user_id") % 24).cast("int"), F.minute("ts"),
                             F.second("ts")).alias("action_ts"),
    )


def user_info(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    return customer.select(
        key.alias("user_id"),
        F.col("c_name").alias("username"),
        F.col("c_name").alias("name"),
        (key % 60).cast("int").alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.concat(F.lit("city"), F.col("c_nationkey").cast("string")).alias("city"),
        F.when(key % 2 == 0, F.lit("male")).otherwise(F.lit("female")).alias("sex"),
    )


def product_info(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat(F.lit('{"product_status": '), (F.col("p_size") % 2).cast("string"),
                 F.lit("}")).alias("extend_info"),
    )


def city_info(nation: DataFrame, region: DataFrame) -> DataFrame:
    """25 nations x 5 regions: fixed-size dimension, broadcast is bounded."""
    return (nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
            .select(F.col("n_nationkey").cast("bigint").alias("city_id"),
                    F.col("n_name").alias("city_name"),
                    F.col("r_name").alias("area")))


def ad_log(events: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Ad click log lines ``<epoch ms>_<province>_<city>_<user>_<ad>``.

    Province is the region name, city the nation name without '_' (the
    log delimiter); the nation is ``event_id % 25``. Every fifth user clicks
    ad 0 only, so its clicks on one ad a day do not depend on the scale.
    """
    places = (nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
              .select(F.col("n_nationkey").cast("bigint").alias("nation_key"),
                      F.col("r_name").alias("province"),
                      F.regexp_replace("n_name", "_", "").alias("city")))
    ev = events.select("event_id", "ts", "user_id", _k().alias("k"),
                       (F.col("event_id") % 25).alias("nation_key"))
    joined = ev.join(F.broadcast(places), "nation_key")
    return joined.select(
        F.concat_ws("_", epoch_millis("ts").cast("string"), F.col("province"),
                    F.col("city"), F.col("user_id").cast("string"),
                    F.when(F.col("user_id") % 5 == 0, F.lit(0)).otherwise(F.col("k") % 10)
                    .cast("string")).alias("value"),
        F.col("event_id"),
    )
