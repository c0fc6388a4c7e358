"""Top categories/sessions, funnel, products, sampling on hand-made rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window, functions as F

from helpers import action, actions_df, secs
from visitlens.operators import categories as C
from visitlens.operators import funnel as FN
from visitlens.operators import products as PR
from visitlens.operators import sampling as SA
from visitlens.operators import sessions as S
from visitlens.operators.sequence import previous_in_sequence


def test_category_counts_kinds_and_duplicates(spark):
    rows = [action("a", 1, secs(0), click_cat=5),
            action("a", 1, secs(1), order_cats="5,6,5"),
            action("a", 1, secs(2), pay_cats="6"),
            action("b", 2, secs(0), order_cats=""),
            action("b", 2, secs(1), click_cat=7, pay_cats="7,,x")]
    got = {r.category_id: (r.click_count, r.order_count, r.pay_count)
           for r in C.category_counts(actions_df(spark, rows)).collect()}
    assert got == {5: (1, 2, 0), 6: (0, 1, 1), 7: (1, 0, 1)}


def test_top_categories_order_and_tie_break(spark):
    rows = []
    # categories 1..12: clicks 3 for 1-4 (tie), then fewer; order count breaks some ties
    for cat in range(1, 13):
        for i in range(3 if cat <= 4 else 1):
            rows.append(action(f"s{cat}_{i}", 1, secs(i), click_cat=cat))
    rows.append(action("x", 1, secs(9), order_cats="3"))
    got = [r.category_id for r in C.top_categories(actions_df(spark, rows), 10).collect()]
    assert got == [3, 1, 2, 4, 5, 6, 7, 8, 9, 10]


def test_top_sessions_ties_at_rank_10(spark):
    rows = []
    for s in range(12):
        clicks = 2 if s < 11 else 1
        rows += [action(f"s{s:02d}", 1, secs(j), click_cat=4) for j in range(clicks)]
    detail = actions_df(spark, rows)
    top = C.top_categories(detail, 10)
    got = C.top_sessions_per_category(detail, top, 10).orderBy("session_id").collect()
    assert [r.session_id for r in got] == [f"s{s:02d}" for s in range(10)]
    assert {r.click_count for r in got} == {2}


def _funnel(spark, pages, flow):
    rows = [action("a", 1, secs(i), page_id=p) for i, p in enumerate(pages)]
    return {r.page_slice: (r.step, r.slice_pv, r.convert_rate)
            for r in FN.page_conversion(actions_df(spark, rows), flow).collect()}


def test_funnel_rates_and_missing_slice(spark):
    got = _funnel(spark, [1, 2, 3, 1, 2, 9], (1, 2, 3, 4))
    assert got == {"1_2": (1, 2, 1.0), "2_3": (2, 1, 0.5), "3_4": (3, 0, 0.0)}


def test_funnel_start_page_without_views(spark):
    got = _funnel(spark, [2, 3], (1, 2, 3))
    assert got == {"1_2": (1, 0, None), "2_3": (2, 1, None)}


def test_funnel_repeated_slice_counts_once_per_pair(spark):
    # flow 1,2,1,2 lists 1_2 twice: reported once, with its last step and rate
    got = _funnel(spark, [1, 2, 1, 2], (1, 2, 1, 2))
    assert got == {"2_1": (2, 1, 0.5), "1_2": (3, 2, 2.0)}


def test_funnel_orders_by_time_then_event_id(spark):
    rows = [action("a", 1, "5:00:01", page_id=2, event_id=5),
            action("a", 1, "5:00:00", page_id=1, event_id=9),
            action("a", 1, "5:00:01", page_id=3, event_id=7)]
    got = {r.page_slice: r.slice_pv for r in
           FN.page_conversion(actions_df(spark, rows), (1, 2, 3)).collect()}
    assert got == {"1_2": 1, "2_3": 1}


@pytest.mark.parametrize("chunks", [1, 3, 16])
def test_previous_in_sequence_matches_window_lag_with_hot_key(spark, chunks):
    rnd = random.Random(chunks)
    rows = [(0 if rnd.random() < 0.6 else rnd.randint(1, 30), rnd.randint(0, 50), i,
             rnd.choice([None, 1, 2, 3])) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, t long, id long, v long")
    a = previous_in_sequence(df, "k", ["t", "id"], "v", "p", bucket_seconds=chunks)
    b = df.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("t", "id")))
    assert a.count() == 3000
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("aqe,reuse", [("true", "true"), ("false", "true"), ("true", "false")])
def test_lag_of_a_wide_frame_needs_no_exchange_reuse(spark, aqe, reuse):
    """400,000 rows, 60 % on one key, a column more than the lag needs."""
    df = spark.range(400_000).select(
        F.when(F.col("id") % 5 < 3, F.lit("hot")).otherwise(
            F.concat(F.lit("s"), (F.col("id") % 997).cast("string"))).alias("k"),
        F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(90_000))).cast("timestamp_ntz")
        .alias("t"), F.col("id"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(50)).alias("v"),
        F.sha2(F.col("id").cast("string"), 256).alias("wide"))
    conf = {"spark.sql.adaptive.enabled": aqe, "spark.sql.exchange.reuse": reuse,
            "spark.sql.shuffle.partitions": "16"}
    old = {c: spark.conf.get(c) for c in conf}
    try:
        for c, v in conf.items():
            spark.conf.set(c, v)
        ours = previous_in_sequence(df, "k", ["t", "id"], "v", "p")
        plain = df.withColumn("q", F.lag("v").over(Window.partitionBy("k").orderBy("t", "id")))
        both = ours.select("id", "p", "wide").join(plain.select("id", "q"), "id")
        assert both.agg(F.count("*"), F.count_if(~F.col("p").eqNullSafe(F.col("q")))).first() \
            == (400_000, 0)
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_area_top_products_ties_status_and_levels(spark):
    cities = spark.createDataFrame([(1, "c1", "华北"), (2, "c2", "西南"), (3, "c3", "X")],
                                   "city_id long, city_name string, area string")
    products = spark.createDataFrame(
        [(10, "p10", '{"product_status": 0}'), (11, "p11", '{"product_status": 1}'),
         (12, "p12", "broken"), (13, "p13", '{"product_status": "0"}')],
        "product_id long, product_name string, extend_info string")
    rows = []
    for prod, n in [(10, 3), (11, 3), (12, 3), (13, 3), (99, 9)]:   # 99 has no product row
        rows += [action("s", 1, secs(j), click_prod=prod, city_id=1 + j % 2) for j in range(n)]
    rows.append(action("t", 1, secs(0), click_prod=10, city_id=3))
    got = PR.area_top_products(actions_df(spark, rows), cities, products, 3).collect()
    by_area = {}
    for r in got:
        by_area.setdefault(r.area, []).append(
            (r.product_id, r.click_count, r.city_infos, r.product_status, r.area_level))
    assert by_area["华北"] == [(10, 2, "1:c1", "自营商品", "A级"),
                              (11, 2, "1:c1", "第三方商品", "A级"),
                              (12, 2, "1:c1", "第三方商品", "A级")]
    assert by_area["西南"][0][4] == "C级" and len(by_area["西南"]) == 3
    assert by_area["X"] == [(10, 1, "3:c3", "自营商品", "D级")]


def test_sample_quota_formula(spark):
    # 2 days; day 1: hours 5 (3 sessions) and 6 (1); day 2: hour 5 (4 sessions); n = 4
    d1, d2 = dt.date(2019, 8, 7), dt.date(2019, 8, 8)
    rows = ([action(f"a{i}", i, "5:00:00", day=d1) for i in range(3)]
            + [action("b0", 9, "6:00:00", day=d1)]
            + [action(f"c{i}", i, "5:00:00", day=d2) for i in range(4)])
    sessions = S.session_aggregate(actions_df(spark, rows))
    quotas = {(r.date, r.hour): r.quota for r in
              SA.sample_quotas(SA.session_hour_counts(sessions), 4).collect()}
    # per day 4 // 2 = 2: floor(3/4*2)=1, floor(1/4*2)=0, floor(4/4*2)=2
    assert quotas == {(d1, 5): 1, (d1, 6): 0, (d2, 5): 2}
    sample = SA.sample_sessions(sessions, 4, "seed").collect()
    assert len(sample) == 3
    again = SA.sample_sessions(sessions, 4, "seed").collect()
    assert sorted(r.session_id for r in sample) == sorted(r.session_id for r in again)


def test_sample_with_hot_stratum_is_independent_of_sub_groups(spark):
    d = dt.date(2019, 8, 7)
    rows = ([action(f"h{i}", i, "5:00:00", day=d) for i in range(300)]          # hot hour
            + [action(f"o{i}", i, f"{6 + i % 3}:00:00", day=d) for i in range(30)])
    sessions = S.session_aggregate(actions_df(spark, rows))
    ids = lambda g: sorted(r.session_id for r in
                           SA.sample_sessions(sessions, 50, "s", sub_groups=g).collect())
    one = ids(1)
    assert len(one) == 48 and ids(7) == one and ids(64) == one


def test_click_with_unknown_city_is_dropped(spark):
    cities = spark.createDataFrame([(1, "c1", "A")], "city_id long, city_name string, area string")
    rows = [action("s", 1, secs(0), click_prod=10, city_id=1),
            action("s", 1, secs(1), click_prod=10, city_id=9),     # no such city
            action("s", 1, secs(2), city_id=1)]                    # not a click
    basic = PR.click_product_basic(PR.click_actions(actions_df(spark, rows)), cities)
    got = [(r.area, r.product_id, r.click_count, r.city_infos)
           for r in PR.area_product_clicks(basic).collect()]
    assert got == [("A", 10, 1, "1:c1")]
