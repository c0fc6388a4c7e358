"""Ad click operators, log decoding and the skew helpers."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from visitlens.operators import ads as AD
from visitlens.operators import skew as SK
from visitlens.sinks.deltas import DeltaStore
from visitlens.sources.adlog import decode_ad_log
from visitlens.streaming import ad_stream as STR

T0 = 1704067207179      # 2024-01-01 00:00:07.179 UTC


def _log(spark, lines):
    return spark.createDataFrame([(v,) for v in lines], "value string")


def test_decode_rejects_malformed_lines(spark):
    lines = [f"{T0}_EAST_CITY1_3_7", "garbage", f"{T0}_EAST_CITY1_3", f"x_EAST_C_3_7",
             f"{T0}_EAST_C_3_7_9", None, "9223372036854775807_P_C_1_1", "-5_P_C_1_1"]
    good, bad = decode_ad_log(_log(spark, lines))
    rows = good.collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.ts_ms, r.date, r.province, r.city, r.user_id, r.ad_id) == (
        T0, dt.date(2024, 1, 1), "EAST", "CITY1", 3, 7)
    assert bad.count() == 7


def _clicks(spark, spec):
    """spec: (minute offset, province, city, user, ad) per click."""
    lines = [f"{T0 + m * 60_000}_{p}_{c}_{u}_{a}" for m, p, c, u, a in spec]
    return decode_ad_log(_log(spark, lines))[0]


def test_blacklist_threshold_and_filter(spark):
    spec = [(0, "P", "C", 1, 1)] * 3 + [(0, "P", "C", 2, 1)] * 2 + [(0, "P", "C", 2, 2)]
    clicks = _clicks(spark, spec)
    totals = AD.user_ad_click_counts(clicks)
    black = AD.blacklist_users(totals, 3)
    assert [r.user_id for r in black.collect()] == [1]      # user 2: 2 + 1 on two ads
    left = AD.filter_blacklisted(clicks, black)
    assert sorted(r.user_id for r in left.collect()) == [2, 2, 2]


def test_province_top3_per_date_and_ties(spark):
    spec = ([(0, "P", "C1", 1, 1)] * 4 + [(0, "P", "C2", 1, 2)] * 2 + [(0, "P", "C1", 1, 2)] * 2
            + [(0, "P", "C1", 1, 3)] * 3 + [(0, "P", "C1", 1, 4)] * 3 + [(0, "Q", "C", 1, 9)])
    top = AD.province_top_ads(AD.ad_stat(_clicks(spark, spec)), 3)
    got = [(r.province, r.ad_id, r.click_count) for r in top.orderBy("province", "click_count",
                                                                      "ad_id").collect()]
    assert got == [("P", 3, 3), ("P", 1, 4), ("P", 2, 4), ("Q", 9, 1)]


def test_sliding_trend_equals_spark_window(spark):
    spec = [(m, "P", "C", 1, m % 3) for m in range(0, 200, 7)]
    clicks = _clicks(spark, spec)
    ours = AD.sliding_trend(clicks, 3600, 600)
    t = F.timestamp_millis("ts_ms")
    ref = (clicks.groupBy(F.window(t, "60 minutes", "10 minutes").alias("w"), "ad_id").count()
           .select(F.date_format(F.col("w.start"), "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                   F.date_format(F.col("w.end"), "yyyy-MM-dd HH:mm:ss").alias("window_end"),
                   "ad_id", F.col("count").alias("click_count")))
    assert ours.exceptAll(ref).count() == 0 and ref.exceptAll(ours).count() == 0


def test_window_steps_equal_a_plain_count(spark):
    """Random clicks, gaps, hot ad, null ad, chunks smaller than a window."""
    import random
    rnd = random.Random(5)
    clicks = [(rnd.choice([0, 40, 9000]) + rnd.randint(0, 50), rnd.choice([1, 1, 1, 2, None]))
              for _ in range(300)] + [(17, 1)] * 50
    counts = {}
    for b, a in clicks:
        counts[b, a] = counts.get((b, a), 0) + 1
    df = spark.createDataFrame([(b, a, n) for (b, a), n in counts.items()],
                               "bucket long, ad_id long, click_count long")
    want = {}
    for (b, a), n in counts.items():
        for i in range(6):
            want[b - i, a] = want.get((b - i, a), 0) + n
    for chunk in (20, 70, 100_000):
        steps = AD.window_steps(df, 60, 10, chunk_seconds=chunk).collect()
        got = {(b, r.ad_id): r.click_count for r in steps for b in range(r.bucket, r.until)}
        assert got == want and all(r.click_count > 0 for r in steps)


def test_window_steps_never_copy_a_bucket_per_window(spark):
    """Two rows a bucket, and a hot ad's rows dealt out by time."""
    df = spark.range(20_000).select(F.col("id").alias("bucket"), F.floor(F.col("id") / 1_000_000)
                                    .alias("ad_id"), F.lit(1).cast("long").alias("click_count"))
    steps = AD.window_steps(df, 3600, 10, chunk_seconds=600)
    plan = steps._jdf.queryExecution().executedPlan().toString()
    assert "sequence" not in plan
    assert "hashpartitioning(_key" in plan and "_chunk" in plan
    assert steps.agg(F.sum(F.col("until") - F.col("bucket"))).first()[0] == 20_359


def test_peak_windows_split_steps_at_midnight(spark):
    day = 8640          # slides of 10 seconds
    clicks = [(day - 1, 1, 5), (day + 100, 1, 5), (2 * day + 3, 2, 1)]
    df = spark.createDataFrame(clicks, "bucket long, ad_id long, click_count long")
    got = sorted(map(tuple, AD.peak_windows(AD.window_steps(df, 3600, 10), 10).collect()))
    windows = {}
    for b, a, n in clicks:
        for i in range(360):
            windows[b - i, a] = windows.get((b - i, a), 0) + n
    want = {}
    for (b, a), n in windows.items():
        want[b // day, a] = min(want.get((b // day, a), (0, 0)), (-n, b))
    stamp = lambda b: dt.datetime.fromtimestamp(b * 10, dt.timezone.utc).strftime("%F %T")
    assert got == sorted((stamp(b)[:10], a, -n, stamp(b)) for (_, a), (n, b) in want.items())


def test_minute_trend(spark):
    clicks = _clicks(spark, [(0, "P", "C", 1, 1), (0, "P", "C", 2, 1), (61, "P", "C", 1, 1)])
    got = sorted((r.hour, r.minute, r.click_count) for r in AD.minute_trend(clicks).collect())
    assert got == [("00", "00", 2), ("01", "01", 1)]


def test_salted_aggregate_equals_plain(spark):
    rows = [(i, 1 if i % 3 else (i % 5), f"c{i % 4}", "A" if i % 7 else "B", i % 4)
            for i in range(2000)]
    basic = spark.createDataFrame(rows, "event_id long, product_id long, city_name string, "
                                        "area string, city_id long")
    from visitlens.operators.products import area_product_clicks
    plain = area_product_clicks(basic)
    salted = SK.salted_area_product_clicks(basic, 8)
    assert plain.exceptAll(salted).count() == 0 and salted.exceptAll(plain).count() == 0


def test_skew_join_equals_plain_join(spark):
    big = spark.createDataFrame([(i, 0 if i % 4 else i % 10) for i in range(3000)],
                                "event_id long, k long")
    small = spark.createDataFrame([(k, f"n{k}") for k in range(0, 10, 2)], "k long, name string")
    plain = big.join(small, "k")
    salted = SK.skew_join(big, small, "k", 6, ["event_id"]).select(*plain.columns)
    assert plain.exceptAll(salted).count() == 0 and salted.exceptAll(plain).count() == 0


def test_blacklist_is_a_part_of_the_users_at_every_scale(spark):
    """One threshold: some users blacklisted, most not, and clicks left."""
    from visitlens.plans.queries import QUERIES
    for sf in ("sf0.001", "sf0.01", "sf0.1"):
        where = f"/root/testdata/{sf}"
        users = spark.read.parquet(f"{where}/events.parquet").select("user_id").distinct().count()
        black = QUERIES["ad_blacklist"](spark, where).count()
        assert 0 < black < users / 2
        assert QUERIES["ad_stat"](spark, where).count() > 0


def test_hot_key_joins_are_split(spark):
    """A third of the rows on one key: with stored keys the join is split (skew=true)."""
    from visitlens.operators import sessions as S
    from visitlens.session import materialize
    rows = spark.range(600_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
            F.concat(F.lit("s"), (F.col("id") % 5003).cast("string"))).alias("session_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"),
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 5003).alias("user_id"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    old = {c: spark.conf.get(c) for c in conf}
    try:
        for c, v in conf.items():
            spark.conf.set(c, v)
        keys = materialize(rows.select("session_id").distinct(), "t-sessions")
        users = materialize(rows.where("user_id < 0").select("user_id").distinct(), "t-users")
        for joined in (S.session_detail(rows, keys), AD.filter_blacklisted(rows, users)):
            assert "skew=true" in _final_plan(joined)
        # the stream's filter of a batch: the hot user is one the Bloom filter holds back
        store = DeltaStore(spark, tempfile.mkdtemp(prefix="vl-hot-"), STR.AD_TABLES)
        job = STR.AdStreamJob(store, threshold=1)
        job.process(_log(spark, [f"{T0}_P_C_-1_1"]), 0)
        left = job.not_blacklisted(rows, 1)
        assert "skew=true" in _final_plan(left)
        assert left.where("user_id < 0").count() == 0 and left.count() == 400_000
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def _final_plan(df):
    """The adaptive plan after the frame ran."""
    df._jdf.queryExecution().toRdd().count()
    return df._jdf.queryExecution().executedPlan().toString()
