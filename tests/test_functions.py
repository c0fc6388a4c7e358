"""Column helpers on hand-made edge rows (FIXTURES.md §3)."""

import datetime as dt

from visitlens.functions.columns import (
    concat_long_string, csv_ids, epoch_millis, format_time, group_concat_distinct,
    json_field, ntz_from_millis, parse_action_time, ratio_half_up, register_sql_functions,
    salt)


def test_ratio_half_up_ties_and_zero(spark):
    df = spark.createDataFrame([(29, 200), (31, 200), (1, 3), (2, 3), (0, 5), (5, 0), (7, 7)],
                               "n long, d long")
    got = [r[0] for r in df.select(ratio_half_up("n", "d")).collect()]
    assert got == [0.15, 0.16, 0.33, 0.67, 0.0, None, 1.0]


def test_csv_ids(spark):
    df = spark.createDataFrame([(None,), ("",), ("5",), ("5,6,5",), ("5,,x,7",)], "s string")
    got = [r[0] for r in df.select(csv_ids("s")).collect()]
    assert got == [[], [], [5], [5, 6, 5], [5, 7]]


def test_parse_non_padded_hour(spark):
    df = spark.createDataFrame([("2019-08-07 5:03:02",), ("2019-08-07 15:03:02",)], "s string")
    got = [r[0] for r in df.select(format_time(parse_action_time("s"))).collect()]
    assert got == ["2019-08-07 05:03:02", "2019-08-07 15:03:02"]


def test_json_field(spark):
    rows = [('{"product_status": 0}',), ('{"product_status": "0"}',), ('{"product_status": 1}',),
            ('{"other": 0}',), ("not json",), (None,)]
    df = spark.createDataFrame(rows, "j string")
    got = [r[0] for r in df.select(json_field("j", "product_status")).collect()]
    assert got == ["0", "0", "1", None, None, None]


def test_concat_long_string_null_policy(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (2, None)], "v long, s string")
    got = [r[0] for r in df.select(concat_long_string("v", "s", ":")).collect()]
    assert got == ["1:a", None, None]


def test_group_concat_distinct_keeps_substring_ids(spark):
    df = spark.createDataFrame([("12",), ("1",), ("12",), ("2",)], "c string")
    assert df.agg(group_concat_distinct("c")).first()[0] == "1,12,2"


def test_epoch_millis_roundtrip_is_timezone_free(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 7, 179575),)],
                                   "ts timestamp_ntz")
        row = df.select(epoch_millis("ts").alias("ms")).select(
            "ms", format_time(ntz_from_millis("ms")).alias("back")).first()
        assert row.ms == 1704067207179
        assert row.back == "2024-01-01 00:00:07"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_salt_is_deterministic_and_in_range(spark):
    df = spark.range(1000).select(salt(["id"], 7).alias("s"))
    a = [r[0] for r in df.collect()]
    b = [r[0] for r in df.collect()]
    assert a == b and set(a) == set(range(7))


def test_sql_functions(spark):
    register_sql_functions(spark)
    row = spark.sql("SELECT concat_long_string(3, 'x', ':') AS a, "
                    "get_json_field('{\"product_status\": 0}', 'product_status') AS b, "
                    "salt_bucket('k', 4) BETWEEN 0 AND 3 AS c").first()
    assert (row.a, row.b, row.c) == ("3:x", "0", True)


def test_scratch_dir_is_under_the_checkpoint_dir(spark):
    from visitlens.session import _session_checkpoint_dir, scratch_dir
    base = _session_checkpoint_dir(spark)
    path = scratch_dir(spark, "probe")
    assert base and path.startswith(base.rstrip("/")) and "probe-" in path


def test_partitioned_actions_prune_by_date(spark, tmp_path):
    import datetime as dt
    from conftest import SF_SMALL
    from visitlens.operators.sessions import actions_in_range
    from visitlens.sources import fixtures
    from visitlens.sources.tables import Tables, write_partitioned
    actions = fixtures.user_visit_action(Tables(spark, SF_SMALL).events)
    path = str(tmp_path / "actions")
    write_partitioned(actions, path)
    day = dt.date(2024, 1, 5)
    stored = actions_in_range(spark.read.parquet(path), day, day)
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert stored.count() == actions.where(actions.date == day).count() > 0


def test_cluster_conf_sizes_partitions():
    from visitlens.session import cluster_conf
    conf = cluster_conf(100 << 40, cores=4000)          # 100 TB on 4000 cores
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert int(cluster_conf(1 << 20, cores=8)["spark.sql.shuffle.partitions"]) == 16


def test_time_keys(spark):
    from visitlens.functions.columns import date_hour_key, minute_key, not_empty
    df = spark.createDataFrame([("2019-08-07 5:03:02", ""), ("2019-08-07 15:59:59", "x")],
                               "s string, k string")
    t = parse_action_time("s")
    got = [tuple(r) for r in df.select(date_hour_key(t), minute_key(t), not_empty("k")).collect()]
    assert got == [("2019-08-07_05", "201908070503", False), ("2019-08-07_15", "201908071559", True)]


def test_read_log_formats_roundtrip(spark, tmp_path):
    from helpers import action, actions_df, secs
    from visitlens.schemas import USER_VISIT_ACTION
    from visitlens.sources.tables import read_log
    df = actions_df(spark, [action("a", 1, secs(0), keyword="kw1", order_cats="5,6"),
                            action("b", 2, secs(5), click_cat=3)])
    want = sorted(tuple(r) for r in df.collect())
    for fmt in ("parquet", "orc", "csv", "json"):
        path = str(tmp_path / fmt)
        writer = df.write.format(fmt)
        if fmt == "csv":
            writer = writer.option("header", "true")
        writer.save(path)
        got = read_log(spark, path, fmt, USER_VISIT_ACTION)
        assert sorted(tuple(r) for r in got.collect()) == want, fmt
