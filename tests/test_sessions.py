"""Session aggregate, filter and statistics (B1-B3) on hand-made rows."""

import re

import pytest

from helpers import action, actions_df, secs, user, users_df
from visitlens.operators import sessions as S
from visitlens.params import TaskParams

VISIT_EDGES = [0, 1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801]
STEP_EDGES = [1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61]


def _visit_sessions(spark):
    rows = []
    for i, length in enumerate(VISIT_EDGES):
        rows.append(action(f"v{i}", 1, secs(0)))
        if length:
            rows.append(action(f"v{i}", 1, secs(length)))
    return actions_df(spark, rows)


def test_visit_length_and_bucket_edges(spark):
    sessions = S.session_aggregate(_visit_sessions(spark))
    got = {r.session_id: r.visit_length for r in sessions.collect()}
    assert sorted(got.values()) == sorted(VISIT_EDGES)
    stats = S.session_stats(sessions).first().asDict()
    n = len(VISIT_EDGES)
    # 0 s falls in no bucket; each bucket holds its two edges, the last only 1801
    per_bucket = [2] * 8 + [1]
    assert stats["session_count"] == n
    for (name, _, _), k in zip(S.VISIT_BUCKETS, per_bucket):
        assert stats[name] == S_ratio(k, n), name


def test_step_length_bucket_edges(spark):
    rows = []
    for i, steps in enumerate(STEP_EDGES):
        rows += [action(f"s{i}", 1, secs(j)) for j in range(steps)]
    sessions = S.session_aggregate(actions_df(spark, rows))
    counts = S.session_stats(sessions).first().asDict()
    n = len(STEP_EDGES)
    assert counts["session_count"] == n
    # edges per bucket: 1_3:{1,3} 4_6:{4,6} 7_9:{7,9} 10_30:{10,30} 30_60:{31,60} 60:{61}
    per_bucket = [2, 2, 2, 2, 2, 1]
    for (name, _, _), k in zip(S.STEP_BUCKETS, per_bucket):
        assert counts[name] == S_ratio(k, n), name


def S_ratio(k, n):
    return ((200 * k + n) // (2 * n)) / 100.0


def test_distinct_ids_exact_not_substring(spark):
    rows = [action("a", 7, secs(0), click_cat=12, keyword="shoe"),
            action("a", 7, secs(1), click_cat=1, keyword="sh"),
            action("a", 7, secs(2), click_cat=12, keyword=""),
            action("a", 7, secs(3))]
    r = S.session_aggregate(actions_df(spark, rows)).first()
    assert r.click_category_ids == [1, 12]
    assert r.search_keywords == ["sh", "shoe"]
    assert r.step_length == 4 and r.user_id == 7


def test_unknown_user_is_dropped(spark):
    rows = [action("a", 1, secs(0)), action("b", 2, secs(0))]
    users = users_df(spark, [user(1)])
    got = [r.session_id for r in S.session_aggregate(actions_df(spark, rows), users).collect()]
    assert got == ["a"]


def _filter_fixture(spark):
    rows = [action("s1", 1, secs(0), keyword="kw1", click_cat=12),
            action("s2", 2, secs(0), keyword="kw2", click_cat=1),
            action("s3", 3, secs(0)),
            action("s4", 4, secs(0), keyword="kw1")]
    users = users_df(spark, [user(1, 25, "eng", "c1", "male"),
                             user(2, 40, "art", "c2", "female"),
                             user(3, 60, "eng", "c3", "female"),
                             user(4, None, "eng", "c1", "male")])
    return S.session_aggregate(actions_df(spark, rows), users)


def _ids(df):
    return sorted(r.session_id for r in df.collect())


@pytest.mark.parametrize("params,expected", [
    (TaskParams(), ["s1", "s2", "s3", "s4"]),
    (TaskParams(start_age=20), ["s1", "s2", "s3", "s4"]),             # one bound: ignored
    (TaskParams(start_age=20, end_age=40), ["s1", "s2"]),              # null age fails
    (TaskParams(professionals=("eng", "x")), ["s1", "s3", "s4"]),
    (TaskParams(cities=("c1",)), ["s1", "s4"]),
    (TaskParams(sex="female"), ["s2", "s3"]),
    (TaskParams(keywords=("kw1", "zz")), ["s1", "s4"]),
    (TaskParams(category_ids=(1,)), ["s2"]),                           # 1 does not match 12
    (TaskParams(category_ids=(99,)), []),
    (TaskParams(professionals=("eng",), sex="male", keywords=("kw1",)), ["s1", "s4"]),
])
def test_filter_parameters(spark, params, expected):
    assert _ids(S.filter_sessions(_filter_fixture(spark), params)) == expected


def test_empty_string_parameter_is_unset():
    p = TaskParams.from_json('{"sex": [""], "cities": ["c1,c2"], "startAge": ["10"], '
                             '"endAge": [], "categoryIds": ["3,,4"]}')
    assert p.sex is None and p.cities == ("c1", "c2") and p.start_age == 10
    assert p.end_age is None and p.category_ids == (3, 4)


def test_stats_of_no_sessions(spark):
    empty = _filter_fixture(spark).where("false")
    row = S.session_stats(empty).first().asDict()
    assert row["session_count"] == 0
    assert all(v is None for k, v in row.items() if k != "session_count")


def test_detail_is_semi_join(spark):
    acts = actions_df(spark, [action("a", 1, secs(0)), action("a", 1, secs(1)),
                              action("b", 2, secs(0))])
    chosen = S.session_aggregate(acts).where("session_id = 'a'")
    assert S.session_detail(acts, chosen).count() == 2


def test_params_from_task_table(spark):
    from visitlens.params import params_from_task
    tasks = spark.createDataFrame(
        [(1, '{"startDate": ["2024-01-01"], "targetPageFlow": ["1,2,3"], "sex": ["male"]}'),
         (2, "{}")], "task_id long, task_param string")
    p = params_from_task(tasks, 1)
    assert p.start_date.isoformat() == "2024-01-01"
    assert p.target_page_flow == (1, 2, 3) and p.sex == "male"
    assert params_from_task(tasks, 2) == TaskParams()
    with pytest.raises(KeyError):
        params_from_task(tasks, 3)


def test_lists_are_built_from_distinct_values(spark):
    """A hot session: its rows meet as one row a value before the lists are collected."""
    rows = [action("hot", 1, f"5:00:{i % 60:02d}", keyword=f"kw{i % 3}" if i % 2 else None,
                   click_cat=i % 5 if i % 2 == 0 else None) for i in range(600)]
    rows += [action("s", 2, "6:00:00", keyword="")]
    sessions = S.session_aggregate(actions_df(spark, rows))
    got = {r.session_id: r for r in sessions.collect()}
    assert got["hot"].search_keywords == ["kw0", "kw1", "kw2"]
    assert got["hot"].click_category_ids == [0, 1, 2, 3, 4] and got["hot"].step_length == 600
    assert got["hot"].visit_length == 59 and got["s"].search_keywords == []
    plan = sessions._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    # below the exchange on (session, keyword, category) nothing is collected
    below = re.split(r"hashpartitioning\(session_id#\d+, kw#\d+, cat#\d+L,", plan)
    assert len(below) == 2 and "collect_set" in below[0] and "collect_set" not in below[1]
