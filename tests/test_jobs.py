"""The end-to-end jobs agree with the registered queries."""

import json
import tempfile

import pytest

from conftest import SF_MID
from visitlens.cli import main as cli_main
from visitlens.plans import params as P
from visitlens.plans.queries import QUERIES, Inputs


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def _task_json():
    p = P.SESSION_PARAMS
    return json.dumps({"startDate": [p.start_date.isoformat()], "endDate": [p.end_date.isoformat()],
                       "startAge": [str(p.start_age)], "endAge": [str(p.end_age)],
                       "targetPageFlow": [",".join(map(str, P.TARGET_PAGE_FLOW))]})


def test_session_job_writes_every_report(spark):
    out = tempfile.mkdtemp(prefix="vl-out-")
    cli_main(["session", "--sf-dir", SF_MID, "--task-json", _task_json(), "--task-id", "7",
              "--out", out, "--sample-size", str(P.SAMPLE_SIZE)])
    stats = spark.read.parquet(f"{out}/session_aggr_stat")
    assert [r.task_id for r in stats.collect()] == [7]
    cols = [c for c in stats.columns if c != "task_id"]
    assert _rows(stats, cols) == _rows(QUERIES["session_stats"](spark, SF_MID), cols)
    top = spark.read.parquet(f"{out}/top10_category")
    cols = ["category_id", "click_count", "order_count", "pay_count"]
    assert _rows(top, cols) == _rows(QUERIES["top10_category"](spark, SF_MID), cols)
    detail = spark.read.parquet(f"{out}/session_detail")
    n_top = detail.where("source = 'top10_session'").count()
    assert n_top == QUERIES["top10_session_detail"](spark, SF_MID).count()
    sample = spark.read.parquet(f"{out}/session_random_extract")
    assert sample.count() > 0
    assert detail.where("source = 'random_extract'").select("session_id").distinct().count() \
        == sample.count()


def test_page_and_product_jobs(spark):
    out = tempfile.mkdtemp(prefix="vl-out-")
    cli_main(["page", "--sf-dir", SF_MID, "--task-json", _task_json(), "--task-id", "1",
              "--out", out])
    cli_main(["product", "--sf-dir", SF_MID, "--task-json", _task_json(), "--task-id", "1",
              "--out", out])
    cols = ["step", "page_slice", "slice_pv", "convert_rate"]
    assert _rows(spark.read.parquet(f"{out}/page_split_convert_rate"), cols) == \
        _rows(QUERIES["page_conversion"](spark, SF_MID), cols)
    cols = ["area", "product_id", "click_count", "city_infos", "product_status"]
    assert _rows(spark.read.parquet(f"{out}/area_top3_product"), cols) == \
        _rows(QUERIES["area_top3_product"](spark, SF_MID), cols)


def test_rerun_task_replaces_only_its_rows(spark):
    from visitlens.sinks.merge import append_results
    out = tempfile.mkdtemp(prefix="vl-out-") + "/t"
    df = lambda n: spark.range(n).withColumnRenamed("id", "x")
    append_results(df(3), out, 1)
    append_results(df(2), out, 2)
    append_results(df(4), out, 1)          # task 1 re-run
    got = {r.task_id: r.n for r in spark.read.parquet(out).groupBy("task_id")
           .count().withColumnRenamed("count", "n").collect()}
    assert got == {1: 4, 2: 2}


def test_ads_cli_runs_the_stream_to_the_end(spark):
    import os
    from visitlens.sinks.deltas import DeltaStore
    from visitlens.streaming.ad_stream import AD_TABLES, read_table
    src = tempfile.mkdtemp(prefix="vl-src-")
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("\n".join(f"1704067207179_P_C_{u}_1" for u in (1, 1, 2)) + "\nbroken\n")
    root = tempfile.mkdtemp(prefix="vl-ads-")
    cli_main(["ads", "--source", src, "--state", f"{root}/state",
              "--checkpoint", f"{root}/ckpt", "--threshold", "2", "--trigger", "availableNow"])
    store = DeltaStore(spark, f"{root}/state", AD_TABLES)
    assert [r.user_id for r in read_table(store, "ad_blacklist").collect()] == [1]
    assert [r.rejected for r in read_table(store, "ad_rejects").collect()] == [1]


def test_jobs_over_native_tables(spark):
    """Tables given by path (Parquet) or name, as a user of the jobs has them."""
    from visitlens.schemas import USER_VISIT_ACTION
    root, out = tempfile.mkdtemp(prefix="vl-in-"), tempfile.mkdtemp(prefix="vl-out-")
    inp = Inputs(spark, SF_MID)
    inp.actions().select(*USER_VISIT_ACTION.fieldNames()).write.parquet(f"{root}/actions")
    inp.users().write.parquet(f"{root}/users")
    inp.cities().write.parquet(f"{root}/cities")
    inp.products().write.parquet(f"{root}/products")
    common = ["--task-json", _task_json(), "--task-id", "3", "--out", out]
    cli_main(["session", "--actions", f"{root}/actions", "--users", f"{root}/users", *common])
    cli_main(["page", "--actions", f"{root}/actions", *common])
    cli_main(["product", "--actions", f"{root}/actions", "--cities", f"{root}/cities",
              "--products", f"{root}/products", *common])
    for table, query in (("session_aggr_stat", "session_stats"),
                         ("page_split_convert_rate", "page_conversion"),
                         ("area_top3_product", "area_top3_product")):
        got = spark.read.parquet(f"{out}/{table}").drop("task_id")
        assert _rows(got, got.columns) == _rows(QUERIES[query](spark, SF_MID), got.columns)
    with pytest.raises(SystemExit, match="needs --cities"):
        cli_main(["product", "--actions", f"{root}/actions", *common])


def test_ads_cli_runs_all_queries(spark):
    import os
    from visitlens.sinks.deltas import DeltaStore
    from visitlens.streaming import ad_stream as stream
    src, root = tempfile.mkdtemp(prefix="vl-src-"), tempfile.mkdtemp(prefix="vl-ads-")
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("\n".join(f"1704067207179_P_C_{u}_1" for u in (1, 1, 2)) + "\n")
    cli_main(["ads", "--query", "all", "--source", src, "--state", f"{root}/state",
              "--checkpoint", f"{root}/ckpt", "--trigger", "availableNow", "--threshold", "2"])
    for query, tables, table in (("stat", stream.AD_TABLES, "ad_stat"),
                                 ("trend", stream.TREND_TABLES, "ad_click_trend"),
                                 ("totals", stream.STATEFUL_TABLES, "ad_stat_state"),
                                 ("sliding", stream.BUCKET_TABLES, "ad_click_bucket"),
                                 ("late", stream.LATE_TABLES, "ad_click_trend")):
        rows = stream.read_table(DeltaStore(spark, f"{root}/state/{query}", tables), table)
        assert [r.click_count for r in rows.collect()] == [3]
    crossed = DeltaStore(spark, f"{root}/state/crossing", stream.CROSSING_TABLES)
    assert [(r.user_id, r.click_count) for r in
            stream.read_table(crossed, "ad_crossing").collect()] == [(1, 2)]


def test_shared_scratch_is_required_off_local_mode():
    from visitlens import session

    class Unset:
        master = "spark://host:7077"

        def get(self, *_):
            return None

        def getConf(self):
            return self

        def getCheckpointDir(self):
            return None

    class Session:
        conf = sparkContext = Unset()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_dir(Session(), "x")


def test_task_run_leaves_one_copy_of_a_repeated_task(spark):
    rows = QUERIES["task_run"](spark, SF_MID).collect()
    by_task = {}
    for r in rows:
        by_task.setdefault(r.task_id, []).append((r.step, r.page_slice))
    assert {t: len(v) for t, v in by_task.items()} == {1: 6, 2: 3}
    assert all(len(set(v)) == len(v) for v in by_task.values())
    # task 2 sets an empty list and an empty string, both unset
    params = P.TASKS[1][1]
    assert json.loads(params)["sex"] == [] and json.loads(params)["cities"] == [""]


def test_stored_log_is_pruned_to_the_date_range(spark):
    from visitlens.plans.queries import stored_log_range
    found = stored_log_range(spark, SF_MID)
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "date" in filters and ">=" in filters and "<=" in filters
    assert not plan.split("PushedFilters: [")[1].split("]")[0].count("date")
    days = {r[0].split("/date=")[1][:10] for r in
            found.select("_metadata.file_path").distinct().collect()}
    assert len(days) == 14 and min(days) == "2024-01-08" and max(days) == "2024-01-21"
