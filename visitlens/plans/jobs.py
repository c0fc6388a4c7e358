"""End-to-end jobs: one per analysis, driven by a task's parameters.

Each job reads its inputs as DataFrames, computes every report of that
analysis and appends the result tables under ``out_dir/<table>``, keyed by
``task_id`` (K1). Intermediates read by several reports (filtered
sessions, their actions) are written once to the shared checkpoint folder
and read back, so each report starts from files, not from a recomputation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from visitlens.functions.columns import format_time
from visitlens.operators import categories as C
from visitlens.operators import funnel as FN
from visitlens.operators import products as PR
from visitlens.operators import sampling as SA
from visitlens.operators import sessions as S
from visitlens.params import TaskParams
from visitlens.schemas import DETAIL_COLUMNS
from visitlens.session import drop_paths, materialize
from visitlens.sinks.merge import append_results

DEFAULT_SAMPLE_SIZE = 100      # sessions drawn per task (reference value)


def _sample_text(sample: DataFrame) -> DataFrame:
    return sample.select("session_id", format_time("start_time").alias("start_time"),
                         F.array_join("search_keywords", ",").alias("search_keywords"),
                         F.array_join("click_category_ids", ",").alias("click_category_ids"))


def session_analysis(actions: DataFrame, users: DataFrame, params: TaskParams,
                     sample_size: int = DEFAULT_SAMPLE_SIZE, seed: str = "",
                     top_n: int = 10, scratch: list[str] | None = None
                     ) -> dict[str, DataFrame]:
    """Every report of the session analysis, as DataFrames.

    The paths of the intermediate tables are appended to ``scratch``.
    """
    scoped = S.actions_in_range(actions, params.start_date, params.end_date)
    filtered = materialize(S.session_facts(scoped, users, params), "filtered-sessions", scratch)
    detail = materialize(S.session_detail(scoped, filtered), "session-detail", scratch)
    sample = materialize(SA.sample_sessions(filtered, sample_size, seed), "sample", scratch)
    top = C.top_categories(detail, top_n)
    top_sessions = C.top_sessions_per_category(detail, top, top_n)
    sample_detail = (C.tagged_detail(detail, sample, [])
                     .select(F.lit(None).cast("bigint").alias("category_id"), *DETAIL_COLUMNS,
                             "event_id", F.lit("random_extract").alias("source")))
    top_detail = (C.tagged_detail(detail, top_sessions, ["category_id"])
                  .withColumn("source", F.lit("top10_session")))
    return {
        "session_aggr_stat": S.session_stats(filtered),
        "session_random_extract": _sample_text(S.with_lists(sample, detail)),
        "top10_category": top,
        "top10_session": top_sessions,
        "session_detail": sample_detail.unionByName(top_detail),
    }


def page_conversion(actions: DataFrame, params: TaskParams) -> dict[str, DataFrame]:
    """B7 over the task's date range and page flow."""
    if not params.target_page_flow:
        raise ValueError("the task sets no targetPageFlow")
    scoped = S.actions_in_range(actions, params.start_date, params.end_date)
    return {"page_split_convert_rate": FN.page_conversion(scoped, params.target_page_flow)}


def area_top_products(actions: DataFrame, cities: DataFrame, products: DataFrame,
                      params: TaskParams, n: int = 3) -> dict[str, DataFrame]:
    """B8 over the task's date range."""
    return {"area_top3_product": PR.area_top_products(
        actions, cities, products, n, params.start_date, params.end_date)}


def write_results(results: dict[str, DataFrame], out_dir: str, task_id: int) -> None:
    for table, df in results.items():
        append_results(df, f"{out_dir.rstrip('/')}/{table}", task_id)


def run_session_analysis(spark: SparkSession, actions: DataFrame, users: DataFrame,
                         params: TaskParams, out_dir: str, task_id: int,
                         sample_size: int = DEFAULT_SAMPLE_SIZE, seed: str = "") -> None:
    scratch: list[str] = []
    try:
        write_results(session_analysis(actions, users, params, sample_size, seed,
                                       scratch=scratch), out_dir, task_id)
    finally:
        drop_paths(spark, scratch)


def run_page_conversion(spark: SparkSession, actions: DataFrame, params: TaskParams,
                        out_dir: str, task_id: int) -> None:
    write_results(page_conversion(actions, params), out_dir, task_id)


def run_area_top_products(spark: SparkSession, actions: DataFrame, cities: DataFrame,
                          products: DataFrame, params: TaskParams, out_dir: str,
                          task_id: int) -> None:
    write_results(area_top_products(actions, cities, products, params), out_dir, task_id)
