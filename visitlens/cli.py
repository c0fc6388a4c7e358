"""Command line: run one analysis for one task.

    python -m visitlens.cli session --sf-dir DIR --task-json '{...}' --task-id 1 --out OUT
    python -m visitlens.cli page    --sf-dir DIR --task-json '{...}' --task-id 2 --out OUT
    python -m visitlens.cli product --sf-dir DIR --task-json '{...}' --task-id 3 --out OUT
    python -m visitlens.cli ads     --source DIR --state OUT --checkpoint CKPT

Inputs are the real tables, each by path or (``--format table``) by name:
``--actions`` (user_visit_action), ``--users`` (user_info), ``--products``
(product_info), ``--cities`` (city_info), with the columns of
:mod:`visitlens.schemas`; or ``--sf-dir``, a folder of the driver's test
tables mapped as in FIXTURES.md. Parameters come from a task's JSON
(``{"key": ["value"]}``) or from a ``task`` table (``--tasks PATH``: task_id,
task_param).

``ads`` runs the click statistics, the minute trend or the stateful totals
(``--query stat|trend|totals``, ``all`` for the three side by side) over text
files (``--source``) or Kafka (``--kafka SERVERS --topics A,B``).
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from visitlens import schemas
from visitlens.params import TaskParams, params_from_task
from visitlens.plans import jobs
from visitlens.session import get_spark
from visitlens.sources import fixtures
from visitlens.sources.tables import Tables, read_log

NATIVE = {"actions": schemas.USER_VISIT_ACTION, "users": schemas.USER_INFO,
          "products": schemas.PRODUCT_INFO, "cities": schemas.CITY_INFO}
NEEDS = {"session": ("actions", "users"), "page": ("actions",),
         "product": ("actions", "cities", "products")}


def read_inputs(spark, args, params) -> dict:
    """The job's tables, native ones as given, or derived from the test tables."""
    out = {}
    for name in NEEDS[args.job]:
        where = getattr(args, name)
        if where:
            schema = None if args.format in ("table", "parquet", "orc") else NATIVE[name]
            out[name] = read_log(spark, where, args.format, schema)
            if name == "actions" and "event_id" not in out[name].columns:
                # the tie-breaker of equal action times: any fixed function of the row
                out[name] = out[name].withColumn("event_id", F.xxhash64(*out[name].columns))
        elif args.sf_dir:
            t = Tables(spark, args.sf_dir)
            out[name] = {
                "actions": lambda: fixtures.user_visit_action(t.events, params.start_date,
                                                              params.end_date),
                "users": lambda: fixtures.user_info(t.customer),
                "products": lambda: fixtures.product_info(t.part),
                "cities": lambda: fixtures.city_info(t.nation, t.region)}[name]()
        else:
            raise SystemExit(f"{args.job} needs --{name} or --sf-dir")
    return out


def run_ads(spark, args) -> None:
    """Start the chosen queries on one source and wait for them."""
    from visitlens.sources.adlog import kafka_ad_log
    from visitlens.streaming import ad_stream as stream
    if args.kafka:
        lines = kafka_ad_log(spark, args.kafka, args.topics)
    else:
        lines = spark.readStream.text(args.source)
    starts = {"stat": lambda state, checkpoint: stream.start_ad_stream(
                  spark, lines, state, checkpoint, args.threshold, args.trigger),
              "trend": lambda state, checkpoint: stream.start_trend_stream(
                  spark, lines, state, checkpoint, trigger=args.trigger),
              "totals": lambda state, checkpoint: stream.start_stat_stream(
                  spark, lines, state, checkpoint, trigger=args.trigger),
              "sliding": lambda state, checkpoint: stream.start_sliding_stream(
                  spark, lines, state, checkpoint, trigger=args.trigger),
              "crossing": lambda state, checkpoint: stream.start_crossing_stream(
                  spark, lines, state, checkpoint, args.threshold, trigger=args.trigger),
              "late": lambda state, checkpoint: stream.start_late_stream(
                  spark, lines, state, checkpoint, trigger=args.trigger)}
    chosen = tuple(starts) if args.query == "all" else (args.query,)
    started = []
    for name in chosen:
        # several queries keep their results and checkpoints apart
        state, checkpoint = ((f"{args.state}/{name}", f"{args.checkpoint}/{name}")
                             if len(chosen) > 1 else (args.state, args.checkpoint))
        query, _ = starts[name](state, checkpoint)
        started.append(query)
    for query in started:
        query.awaitTermination()


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="visitlens")
    ap.add_argument("job", choices=["session", "page", "product", "ads"])
    ap.add_argument("--sf-dir")
    for name in NATIVE:
        ap.add_argument(f"--{name}", help="path or table name of the native table")
    ap.add_argument("--format", default="parquet", choices=["parquet", "orc", "csv", "json",
                                                            "table"])
    ap.add_argument("--task-json")
    ap.add_argument("--tasks", help="parquet task table (task_id, task_param)")
    ap.add_argument("--task-id", type=int, default=0)
    ap.add_argument("--out")
    ap.add_argument("--sample-size", type=int, default=jobs.DEFAULT_SAMPLE_SIZE)
    ap.add_argument("--source", help="ads: folder of log text files")
    ap.add_argument("--kafka", help="ads: bootstrap servers instead of --source")
    ap.add_argument("--topics", help="ads: comma list of Kafka topics")
    ap.add_argument("--query", default="stat", choices=["stat", "trend", "totals", "sliding", "crossing", "late", "all"])
    ap.add_argument("--state")
    ap.add_argument("--checkpoint")
    ap.add_argument("--threshold", type=int, default=100)
    ap.add_argument("--trigger", default="5 seconds")
    args = ap.parse_args(argv)

    spark = get_spark()
    if args.job == "ads":
        run_ads(spark, args)
        return

    if args.tasks:
        params = params_from_task(spark.read.parquet(args.tasks), args.task_id)
    else:
        params = TaskParams.from_json(args.task_json or "{}")
    inputs = read_inputs(spark, args, params)
    if args.job == "session":
        jobs.run_session_analysis(spark, inputs["actions"], inputs["users"], params, args.out,
                                  args.task_id, args.sample_size)
    elif args.job == "page":
        jobs.run_page_conversion(spark, inputs["actions"], params, args.out, args.task_id)
    else:
        jobs.run_area_top_products(spark, inputs["actions"], inputs["cities"],
                                   inputs["products"], params, args.out, args.task_id)


if __name__ == "__main__":
    main()
