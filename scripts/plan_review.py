"""Print the physical operators of every registered batch query.

For each query: counts of exchanges, join strategies, aggregates, window
group limits, and the columns each Parquet scan reads. Run after changes
to confirm pruning, partial aggregation, broadcasts and top-k limits.

Usage: python scripts/plan_review.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from visitlens import get_spark  # noqa: E402
from visitlens.plans.queries import QUERIES  # noqa: E402

OPS = (r"(WindowGroupLimit|ObjectHashAggregate|SortAggregate|HashAggregate|"
       r"BroadcastHashJoin|SortMergeJoin|BroadcastNestedLoopJoin|CartesianProduct|"
       r"Exchange (?:hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)|"
       r"TakeOrderedAndProject|Generate|ReusedExchange|Window \[)")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", shuffle_partitions=8)
    for name, q in QUERIES.items():
        if name.startswith("stream_"):
            continue
        df = q(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()       # final AQE plan
        plan = df._jdf.queryExecution().executedPlan().toString()
        final = plan.split("== Initial Plan ==")[0]
        ops = Counter(m.rstrip(" [") for m in re.findall(OPS, final))
        print(f"{name}: " + ", ".join(f"{k} x{v}" for k, v in sorted(ops.items())))
        for schema in sorted(set(re.findall(r"ReadSchema: struct<([^>]*)>", plan))):
            print(f"    reads {schema}")


if __name__ == "__main__":
    main()
