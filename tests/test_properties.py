"""Property checks: rounding, permutation invariance, hot-key lag."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings, strategies as st
from pyspark.sql import Window, functions as F

from conftest import SF_SMALL
from visitlens.functions.columns import ratio_half_up
from visitlens.operators import categories as C
from visitlens.operators import funnel as FN
from visitlens.operators import sessions as S
from visitlens.operators.sequence import previous_in_sequence
from visitlens.plans import params as P
from visitlens.plans.queries import Inputs

SLOW = settings(max_examples=8, deadline=None)


@SLOW
@given(st.lists(st.tuples(st.integers(0, 10_000), st.integers(1, 10_000)), min_size=1,
                max_size=200))
def test_ratio_is_exact_half_up(spark, pairs):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r[0] for r in df.select(ratio_half_up("n", "d")).collect()]
    want = [float((Decimal(n) / Decimal(d)).quantize(Decimal("0.01"), ROUND_HALF_UP))
            for n, d in pairs]
    assert got == want


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_results_do_not_depend_on_input_order(spark):
    inp = Inputs(spark, SF_SMALL)
    actions = inp.actions()
    shuffled = actions.repartition(7, F.xxhash64("event_id", F.lit(17)))
    users = inp.users()
    for op in (lambda a: S.session_stats(S.session_facts(a, users, P.SESSION_PARAMS)),
               lambda a: C.top_categories(a, 10),
               lambda a: FN.page_conversion(a, P.TARGET_PAGE_FLOW)):
        assert _rows(op(actions)) == _rows(op(shuffled))


@SLOW
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 20), st.integers(0, 5)),
                min_size=1, max_size=300),
       st.integers(1, 12))
def test_lag_with_any_key_distribution(spark, rows, chunks):
    data = [(k, t, i, v) for i, (k, t, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k long, t long, id long, v long")
    a = previous_in_sequence(df, "k", ["t", "id"], "v", "p", bucket_seconds=chunks)
    b = df.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("t", "id")))
    assert _rows(a) == _rows(b)
