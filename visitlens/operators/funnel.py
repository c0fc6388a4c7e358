"""Page one-step conversion along a page flow (B7: W3 + A10 + A11 + P9).

For a flow ``p1,p2,...,pn`` the slices are ``p1_p2 ... p(n-1)_pn``. A slice
is counted once per adjacent pair of actions in a session (ordered by
action time, then event id) that matches it, over every session in the
input. Rate 1 = slice 1 / views of p1; rate i = slice i / slice i-1,
rounded half-up to two digits; a zero denominator gives null. A slice
listed twice in the flow is reported once, with its last step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from visitlens.functions.columns import action_timestamp, ratio_half_up, slice_key
from visitlens.operators.sequence import previous_in_sequence


def flow_slices(flow: tuple[int, ...] | list[int]) -> list[str]:
    pages = [int(p) for p in flow]
    return [f"{a}_{b}" for a, b in zip(pages, pages[1:])]


def page_transitions(actions: DataFrame) -> DataFrame:
    """Each action with the page of the action before it in its session."""
    seq = actions.select("session_id", action_timestamp(actions).alias("t"),
                         "event_id", "page_id")
    return previous_in_sequence(seq, "session_id", ["t", "event_id"], "page_id", "prev_page")


def page_conversion(actions: DataFrame, flow: tuple[int, ...] | list[int]) -> DataFrame:
    """Rows ``(step, page_slice, slice_pv, convert_rate)``, one per distinct slice.

    All counts come from one global aggregate (partial per task), so the
    driver never sees more than the final handful of rows.
    """
    slices = flow_slices(flow)
    if not slices:
        raise ValueError("a page flow needs at least two pages")
    distinct = list(dict.fromkeys(slices))
    trans = page_transitions(actions)
    cur = F.when(F.col("prev_page").isNotNull(), slice_key("prev_page", "page_id"))
    counts = trans.agg(
        F.count_if(F.col("page_id") == F.lit(int(flow[0]))).alias("start_pv"),
        *[F.count_if(cur == F.lit(s)).alias(f"pv{j}") for j, s in enumerate(distinct)])

    pv = {s: F.col(f"pv{j}") for j, s in enumerate(distinct)}
    last_step = {s: i for i, s in enumerate(slices, start=1)}
    rows = []
    for i, s in enumerate(slices, start=1):
        if last_step[s] != i:
            continue
        den = F.col("start_pv") if i == 1 else pv[slices[i - 2]]
        rows.append(F.struct(F.lit(i).alias("step"), F.lit(s).alias("page_slice"),
                             pv[s].alias("slice_pv"),
                             ratio_half_up(pv[s], den).alias("convert_rate")))
    return counts.select(F.inline(F.array(*rows)))
