"""Top categories (B5) and their most active sessions.

Shuffle plan: the click/order/pay counts come from one exploded pass and
one hash aggregate on ``category_id`` (partial aggregation, so a hot
category is combined map-side), not three aggregates and three outer
joins. The top-N categories are an ordered limit (TakeOrderedAndProject),
at most N rows, so broadcasting them is bounded by N.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from visitlens.functions.columns import csv_ids
from visitlens.operators.topk import top_n_per_group
from visitlens.schemas import DETAIL_COLUMNS

CLICK, ORDER, PAY = 0, 1, 2


def _tagged(ids, kind: int):
    return F.transform(ids, lambda x: F.struct(x.alias("category_id"), F.lit(kind).alias("kind")))


def category_counts(detail: DataFrame) -> DataFrame:
    """A5 + A6 + J3: click, order and pay counts per category.

    An order or pay id listed twice in one action counts twice; empty and
    malformed list entries are skipped. Every category that occurs at
    least once is present, with zeros for the kinds it lacks.
    """
    click = F.filter(F.array(F.col("click_category_id")), lambda x: x.isNotNull())
    tagged = F.concat(_tagged(click, CLICK),
                      _tagged(csv_ids("order_category_ids"), ORDER),
                      _tagged(csv_ids("pay_category_ids"), PAY))
    kind = F.col("e.kind")
    return (detail.select(F.explode(tagged).alias("e"))
            .groupBy(F.col("e.category_id").alias("category_id"))
            .agg(F.count_if(kind == CLICK).alias("click_count"),
                 F.count_if(kind == ORDER).alias("order_count"),
                 F.count_if(kind == PAY).alias("pay_count")))


def top_categories(detail: DataFrame, n: int = 10) -> DataFrame:
    """B5 (T1 + T2): the n categories with most clicks, then orders, then pays.

    Ties are broken by the smaller category id.
    """
    return (category_counts(detail)
            .orderBy(F.desc("click_count"), F.desc("order_count"),
                     F.desc("pay_count"), F.asc("category_id"))
            .limit(n))


def top_sessions_per_category(detail: DataFrame, top: DataFrame, n: int = 10) -> DataFrame:
    """B6 (A7 + J4 + W4): per top category, the n sessions clicking it most.

    ``top`` has at most N rows; AQE broadcasts it by its measured size.
    The top n is bounded per task (:func:`top_n_per_group`), so a category
    clicked by a huge number of sessions does not flood one task.
    """
    clicks = (detail.where(F.col("click_category_id").isNotNull())
              .join(top.select(F.col("category_id").alias("click_category_id")),
                    "click_category_id", "left_semi")
              .groupBy(F.col("click_category_id").alias("category_id"), "session_id")
              .agg(F.count(F.lit(1)).alias("click_count")))
    return top_n_per_group(clicks, ["category_id"],
                           [F.desc("click_count"), F.asc("session_id")], n).drop("rn")


def tagged_detail(detail: DataFrame, chosen: DataFrame, tag_cols: list[str]) -> DataFrame:
    """Actions of the chosen sessions, one copy per chosen row.

    ``chosen`` (top N x N sessions, or a sample) is broadcast by AQE when its
    measured size allows; stored beforehand, a hot session is split too.
    """
    keys = chosen.select("session_id", *tag_cols)
    return (detail.join(keys, "session_id")
            .select(*tag_cols, *DETAIL_COLUMNS, "event_id"))
