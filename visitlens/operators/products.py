"""Top products per area (B8: S2 + J6 + A8 + J7 + W1 + P10 + P11).

Shuffle plan: click rows join the city dimension (AQE broadcasts it by its
measured size), then one hash aggregate on ``(area, product_id)`` with partial
aggregation (a hot product is combined map-side; the distinct city list
per group is bounded by the number of cities). The aggregate joins the
product dimension (shuffle or broadcast as sizes dictate), and the top 3
per area is a window group limit (at most 3 rows per area leave each map
task).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from visitlens.functions.columns import concat_long_string, group_concat_distinct, json_field
from visitlens.operators.sessions import actions_in_range
from visitlens.operators.topk import top_n_per_group

# Area grades and product status labels written by the reference job
# (fixed values).
AREA_LEVELS = {
    "华北": "A级",
    "华东": "A级",
    "华南": "B级",
    "华中": "B级",
    "西北": "C级",
    "西南": "C级",
}
OTHER_AREA_LEVEL = "D级"
SELF_OPERATED = "自营商品"
THIRD_PARTY = "第三方商品"


def click_actions(actions: DataFrame, start_date: dt.date | None = None,
                  end_date: dt.date | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(city_id, product_id)`` of clicks in the date range (+ ``keep``)."""
    return (actions_in_range(actions, start_date, end_date)
            .where(F.col("click_product_id").isNotNull())
            .select("city_id", F.col("click_product_id").alias("product_id"), *keep))


def click_product_basic(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks with their city's name and area (inner join, sides sized by AQE)."""
    city = cities.select("city_id", "city_name", "area")
    extra = [c for c in clicks.columns if c not in ("city_id", "product_id")]
    return (clicks.join(city, "city_id")
            .select("city_id", "city_name", "area", "product_id", *extra))


def area_product_clicks(basic: DataFrame) -> DataFrame:
    """Clicks per (area, product) and the sorted distinct 'id:name' cities."""
    return (basic.groupBy("area", "product_id")
            .agg(F.count(F.lit(1)).alias("click_count"),
                 group_concat_distinct(concat_long_string("city_id", "city_name", ":"))
                 .alias("city_infos")))


def product_status(extend_info: Column | str) -> Column:
    """Self-operated when ``product_status`` is 0, else third-party."""
    return (F.when(json_field(extend_info, "product_status") == F.lit("0"),
                   F.lit(SELF_OPERATED))
            .otherwise(F.lit(THIRD_PARTY)))


def area_level(area: Column | str, levels: dict[str, str] | None = None,
               other: str = OTHER_AREA_LEVEL) -> Column:
    """P10: grade of an area; unknown areas get ``other``."""
    levels = AREA_LEVELS if levels is None else levels
    expr = None
    for name, level in levels.items():
        cond = F.col(area) == F.lit(name) if isinstance(area, str) else area == F.lit(name)
        expr = F.when(cond, F.lit(level)) if expr is None else expr.when(cond, F.lit(level))
    return F.lit(other) if expr is None else expr.otherwise(F.lit(other))


def with_product_info(counts: DataFrame, products: DataFrame) -> DataFrame:
    """Inner join with the product dimension, adding name and status."""
    prod = products.select("product_id", "product_name",
                           product_status("extend_info").alias("product_status"))
    return counts.join(prod, "product_id")


def top_products_per_area(full: DataFrame, n: int = 3,
                          levels: dict[str, str] | None = None) -> DataFrame:
    """W1 + P10: the n most clicked products of each area (ties: smaller id)."""
    return (top_n_per_group(full, ["area"], [F.desc("click_count"), F.asc("product_id")], n)
            .select("area", area_level("area", levels).alias("area_level"), "product_id",
                    "click_count", "city_infos", "product_name", "product_status"))


def area_top_products(actions: DataFrame, cities: DataFrame, products: DataFrame,
                      n: int = 3, start_date: dt.date | None = None,
                      end_date: dt.date | None = None) -> DataFrame:
    """The whole pipeline."""
    basic = click_product_basic(click_actions(actions, start_date, end_date), cities)
    return top_products_per_area(with_product_info(area_product_clicks(basic), products), n)
