"""The SQL route: temp views over the inputs and Spark SQL statements.

``register_views`` exposes the inputs as ``user_visit_action``,
``user_info``, ``product_info``, ``city_info`` and ``ad_click`` and
registers the SQL functions of :mod:`visitlens.functions.columns`, so the
reports can be written as SQL text; Catalyst plans them exactly like the
DataFrame operators (the tests compare both).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from visitlens.functions.columns import register_sql_functions
from visitlens.operators.products import (
    AREA_LEVELS, OTHER_AREA_LEVEL, SELF_OPERATED, THIRD_PARTY)


def register_views(spark: SparkSession, actions: DataFrame, users: DataFrame,
                   products: DataFrame, cities: DataFrame,
                   ad_clicks: DataFrame | None = None) -> None:
    register_sql_functions(spark)
    actions.createOrReplaceTempView("user_visit_action")
    users.createOrReplaceTempView("user_info")
    products.createOrReplaceTempView("product_info")
    cities.createOrReplaceTempView("city_info")
    if ad_clicks is not None:
        ad_clicks.createOrReplaceTempView("ad_click")


def _sql_str(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def area_top3_sql(start_date: str, end_date: str, n: int = 3) -> str:
    """B8 as one statement (S2, J6, A8 with U1/U3, J7 with U2, W1, P10).

    No join hint: the optimizer broadcasts ``city_info`` from its size
    estimate or AQE from the measured size, as on the DataFrame route.
    """
    levels = " ".join(f"WHEN area = {_sql_str(a)} THEN {_sql_str(lvl)}"
                      for a, lvl in AREA_LEVELS.items())
    return f"""
WITH clicks AS (
  SELECT city_id, click_product_id AS product_id
  FROM user_visit_action
  WHERE click_product_id IS NOT NULL
    AND date BETWEEN DATE {_sql_str(start_date)} AND DATE {_sql_str(end_date)}
),
basic AS (
  SELECT c.area, k.product_id,
         concat_long_string(k.city_id, c.city_name, ':') AS city_info
  FROM clicks k JOIN city_info c ON k.city_id = c.city_id
),
counts AS (
  SELECT area, product_id, count(*) AS click_count,
         listagg(DISTINCT city_info, ',') WITHIN GROUP (ORDER BY city_info) AS city_infos
  FROM basic GROUP BY area, product_id
),
full_info AS (
  SELECT t.*, p.product_name,
         IF(get_json_field(p.extend_info, 'product_status') = '0',
            {_sql_str(SELF_OPERATED)}, {_sql_str(THIRD_PARTY)}) AS product_status
  FROM counts t JOIN product_info p ON t.product_id = p.product_id
)
SELECT area, CASE {levels} ELSE {_sql_str(OTHER_AREA_LEVEL)} END AS area_level,
       product_id, click_count, city_infos, product_name, product_status
FROM (SELECT *, row_number() OVER (PARTITION BY area
                                   ORDER BY click_count DESC, product_id) AS rn
      FROM full_info)
WHERE rn <= {n}"""


def province_top3_sql(n: int = 3) -> str:
    """R6 over the ``ad_click`` view as one statement."""
    return f"""
SELECT date, province, ad_id, click_count
FROM (SELECT *, row_number() OVER (PARTITION BY date, province
                                   ORDER BY click_count DESC, ad_id) AS rn
      FROM (SELECT date, province, ad_id, count(*) AS click_count
            FROM ad_click GROUP BY date, province, ad_id))
WHERE rn <= {n}"""
