"""Typed schemas of the inputs and outputs.

Times are TIMESTAMP_NTZ so results do not depend on the session time
zone; multi-valued ids stay comma-separated strings on input (as logged)
and are split into ``array<bigint>`` where they are used.
"""

from pyspark.sql import types as T

USER_VISIT_ACTION = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("page_id", T.LongType()),
    T.StructField("action_time", T.StringType()),
    T.StructField("search_keyword", T.StringType()),
    T.StructField("click_category_id", T.LongType()),
    T.StructField("click_product_id", T.LongType()),
    T.StructField("order_category_ids", T.StringType()),
    T.StructField("order_product_ids", T.StringType()),
    T.StructField("pay_category_ids", T.StringType()),
    T.StructField("pay_product_ids", T.StringType()),
    T.StructField("city_id", T.LongType()),
    T.StructField("event_id", T.LongType()),
])
# A stored action table may add ``action_ts`` (TIMESTAMP_NTZ equal to
# ``action_time``); operators then skip parsing the text per row.

USER_INFO = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("username", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("professional", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("sex", T.StringType()),
])

PRODUCT_INFO = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("extend_info", T.StringType()),
])

CITY_INFO = T.StructType([
    T.StructField("city_id", T.LongType()),
    T.StructField("city_name", T.StringType()),
    T.StructField("area", T.StringType()),
])

# Decoded ad click log.
AD_CLICK = T.StructType([
    T.StructField("ts_ms", T.LongType()),
    T.StructField("date", T.DateType()),
    T.StructField("province", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("ad_id", T.LongType()),
])

# Columns of a session-detail row, in sink order.
DETAIL_COLUMNS = [
    "user_id", "session_id", "page_id", "action_time", "search_keyword",
    "click_category_id", "click_product_id", "order_category_ids",
    "order_product_ids", "pay_category_ids", "pay_product_ids",
]
