"""DuckDB oracle SQL for the registered queries.

Each statement starts from the driver's raw tables and rebuilds the
fixture views with the same expressions as
:mod:`visitlens.sources.fixtures`, then computes the query the plain,
set-at-a-time way. Column names equal the Spark results'.
"""

from __future__ import annotations

from visitlens.plans import params as P

_D0 = P.DATE_RANGE[0].isoformat()
_D1 = P.DATE_RANGE[1].isoformat()

BASE = f"""
ev AS (
  SELECT event_id, ts, user_id, event_type,
         TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events
),
user_visit_action AS (
  SELECT CAST(ts AS DATE) AS date, user_id,
         CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y-%m-%d') AS session_id,
         k % 10 AS page_id,
         strftime(ts, '%Y-%m-%d') || ' ' || lpad(CAST(user_id % 24 AS VARCHAR), 2, '0')
           || ':' || strftime(ts, '%M') || ':' || strftime(ts, '%S') AS action_time,
         CASE WHEN event_type = 'view' THEN 'kw' || CAST(k % 10 AS VARCHAR) END AS search_keyword,
         CASE WHEN event_type = 'click' THEN k END AS click_category_id,
         CASE WHEN event_type = 'click' THEN event_id % 200 END AS click_product_id,
         CASE WHEN event_type = 'signup'
              THEN CAST(k AS VARCHAR) || ',' || CAST((k + event_id) % 100 AS VARCHAR) END
           AS order_category_ids,
         CASE WHEN event_type = 'signup' THEN CAST(event_id % 200 AS VARCHAR) END AS order_product_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(k AS VARCHAR) END AS pay_category_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(event_id % 200 AS VARCHAR) END AS pay_product_ids,
         event_id % 25 AS city_id,
         event_id
  FROM ev
),
actions AS (
  SELECT * FROM user_visit_action WHERE date BETWEEN DATE '{_D0}' AND DATE '{_D1}'
),
user_info AS (
  SELECT c_custkey AS user_id, c_name AS username, c_name AS name,
         CAST(c_custkey % 60 AS INTEGER) AS age, c_mktsegment AS professional,
         'city' || CAST(c_nationkey AS VARCHAR) AS city,
         CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer
),
product_info AS (
  SELECT p_partkey AS product_id, p_name AS product_name,
         '{{"product_status": ' || CAST(p_size % 2 AS VARCHAR) || '}}' AS extend_info
  FROM part
),
city_info AS (
  SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
sess AS (
  SELECT session_id, min(user_id) AS user_id,
         list_sort(list_distinct(list(CASE WHEN search_keyword <> '' THEN search_keyword END)))
           AS kw_list,
         list_sort(list_distinct(list(click_category_id))) AS cat_list,
         min(CAST(action_time AS TIMESTAMP)) AS start_time,
         max(CAST(action_time AS TIMESTAMP)) AS end_time,
         count(*) AS step_length
  FROM actions GROUP BY session_id
),
sessions AS (
  SELECT s.*, CAST(epoch(end_time) - epoch(start_time) AS BIGINT) AS visit_length,
         u.age, u.professional, u.city, u.sex
  FROM sess s JOIN user_info u ON s.user_id = u.user_id
)"""


def _sql_list(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def _filter_sql(p) -> str:
    conds = ["TRUE"]
    if p.start_age is not None and p.end_age is not None:
        conds.append(f"age BETWEEN {p.start_age} AND {p.end_age}")
    if p.professionals:
        conds.append(f"professional IN ({_sql_list(p.professionals)})")
    if p.cities:
        conds.append(f"city IN ({_sql_list(p.cities)})")
    if p.sex is not None:
        conds.append(f"sex = '{p.sex}'")
    if p.keywords:
        conds.append(f"list_has_any(kw_list, [{_sql_list(p.keywords)}])")
    if p.category_ids:
        conds.append(f"list_has_any(cat_list, [{_sql_list(p.category_ids)}]::BIGINT[])")
    return " AND ".join(conds)


def _with(*ctes: str) -> str:
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH {BASE}{extra}\n"


SESSION_COLS = """session_id, user_id,
  array_to_string(kw_list, ',') AS search_keywords,
  array_to_string(cat_list, ',') AS click_category_ids,
  strftime(start_time, '%Y-%m-%d %H:%M:%S') AS start_time,
  visit_length, step_length"""

FILTERED = f"filtered AS (SELECT * FROM sessions WHERE {_filter_sql(P.SESSION_PARAMS)})"


def _ratio(num: str, den: str) -> str:
    return (f"CASE WHEN {den} > 0 THEN ((200 * {num} + {den}) // (2 * {den})) / 100.0 END")


# Fixed values of the result, spelled out here so that an error in the code's
# own tables shows.
VISIT_BUCKETS = [
    ("visit_length_1s_3s_ratio", 1, 3), ("visit_length_4s_6s_ratio", 4, 6),
    ("visit_length_7s_9s_ratio", 7, 9), ("visit_length_10s_30s_ratio", 10, 30),
    ("visit_length_30s_60s_ratio", 31, 60), ("visit_length_1m_3m_ratio", 61, 180),
    ("visit_length_3m_10m_ratio", 181, 600), ("visit_length_10m_30m_ratio", 601, 1800),
    ("visit_length_30m_ratio", 1801, None)]
STEP_BUCKETS = [
    ("step_length_1_3_ratio", 1, 3), ("step_length_4_6_ratio", 4, 6),
    ("step_length_7_9_ratio", 7, 9), ("step_length_10_30_ratio", 10, 30),
    ("step_length_30_60_ratio", 31, 60), ("step_length_60_ratio", 61, None)]


def _stats_sql() -> str:
    counts = []
    for name, lo, hi in VISIT_BUCKETS:
        cond = f"visit_length >= {lo}" if hi is None else f"visit_length BETWEEN {lo} AND {hi}"
        counts.append(f"count(*) FILTER (WHERE {cond}) AS {name}")
    for name, lo, hi in STEP_BUCKETS:
        cond = f"step_length >= {lo}" if hi is None else f"step_length BETWEEN {lo} AND {hi}"
        counts.append(f"count(*) FILTER (WHERE {cond}) AS {name}")
    names = [b[0] for b in VISIT_BUCKETS + STEP_BUCKETS]
    ratios = ",\n  ".join(f"{_ratio(n, 'session_count')} AS {n}" for n in names)
    return (_with(FILTERED, "c AS (SELECT count(*) AS session_count,\n  "
                  + ",\n  ".join(counts) + "\nFROM filtered)")
            + f"SELECT session_count,\n  {ratios}\nFROM c")


ORACLE: dict[str, str] = {}

ORACLE["session_aggregate"] = _with() + f"""
SELECT {SESSION_COLS}, age, professional, city, sex FROM sessions"""

ORACLE["session_filter"] = _with(
    f"f AS (SELECT * FROM sessions WHERE {_filter_sql(P.FILTER_PARAMS)})") + f"""
SELECT {SESSION_COLS}, age, professional, city, sex FROM f"""

ORACLE["session_stats"] = _stats_sql()

DETAIL = "detail AS (SELECT * FROM actions WHERE session_id IN (SELECT session_id FROM filtered))"
DETAIL_COLS = """d.user_id, d.session_id, d.page_id, d.action_time, d.search_keyword,
  d.click_category_id, d.click_product_id, d.order_category_ids, d.order_product_ids,
  d.pay_category_ids, d.pay_product_ids, d.event_id"""


def _csv_ids(col: str, kind: int) -> str:
    return (f"SELECT TRY_CAST(x AS BIGINT) AS cat, {kind} AS kind FROM "
            f"(SELECT unnest(string_split({col}, ',')) AS x FROM detail "
            f"WHERE {col} IS NOT NULL) WHERE x <> ''")


CATEGORY_COUNTS = f"""cats AS (
  SELECT click_category_id AS cat, 0 AS kind FROM detail WHERE click_category_id IS NOT NULL
  UNION ALL {_csv_ids('order_category_ids', 1)}
  UNION ALL {_csv_ids('pay_category_ids', 2)}
),
counts AS (
  SELECT cat AS category_id,
         count(*) FILTER (WHERE kind = 0) AS click_count,
         count(*) FILTER (WHERE kind = 1) AS order_count,
         count(*) FILTER (WHERE kind = 2) AS pay_count
  FROM cats WHERE cat IS NOT NULL GROUP BY cat
),
top AS (
  SELECT * FROM counts
  ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id
  LIMIT {P.TOP_CATEGORIES}
)"""

TOP_SESSIONS = f"""cs AS (
  SELECT click_category_id AS category_id, session_id, count(*) AS click_count
  FROM detail WHERE click_category_id IN (SELECT category_id FROM top)
  GROUP BY 1, 2
),
top_sessions AS (
  SELECT category_id, session_id, click_count FROM (
    SELECT *, row_number() OVER (PARTITION BY category_id
                                 ORDER BY click_count DESC, session_id) AS rn
    FROM cs) WHERE rn <= {P.TOP_SESSIONS}
)"""

ORACLE["top10_category"] = _with(FILTERED, DETAIL, CATEGORY_COUNTS) + "SELECT * FROM top"
ORACLE["top10_session"] = (_with(FILTERED, DETAIL, CATEGORY_COUNTS, TOP_SESSIONS)
                           + "SELECT * FROM top_sessions")
ORACLE["top10_session_detail"] = (
    _with(FILTERED, DETAIL, CATEGORY_COUNTS, TOP_SESSIONS)
    + f"SELECT t.category_id, {DETAIL_COLS}\n"
      "FROM top_sessions t JOIN detail d ON d.session_id = t.session_id")


def _funnel_sql(flow) -> str:
    slices = [f"{a}_{b}" for a, b in zip(flow, flow[1:])]
    distinct = list(dict.fromkeys(slices))
    idx = {s: j for j, s in enumerate(distinct)}
    pv_cols = ",\n  ".join(
        f"count(*) FILTER (WHERE prev IS NOT NULL AND "
        f"CAST(prev AS VARCHAR) || '_' || CAST(page_id AS VARCHAR) = '{s}') AS pv{j}"
        for j, s in enumerate(distinct))
    last = {s: i for i, s in enumerate(slices, start=1)}
    parts = []
    for i, s in enumerate(slices, start=1):
        if last[s] != i:
            continue
        den = "start_pv" if i == 1 else f"pv{idx[slices[i - 2]]}"
        parts.append(f"SELECT {i} AS step, '{s}' AS page_slice, pv{idx[s]} AS slice_pv, "
                     f"{_ratio(f'pv{idx[s]}', den)} AS convert_rate FROM c")
    seq = ("seq AS (SELECT page_id, lag(page_id) OVER (PARTITION BY session_id "
           "ORDER BY CAST(action_time AS TIMESTAMP), event_id) AS prev FROM actions)")
    c = (f"c AS (SELECT count(*) FILTER (WHERE page_id = {int(flow[0])}) AS start_pv,\n  "
         f"{pv_cols}\nFROM seq)")
    return _with(seq, c) + "\nUNION ALL\n".join(parts)


ORACLE["page_conversion"] = _funnel_sql(P.TARGET_PAGE_FLOW)


AREA_LEVEL = """CASE area WHEN '华北' THEN 'A级' WHEN '华东' THEN 'A级' WHEN '华南' THEN 'B级'
  WHEN '华中' THEN 'B级' WHEN '西北' THEN 'C级' WHEN '西南' THEN 'C级' ELSE 'D级' END"""
REGION_LEVEL = """CASE area WHEN 'ASIA' THEN 'A级' WHEN 'EUROPE' THEN 'B级'
  WHEN 'AMERICA' THEN 'C级' ELSE 'D级' END"""


def _status_sql() -> str:
    return ("CASE WHEN json_extract_string(extend_info, '$.product_status') = '0' "
            "THEN '自营商品' ELSE '第三方商品' END")


CLICK_BASIC = """basic AS (
  SELECT a.city_id, c.city_name, c.area, a.click_product_id AS product_id, a.event_id
  FROM actions a JOIN city_info c ON a.city_id = c.city_id
  WHERE a.click_product_id IS NOT NULL
)"""
AREA_COUNTS = """apc AS (
  SELECT area, product_id, count(*) AS click_count,
         string_agg(DISTINCT CAST(city_id AS VARCHAR) || ':' || city_name, ','
                    ORDER BY CAST(city_id AS VARCHAR) || ':' || city_name) AS city_infos
  FROM basic GROUP BY area, product_id
)"""

ORACLE["area_product_clicks"] = _with(CLICK_BASIC, AREA_COUNTS) + "SELECT * FROM apc"
ORACLE["salted_area_product"] = ORACLE["area_product_clicks"]
ORACLE["area_top3_product"] = _with(CLICK_BASIC, AREA_COUNTS, f"""full_ AS (
  SELECT apc.*, p.product_name, {_status_sql()} AS product_status
  FROM apc JOIN product_info p ON apc.product_id = p.product_id
)""") + f"""
SELECT area, {AREA_LEVEL} AS area_level, product_id, click_count, city_infos,
       product_name, product_status
FROM (SELECT *, row_number() OVER (PARTITION BY area
                                   ORDER BY click_count DESC, product_id) AS rn FROM full_)
WHERE rn <= {P.TOP_PRODUCTS}"""
ORACLE["skew_join_product"] = _with(CLICK_BASIC) + f"""
SELECT b.area, b.product_id, p.product_name, {_status_sql()} AS product_status,
       count(*) AS click_count
FROM basic b JOIN product_info p ON b.product_id = p.product_id
GROUP BY 1, 2, 3, 4"""

SAMPLE = f"""fs AS (
  SELECT *, CAST(start_time AS DATE) AS date, CAST(hour(start_time) AS INTEGER) AS hour
  FROM filtered
),
hc AS (SELECT date, hour, count(*) AS session_count FROM fs GROUP BY date, hour),
q AS (
  SELECT date, hour, session_count,
         sum(session_count) OVER (PARTITION BY date) AS day_count,
         (SELECT count(DISTINCT date) FROM hc) AS days
  FROM hc
),
quotas AS (
  SELECT date, hour,
         least(CAST(floor((session_count::DOUBLE / day_count::DOUBLE)
                          * ({P.SAMPLE_SIZE} // days)) AS BIGINT), session_count) AS quota
  FROM q
),
ranked AS (
  SELECT fs.*, row_number() OVER (PARTITION BY date, hour
                                  ORDER BY md5(session_id || '{P.SAMPLE_SEED}'), session_id) AS rn
  FROM fs
),
sample AS (SELECT r.* FROM ranked r JOIN quotas q USING (date, hour) WHERE r.rn <= q.quota)"""

ORACLE["session_hour_counts"] = _with(FILTERED, SAMPLE) + "SELECT * FROM hc"
ORACLE["session_sample"] = _with(FILTERED, SAMPLE) + """
SELECT session_id, strftime(start_time, '%Y-%m-%d %H:%M:%S') AS start_time,
       array_to_string(kw_list, ',') AS search_keywords,
       array_to_string(cat_list, ',') AS click_category_ids
FROM sample"""
ORACLE["session_sample_detail"] = _with(FILTERED, SAMPLE) + f"""
SELECT {DETAIL_COLS} FROM sample s JOIN actions d ON d.session_id = s.session_id"""

AD_CLICKS = """adlog AS (
  SELECT CAST(epoch_us(e.ts) // 1000 AS VARCHAR) || '_' || r.r_name || '_'
         || replace(n.n_name, '_', '') || '_' || CAST(e.user_id AS VARCHAR) || '_'
         || CAST(CASE WHEN e.user_id % 5 = 0 THEN 0 ELSE e.k % 10 END AS VARCHAR) AS value
  FROM ev e JOIN nation n ON n.n_nationkey = e.event_id % 25
            JOIN region r ON n.n_regionkey = r.r_regionkey
),
parts AS (SELECT string_split(value, '_') AS p FROM adlog),
clicks AS (
  SELECT ts_ms, CAST(make_timestamp(ts_ms * 1000) AS DATE) AS date,
         make_timestamp(ts_ms * 1000) AS t, province, city, user_id, ad_id
  FROM (SELECT TRY_CAST(p[1] AS BIGINT) AS ts_ms, p[2] AS province, p[3] AS city,
               TRY_CAST(p[4] AS BIGINT) AS user_id, TRY_CAST(p[5] AS BIGINT) AS ad_id
        FROM parts WHERE len(p) = 5)
  WHERE ts_ms IS NOT NULL AND user_id IS NOT NULL AND ad_id IS NOT NULL
),
user_counts AS (
  SELECT date, user_id, ad_id, count(*) AS click_count FROM clicks GROUP BY 1, 2, 3
),"""
AD_FILTERED = f"""blacklist AS (
  SELECT DISTINCT user_id FROM user_counts WHERE click_count >= {P.BLACKLIST_THRESHOLD}
),
filtered_clicks AS (
  SELECT * FROM clicks WHERE user_id NOT IN (SELECT user_id FROM blacklist)
),
stat AS (
  SELECT date, province, city, ad_id, count(*) AS click_count
  FROM filtered_clicks GROUP BY 1, 2, 3, 4
)"""


def _ad_with(*ctes: str) -> str:
    return _with(AD_CLICKS + "\n" + AD_FILTERED, *ctes)


ORACLE["ad_user_click_count"] = _ad_with() + "SELECT * FROM user_counts"
ORACLE["ad_blacklist"] = _ad_with() + "SELECT * FROM blacklist"
ORACLE["ad_filtered"] = _ad_with() + (
    "SELECT ts_ms, date, province, city, user_id, ad_id FROM filtered_clicks")
ORACLE["ad_stat"] = _ad_with() + "SELECT * FROM stat"
ORACLE["ad_province_top3"] = _ad_with() + """
SELECT date, province, ad_id, click_count FROM (
  SELECT *, row_number() OVER (PARTITION BY date, province
                               ORDER BY click_count DESC, ad_id) AS rn
  FROM (SELECT date, province, ad_id, CAST(sum(click_count) AS BIGINT) AS click_count
        FROM stat GROUP BY 1, 2, 3))
WHERE rn <= 3"""
ORACLE["ad_click_trend"] = _ad_with() + """
SELECT date, strftime(t, '%H') AS hour, strftime(t, '%M') AS minute, ad_id,
       count(*) AS click_count
FROM clicks GROUP BY 1, 2, 3, 4"""
ORACLE["ad_trend_sliding"] = _ad_with() + """
SELECT strftime(make_timestamp(start_ms * 1000), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(make_timestamp((start_ms + 3600000) * 1000), '%Y-%m-%d %H:%M:%S') AS window_end,
       ad_id, click_count
FROM (SELECT (ts_ms // 600000 - i) * 600000 AS start_ms, ad_id, count(*) AS click_count
      FROM clicks, range(6) AS r(i) GROUP BY 1, 2)"""

ALL_STAT = """all_stat AS (
  SELECT date, province, city, ad_id, count(*) AS click_count FROM clicks GROUP BY 1, 2, 3, 4
)"""
ORACLE["stream_ad_stat"] = _ad_with(ALL_STAT) + "SELECT * FROM all_stat"
ORACLE["stream_ad_province_top3"] = _ad_with(ALL_STAT) + """
SELECT date, province, ad_id, click_count FROM (
  SELECT *, row_number() OVER (PARTITION BY date, province
                               ORDER BY click_count DESC, ad_id) AS rn
  FROM (SELECT date, province, ad_id, CAST(sum(click_count) AS BIGINT) AS click_count
        FROM all_stat GROUP BY 1, 2, 3))
WHERE rn <= 3"""
ORACLE["stream_ad_blacklist"] = ORACLE["ad_blacklist"]
ORACLE["stream_ad_click_trend"] = ORACLE["ad_click_trend"]

ORACLE["category_counts"] = _with(FILTERED, DETAIL, CATEGORY_COUNTS) + "SELECT * FROM counts"
ORACLE["session_detail"] = _with(FILTERED, DETAIL) + f"SELECT {DETAIL_COLS} FROM detail d"
ORACLE["session_sample_quotas"] = _with(FILTERED, SAMPLE) + "SELECT * FROM quotas"
ORACLE["page_transitions"] = _with() + """
SELECT session_id, event_id, page_id,
       lag(page_id) OVER (PARTITION BY session_id
                          ORDER BY CAST(action_time AS TIMESTAMP), event_id) AS prev_page
FROM actions"""
ORACLE["stream_ad_user_click_count"] = ORACLE["ad_user_click_count"]
ORACLE["stream_ad_stat_stateful"] = ORACLE["stream_ad_stat"]

# The blacklist feedback as a fold over three batches of days: a batch drops the
# users that earlier batches blacklisted. A day lies in one batch, so a user's
# day total is that batch's.
ORACLE["stream_feedback_stat"] = _with(AD_CLICKS + """
b1 AS (SELECT * FROM clicks WHERE date <= DATE '2024-01-10'),
k1 AS (SELECT DISTINCT user_id FROM (SELECT user_id, count(*) AS n FROM b1
       GROUP BY date, user_id, ad_id) WHERE n >= 5),
b2 AS (SELECT * FROM clicks WHERE date > DATE '2024-01-10' AND date <= DATE '2024-01-20'
       AND user_id NOT IN (SELECT user_id FROM k1)),
k2 AS (SELECT DISTINCT user_id FROM (SELECT user_id, count(*) AS n FROM b2
       GROUP BY date, user_id, ad_id) WHERE n >= 5),
b3 AS (SELECT * FROM clicks WHERE date > DATE '2024-01-20'
       AND user_id NOT IN (SELECT user_id FROM k1 UNION SELECT user_id FROM k2)),
kept AS (SELECT * FROM b1 UNION ALL SELECT * FROM b2 UNION ALL SELECT * FROM b3)""") + """
SELECT date, province, city, ad_id, count(*) AS click_count FROM kept GROUP BY 1, 2, 3, 4"""

ORACLE["reject_counts"] = """
SELECT 'ad_log' AS input, count(*) AS n_rows, count(*) FILTER (event_id % 97 = 0) AS rejected
FROM events
UNION ALL
SELECT 'action_time', count(*), count(*) FILTER (event_id % 89 = 0) FROM events"""

ORACLE["area_level_top3"] = ORACLE["area_top3_product"].replace(AREA_LEVEL, REGION_LEVEL)
ORACLE["sql_area_top3_product"] = ORACLE["area_top3_product"]
ORACLE["sql_ad_province_top3"] = ORACLE["stream_ad_province_top3"]

ORACLE["ad_trend_peak_10s"] = _ad_with() + """
SELECT day, ad_id, max(n) AS click_count,
       arg_max(window_start, (n, -start_ms)) AS window_start
FROM (SELECT start_ms, strftime(make_timestamp(start_ms * 1000), '%Y-%m-%d') AS day,
             strftime(make_timestamp(start_ms * 1000), '%Y-%m-%d %H:%M:%S') AS window_start,
             ad_id, count(*) AS n
      FROM (SELECT (ts_ms // 10000 - i) * 10000 AS start_ms, ad_id FROM clicks, range(360) AS r(i))
      GROUP BY start_ms, ad_id)
GROUP BY day, ad_id"""

ORACLE["stream_ad_crossing"] = _ad_with() + f"""
SELECT date, user_id, ad_id FROM user_counts WHERE click_count >= {P.BLACKLIST_THRESHOLD}"""

# Late data as a fold over four batches: every fourth click comes one batch after its days'.
# A batch's watermark is the newest time of all batches before it less five days.
ORACLE["stream_ad_lateness"] = _with(f"""arrived AS (
  SELECT epoch_us(ts) // 1000 AS ts_ms, CAST(ts AS DATE) AS date, strftime(ts, '%H:%M') AS minute,
         CASE WHEN user_id % 5 = 0 THEN 0 ELSE k % 10 END AS ad_id,
         CASE WHEN CAST(ts AS DATE) <= DATE '2024-01-10' THEN 0
              WHEN CAST(ts AS DATE) <= DATE '2024-01-20' THEN 1 ELSE 2 END
         + CASE WHEN event_id % 4 = 0 THEN 1 ELSE 0 END AS batch
  FROM ev),
newest AS (SELECT batch, max(ts_ms) AS ms FROM arrived GROUP BY batch),
marked AS (
  SELECT a.*, coalesce(ts_ms < (SELECT max(ms) FROM newest n WHERE n.batch < a.batch)
                               - {P.LATE_DELAY_MS}, FALSE) AS late
  FROM arrived a),
trend AS (SELECT date, minute, ad_id, count(*) AS n FROM marked WHERE NOT late GROUP BY 1, 2, 3)""") + """
SELECT date, count(*) FILTER (WHERE NOT late) AS on_time, count(*) FILTER (WHERE late) AS late,
       (SELECT count(*) FROM trend t WHERE t.date = m.date) AS trend_rows,
       CAST(coalesce((SELECT sum(n) FROM trend t WHERE t.date = m.date), 0) AS BIGINT)
         AS trend_clicks
FROM marked m GROUP BY date"""

ORACLE["stored_log_range"] = _with() + """
SELECT date, page_id, count(*) AS actions, count(DISTINCT session_id) AS sessions
FROM user_visit_action WHERE date BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'
GROUP BY date, page_id"""

ORACLE["task_run"] = (
    f"SELECT CAST(1 AS BIGINT) AS task_id, * FROM ({_funnel_sql((1, 2, 3, 4, 5, 6, 7))})\n"
    "UNION ALL\n"
    "SELECT CAST(2 AS BIGINT) AS task_id, * FROM (" + _funnel_sql((3, 5, 7, 3)).replace(
        "FROM actions)", "FROM actions WHERE date BETWEEN DATE '2024-01-08' "
        "AND DATE '2024-01-21')") + ")")

ORACLE["stream_ad_peak_10s"] = ORACLE["ad_trend_peak_10s"]
ORACLE["session_hour_keys"] = _with(FILTERED) + """
SELECT strftime(start_time, '%Y-%m-%d_%H') AS hour_key, count(*) AS sessions,
       min(strftime(start_time, '%Y%m%d%H%M')) AS first_minute,
       max(strftime(start_time, '%Y%m%d%H%M')) AS last_minute
FROM filtered GROUP BY 1"""
