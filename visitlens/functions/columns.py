"""Column helpers.

All of them are compositions of built-in expressions, so they stay in
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

# Formats of the logged strings (fixed values).
ACTION_TIME_TEXT = r"^\d{4}-\d{2}-\d{2} \d{1,2}:\d{2}:\d{2}$"   # hour may have one digit
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
MINUTE_KEY_FORMAT = "yyyyMMddHHmm"
EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def not_empty(c) -> Column:
    """value is neither null nor the empty string."""
    return F.coalesce(_c(c), F.lit("")) != F.lit("")


def parse_action_time(c) -> Column:
    """'yyyy-MM-dd H:mm:ss' text -> TIMESTAMP_NTZ (hour with 1 or 2 digits).

    Text of another form, or no such time, gives null instead of an error.
    """
    padded = F.regexp_replace(_c(c), r" (\d):", " 0$1:")
    return F.when(_c(c).rlike(ACTION_TIME_TEXT), padded).try_cast("timestamp_ntz")


def bad_action_time(df) -> Column:
    """Whether a row's ``action_time`` is present but unreadable (a reject)."""
    return F.col("action_time").isNotNull() & parse_action_time("action_time").isNull()


def action_timestamp(df) -> Column:
    """The action time of a visit row: the stored ``action_ts`` when the
    table has it (no per-row parsing), else parsed from ``action_time``."""
    if "action_ts" in df.columns:
        return F.col("action_ts")
    return parse_action_time("action_time")


def format_time(c) -> Column:
    """timestamp -> 'yyyy-MM-dd HH:mm:ss'."""
    return F.date_format(_c(c), TIME_FORMAT)


def date_hour_key(c) -> Column:
    """timestamp -> 'yyyy-MM-dd_HH'."""
    return F.date_format(_c(c), "yyyy-MM-dd_HH")


def minute_key(c) -> Column:
    """timestamp -> 'yyyyMMddHHmm'."""
    return F.date_format(_c(c), MINUTE_KEY_FORMAT)


def epoch_millis(ts) -> Column:
    """Milliseconds since the epoch of a TIMESTAMP_NTZ, time-zone free."""
    return F.expr(f"timestampdiff(MILLISECOND, {EPOCH_NTZ}, {_sql(ts)})")


def ntz_from_millis(ms) -> Column:
    """TIMESTAMP_NTZ (UTC wall clock) of epoch milliseconds, time-zone free."""
    return F.expr(f"timestampadd(MILLISECOND, {_sql(ms)}, {EPOCH_NTZ})")


def _sql(c) -> str:
    if isinstance(c, str):
        return f"`{c}`"
    raise TypeError("pass a column name")


def ratio_half_up(num, den, scale: int = 2) -> Column:
    """F8: num/den rounded half-up to ``scale`` digits, by integer arithmetic.

    Exact for non-negative integer counts (29/200 -> 0.15); a zero or
    null denominator gives null. Identical in Spark and DuckDB.
    """
    m = 10 ** scale
    num, den = _c(num).cast("bigint"), _c(den).cast("bigint")
    top = F.lit(2 * m) * num + den
    bottom = F.lit(2) * den
    quotient = (top - top % bottom) / bottom      # exact integer division
    return F.when(den > 0, quotient / F.lit(float(m))).cast("double")


def slice_key(a, b) -> Column:
    """page slice key 'a_b'."""
    return F.concat_ws("_", _c(a).cast("string"), _c(b).cast("string"))


def csv_ids(c) -> Column:
    """Comma-separated ids -> array<bigint>; empty or malformed parts dropped."""
    parts = F.filter(F.split(F.coalesce(_c(c), F.lit("")), ","), lambda x: x != F.lit(""))
    return F.filter(F.transform(parts, lambda x: x.try_cast("bigint")),
                    lambda x: x.isNotNull())


def concat_long_string(a, b, sep: str = ":") -> Column:
    """U1: '<long><sep><string>'; null in, null out."""
    return F.concat(_c(a).cast("string"), F.lit(sep), _c(b))


def json_field(json, field: str) -> Column:
    """Value of a top-level JSON field as text; bad JSON -> null."""
    return F.get_json_object(_c(json), f"$.{field}")


def group_concat_distinct(c, sep: str = ",") -> Column:
    """Distinct values, sorted, joined (aggregate)."""
    return F.array_join(F.array_sort(F.collect_set(_c(c))), sep)


def salt(key_cols: list, n: int) -> Column:
    """U4: deterministic salt in [0, n) from a hash of the row's columns.

    A hash (not ``rand()``) keeps the salt identical when a task is
    retried, so a recomputed partition lands in the same buckets.
    """
    return F.pmod(F.xxhash64(*[_c(k) for k in key_cols]), F.lit(n)).cast("int")


SQL_FUNCTIONS = {
    # U1
    "concat_long_string":
        "(v BIGINT, s STRING, sep STRING) RETURNS STRING "
        "RETURN concat(cast(v AS STRING), sep, s)",
    # U2 with a bare field name
    "get_json_field":
        "(js STRING, field STRING) RETURNS STRING "
        "RETURN get_json_object(js, concat('$.', field))",
    # U4 / U5 as a separate salt column rather than a text prefix
    "salt_bucket":
        "(v STRING, n INT) RETURNS INT RETURN CAST(pmod(xxhash64(v), n) AS INT)",
}


def register_sql_functions(spark: SparkSession) -> None:
    """Register U1, U2, U4 as SQL functions (inlined by Catalyst).

    U3 is the built-in ``listagg(DISTINCT c, ',') WITHIN GROUP (ORDER BY c)``
    or ``array_join(array_sort(collect_set(c)), ',')``.
    """
    for name, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
