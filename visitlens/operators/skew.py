"""Explicit skew handling: salted two-stage aggregate (A9) and salted join.

Spark already aggregates partially before the shuffle and AQE splits
skewed sort-merge-join partitions, so these are for the cases those do
not cover: aggregates whose partial state is large (here the distinct
city list), and joins where AQE is off or the hot key sits on the side it
cannot split. The salt is a hash of the row (``xxhash64``), not
``rand()``, so a retried task puts each row in the same bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from visitlens.functions.columns import concat_long_string, salt

SALT = "_salt"


def salted_area_product_clicks(basic: DataFrame, buckets: int,
                               salt_cols: list[str] = ("event_id",)) -> DataFrame:
    """Per (area, product) click count and city list in two stages.

    Stage 1 groups by (area, product, salt), spreading a hot product over
    ``buckets`` reducers; stage 2 merges the partial rows: counts are
    **summed** and the city sets united. Same result as
    :func:`visitlens.operators.products.area_product_clicks`. ``salt_cols``
    must tell apart the rows of one group (a unique event id), otherwise a
    hot group's rows would share one salt.
    """
    stage1 = (basic.withColumn(SALT, salt(list(salt_cols), buckets))
              .groupBy("area", "product_id", SALT)
              .agg(F.count(F.lit(1)).alias("partial_count"),
                   F.collect_set(concat_long_string("city_id", "city_name", ":"))
                   .alias("partial_cities")))
    return (stage1.groupBy("area", "product_id")
            .agg(F.sum("partial_count").alias("click_count"),
                 F.array_join(F.array_sort(F.array_distinct(
                     F.flatten(F.collect_list("partial_cities")))), ",").alias("city_infos")))


def skew_join(big: DataFrame, small: DataFrame, key: str, buckets: int,
              salt_cols: list[str]) -> DataFrame:
    """Inner equi-join on ``key`` with the hot keys of the big side salted.

    A key with at least ``1 / (4 * buckets)`` of the big rows is hot, so
    there are at most ``4 * buckets`` of them and the driver may hold the
    list. A hot row gets a salt in [0, buckets) from a hash of ``salt_cols``,
    and the small side's rows of hot keys are copied once per salt; all other
    rows have salt 0 and one copy. Result equals ``big.join(small, key)``.
    """
    hot = hot_keys(big, key, 4 * buckets)
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    salted_big = big.withColumn(SALT, F.when(is_hot, salt(salt_cols, buckets)).otherwise(F.lit(0)))
    copies = small.withColumn(SALT, F.explode(
        F.when(is_hot, F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(F.array(F.lit(0)))))
    return salted_big.join(copies, [key, SALT]).drop(SALT)


def hot_keys(df: DataFrame, key: str, most: int) -> list:
    """The keys (at most ``most``) that hold at least ``1 / most`` of the rows."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    return [r[0] for r in counts.where(F.col("n") * most >= F.lit(total)).select(key).collect()]
