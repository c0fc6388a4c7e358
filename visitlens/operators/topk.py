"""Top n rows per group.

One window with a rank filter. For ``n`` up to ``spark.sql.optimizer.
windowGroupLimitThreshold`` (1000 by default) Spark plans a window group
limit, so each map task keeps at most ``n`` rows per group before the
exchange and a hot group does not land whole in one task. The reports'
``n`` is 3 or 10; a larger draw is the stratified sample's case, which
cuts by its quotas first (:mod:`visitlens.operators.sampling`). The order
must be total (end it with a unique column).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_n_per_group(df: DataFrame, group_cols: list[str], order: list[Column | str], n: int,
                    rank_col: str = "rn") -> DataFrame:
    """Rows ranked 1..n in each group by ``order``, with ``rank_col`` added."""
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)
