"""visitlens: e-commerce behaviour analytics on PySpark.

Batch analyses over visit logs (sessions, categories, page funnel, area
products) and an ad-click stream (blacklist, running totals, top ads,
minute trends), all written with DataFrames, Spark SQL and Structured
Streaming.
"""

from visitlens.session import get_spark, scratch_dir

__all__ = ["get_spark", "scratch_dir"]
