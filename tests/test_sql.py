"""The SQL route gives the same rows as the DataFrame operators."""

from conftest import SF_MID
from visitlens.operators import ads as AD
from visitlens.plans import params as P
from visitlens.plans import sql as Q
from visitlens.plans.queries import QUERIES, Inputs


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_sql_route_matches_dataframe_route(spark):
    inp = Inputs(spark, SF_MID)
    clicks = inp.ad_clicks()
    Q.register_views(spark, inp.actions(), inp.users(), inp.products(), inp.cities(), clicks)
    lo, hi = (d.isoformat() for d in P.DATE_RANGE)
    area_sql = spark.sql(Q.area_top3_sql(lo, hi, P.TOP_PRODUCTS))
    area_df = QUERIES["area_top3_product"](spark, SF_MID)
    assert _rows(area_sql) == _rows(area_df.select(*area_sql.columns))
    prov_sql = spark.sql(Q.province_top3_sql(3))
    prov_df = AD.province_top_ads(AD.ad_stat(clicks), 3)
    assert _rows(prov_sql) == _rows(prov_df.select(*prov_sql.columns))
