import datetime as dt
from decimal import Decimal

from cartwheel.operators import funnel as fn
from cartwheel.operators import summary as sm
from cartwheel.operators import time_analysis as ta
from tests.micro import SCHEMA, funnel_rows


def test_activity_is_dense(spark):
    t = dt.datetime(2019, 10, 1, 9, 15)  # a Tuesday
    row = (1, t, "purchase", 1, 1, "A", "b", Decimal("12.50"), 7, "s")
    ev = spark.createDataFrame([row], SCHEMA)
    rows = ta.purchase_activity(ev).collect()
    assert len(rows) == 31
    nonzero = [(r.time_dimension, r.time_value) for r in rows if r.purchase_events]
    assert sorted(nonzero) == [("day_of_week", "Tuesday"), ("hour", "09")]
    assert all(r.view_users is None and r.view_to_cart_rate is None for r in rows)


def test_overall_funnel_and_kpis(spark):
    ev = spark.createDataFrame(funnel_rows(), SCHEMA)
    uf = fn.user_funnel(ev)
    o = {r.stage: (r.users, r.conversion_from_previous, r.overall_conversion)
         for r in sm.overall_funnel(uf).collect()}
    assert o["View"] == (8, 1.0, 1.0)
    assert o["Add to Cart"] == (6, 6 / 8, 6 / 8)
    assert o["Purchase"] == (5, 5 / 6, 5 / 8)
    k = sm.revenue_kpis(uf).collect()[0]
    assert (k.purchase_events, k.purchasing_users, k.total_revenue) == (10, 9, 65.0)
    assert [r.user_id for r in sm.purchase_only_users(uf).collect()] == [5]


def test_segment_sums_match_total(spark):
    ev = spark.createDataFrame(funnel_rows(), SCHEMA)
    seg = sm.segment_summary(fn.segment_funnel(ev, "price_band"), "price_band")
    tot = seg.groupBy().sum("purchase_events", "revenue").collect()[0]
    assert (tot[0], tot[1]) == (10, 65.0)
