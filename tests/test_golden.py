"""Golden arithmetic: the published full-run totals pushed through our
expressions reproduce the published rates (plain double division, exact
money sums)."""

from pyspark.sql import functions as F

from cartwheel.functions.columns import rate
from cartwheel.operators import summary as sm

VIEW_USERS, CART_USERS, PURCHASE_USERS = 3_022_130, 336_764, 196_488
RATES = (0.11143266504088176, 0.583459039564799, 0.06501639572089883)


def test_overall_rates_match_published(spark):
    df = spark.createDataFrame([(VIEW_USERS, CART_USERS, PURCHASE_USERS)], "v long, c long, p long")
    got = df.select(rate("c", "v"), rate("p", "c"), rate("p", "v")).first()
    assert tuple(got) == RATES


def test_overall_funnel_table_from_totals(spark):
    # a state whose flag sums equal the published totals: three weighted rows
    state = spark.createDataFrame(
        [(1, VIEW_USERS - CART_USERS, 0, 0, 0, 0.0),
         (2, CART_USERS - PURCHASE_USERS, CART_USERS - PURCHASE_USERS, 0, 0, 0.0),
         (3, PURCHASE_USERS, PURCHASE_USERS, PURCHASE_USERS, 0, 0.0)],
        "user_id long, viewed long, added_to_cart long, purchased long, purchase_count long, purchase_revenue double")
    rows = sm.overall_funnel(state).collect()
    assert [(r.stage, r.users) for r in rows] == [("View", VIEW_USERS), ("Add to Cart", CART_USERS),
                                                 ("Purchase", PURCHASE_USERS)]
    assert (rows[1].conversion_from_previous, rows[2].conversion_from_previous, rows[2].overall_conversion) == RATES


def test_revenue_sum_is_exact(spark):
    # many two-decimal prices: the decimal sum has no floating-point drift
    df = spark.range(100_000).select((F.lit(0.1) + (F.col("id") % 7) * 0.01).alias("purchase_revenue"),
                                     F.lit(1).alias("purchase_count"))
    total = sm.revenue_kpis(df).first().total_revenue
    cents = sum(10 + i % 7 for i in range(100_000))      # 1 299 995
    assert total == cents / 100 == 12_999.95
