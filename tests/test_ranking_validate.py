"""Rankings, thresholds and validation checks on small hand-made summaries."""

from pyspark.sql import functions as F

from cartwheel.functions.columns import add_rates
from cartwheel.operators import profile as pf
from cartwheel.operators import ranking as rk
from cartwheel.operators import validate as va

SCHEMA = "category_code string, view_users long, cart_users long, purchase_users long, purchase_events long, revenue double"


def _summary(spark, rows):
    return add_rates(spark.createDataFrame(rows, SCHEMA))


ROWS = [  # views, carts, buyers, purchase events, revenue
    ("a", 100, 20, 10, 12, 500.0),   # rate 0.10
    ("b", 400, 40, 8, 9, 900.0),     # rate 0.02
    ("c", 50, 10, 5, 5, 100.0),      # rate 0.10
    ("d", 300, 0, 0, 3, 0.0),        # rate 0.0, no carts → cart→purchase NULL
    ("e", 10, 5, 4, 4, 40.0),        # rate 0.40
]


def test_benchmarks_are_interpolated(spark):
    b = rk.benchmarks(_summary(spark, ROWS)).collect()[0]
    assert b.median_view_users == 100.0
    assert abs(b.median_view_to_purchase_rate - 0.10) < 1e-12
    assert b.p75_view_users == 300.0


def test_opportunities_and_stars(spark):
    s = _summary(spark, ROWS)
    # traffic ≥ median (100) and rate < median (0.10): b (0.02), d (0.0); by traffic
    assert [r.category_code for r in rk.category_opportunities(s).collect()] == ["b", "d"]
    # traffic ≥ median and rate ≥ median: a only (c and e have less traffic)
    assert [r.category_code for r in rk.stars(s, "category_code").collect()] == ["a"]


def test_top_k_ties_and_nulls_last(spark):
    s = _summary(spark, ROWS)
    best = [r.category_code for r in rk.top_k(s, "category_code", "cart_to_purchase_rate", 5).collect()]
    assert best[-1] == "d"                   # NULL rate sorts last
    asc = [r.category_code for r in rk.top_k(s, "category_code", "cart_to_purchase_rate", 5, ascending=True).collect()]
    assert asc[-1] == "d"                    # ... in both directions
    ties = [r.category_code for r in rk.top_k(s, "category_code", "view_to_purchase_rate", 3).collect()]
    assert ties == ["e", "a", "c"]           # equal rates broken by name


def test_weak_high_traffic(spark):
    s = _summary(spark, ROWS)
    # P75 of views = 300 → b (0.02) and d (0.0), weakest first
    assert [r.category_code for r in rk.weak_high_traffic(s, "category_code").collect()] == ["d", "b"]


def test_validation_flags_violations(spark):
    bad = ROWS + [("f", 5, 9, 7, 7, 0.0), ("a", 1, 1, 1, 1, 1.0)]
    s = _summary(spark, bad).withColumn(
        "view_to_cart_rate", F.when(F.col("category_code") == "c", F.lit(0.5)).otherwise(F.col("view_to_cart_rate")))
    rep = {r.check: r.violations for r in va.validate_summary(s, "category_code").collect()}
    assert rep["duplicate_key"] == 1
    assert rep["cart_gt_view"] == 1
    assert rep["purchase_gt_view"] == 1
    assert rep["rate_view_to_cart"] == 1
    assert rep["purchases_without_revenue"] == 2   # d has events but no revenue, f too
    assert rep["undefined_rate_vs_zero_cart"] == 0
    good = {r.check: r.passed for r in va.validate_summary(_summary(spark, ROWS), "category_code").collect()}
    assert good["rate_view_to_cart"] and good["duplicate_key"] and good["cart_gt_view"]


def test_missing_profile_and_metric_table(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a long, b string")
    prof = [(r.column_name, r.missing) for r in pf.missing_profile(df).collect()]
    assert prof == [("b", 2), ("a", 1)]
    long = {r.metric: r.value for r in pf.metric_table(spark.createDataFrame([(3, 2.5)], "x long, y double")).collect()}
    assert long == {"x": 3.0, "y": 2.5}


def test_order_check_detects_swapped_chunks(spark):
    import datetime as dt
    t = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    rows = [(0, t(1)), (0, t(2)), (1, t(10)), (1, t(11)), (2, t(5)), (2, t(6)), (3, t(12))]
    df = spark.createDataFrame(rows, "chunk long, event_time timestamp_ntz")
    bad = sorted(r.chunk for r in va.order_check(df).where(~F.col("in_order")).collect())
    assert bad == [2]


def test_faulty_tables_fail_every_planted_check(spark, sf_dir):
    from cartwheel.plans.catalog import QUERIES

    def failed(name):
        return {r["check"] for r in QUERIES[name](spark, sf_dir).where("not passed").collect()}

    assert {"duplicate_key", "missing_key", "negative_purchase_events", "cart_gt_view", "purchase_gt_cart", "purchase_gt_view",
            "rate_view_to_cart", "rate_view_to_purchase", "purchases_without_revenue"} <= failed("validate_category_faulty")
    assert {"duplicate_key", "negative_purchase_count", "negative_purchase_revenue", "cart_without_view",
            "purchase_without_cart"} <= failed("validate_user_funnel_faulty")
    assert {"duplicate_key", "row_count_vs_expected", "missing_hour", "missing_weekday", "unexpected_hour", "unexpected_weekday",
            "activity_hours_vs_24", "negative_metrics", "hierarchy", "rate_recompute"} <= failed("validate_time_faulty")
    labels = {tuple(r) for r in QUERIES["time_label_differences"](spark, sf_dir).collect()}
    assert {("funnel_cohort", "hour", "03", "missing"), ("purchase_activity", "hour", "03", "missing"), ("funnel_cohort", "hour", None, "unexpected"),
            ("purchase_activity", "day_of_week", "Mon", "unexpected"), ("funnel_cohort", "day_of_week", "Monday", "missing")} <= labels
    assert QUERIES["purchase_only_users_thinned"](spark, sf_dir).count() > 0
