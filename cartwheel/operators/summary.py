"""Segment summaries and KPI tables (D-05 .. D-07, D-16 .. D-18, D-33, F-01, F-02, F-14)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.columns import add_rates, money, price_band_rank, rate

SUMMARY_METRICS = ["view_users", "cart_users", "purchase_users", "purchase_events", "revenue",
                   "view_to_cart_rate", "cart_to_purchase_rate", "view_to_purchase_rate"]


def funnel_totals(state: DataFrame, *group) -> DataFrame:
    """Sum of funnel flags, purchase events and exact revenue over a
    funnel state (one row per group).  Counts users, never events."""
    g = state.groupBy(*group) if group else state
    return g.agg(
        F.sum("viewed").cast("bigint").alias("view_users"),
        F.sum("added_to_cart").cast("bigint").alias("cart_users"),
        F.sum("purchased").cast("bigint").alias("purchase_users"),
        F.sum("purchase_count").cast("bigint").alias("purchase_events"),
        F.sum(money("purchase_revenue")).cast("double").alias("revenue"))


def segment_summary(state: DataFrame, segment: str, sort_key: bool = False) -> DataFrame:
    """Per-segment conversion and revenue (D-05 .. D-07).  Price bands come
    in business order, other segments by revenue (segment name breaks ties).
    Segment counts must not be added up to a user total (S8)."""
    out = add_rates(funnel_totals(state, segment))
    if segment == "price_band":
        out = out.withColumn("price_band_sort", price_band_rank("price_band"))
        out = out.orderBy("price_band_sort")
        if not sort_key:
            out = out.drop("price_band_sort")
        return out
    return out.orderBy(F.desc("revenue"), F.asc(segment))


def overall_funnel(user_state: DataFrame) -> DataFrame:
    """Stage table View / Add to Cart / Purchase (D-16, G-07)."""
    t = funnel_totals(user_state)
    return t.select(F.expr(
        "stack(3, 'View', 1, view_users, 1.0D, 1.0D, "
        "'Add to Cart', 2, cart_users, try_divide(cart_users * 1.0D, view_users), try_divide(cart_users * 1.0D, view_users), "
        "'Purchase', 3, purchase_users, try_divide(purchase_users * 1.0D, cart_users), try_divide(purchase_users * 1.0D, view_users)) "
        "AS (stage, stage_order, users, conversion_from_previous, overall_conversion)")
    ).orderBy("stage_order").drop("stage_order")


def revenue_kpis(user_state: DataFrame) -> DataFrame:
    """Total revenue, purchase events, purchasing users (any purchase) and
    the two averages (D-17)."""
    return (user_state.agg(
        F.sum(money("purchase_revenue")).cast("double").alias("total_revenue"),
        F.sum("purchase_count").cast("bigint").alias("purchase_events"),
        F.count_if(F.col("purchase_count") > 0).alias("purchasing_users"))
        .withColumn("revenue_per_purchasing_user", rate("total_revenue", "purchasing_users"))
        .withColumn("average_purchase_value", rate("total_revenue", "purchase_events")))


def executive_kpis(user_state: DataFrame) -> DataFrame:
    """Dashboard card values (D-18)."""
    return (user_state.agg(
        F.count(F.lit(1)).alias("total_users"),
        F.sum("viewed").cast("bigint").alias("view_users"),
        F.sum("added_to_cart").cast("bigint").alias("cart_users"),
        F.sum("purchased").cast("bigint").alias("buyers"),
        F.sum(money("purchase_revenue")).cast("double").alias("purchase_revenue"),
        F.count_if(F.col("purchase_count") > 0).alias("purchasing_users"))
        .withColumn("view_to_cart_rate", rate("cart_users", "view_users"))
        .withColumn("cart_to_purchase_rate", rate("buyers", "cart_users"))
        .withColumn("view_to_purchase_rate", rate("buyers", "view_users"))
        .withColumn("revenue_per_purchasing_user", rate("purchase_revenue", "purchasing_users")))


def purchase_only_users(user_state: DataFrame) -> DataFrame:
    """Users with purchases but no view (D-33, S7)."""
    return user_state.where((F.col("viewed") == 0) & (F.col("purchase_count") > 0))
