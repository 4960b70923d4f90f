"""Time analysis (D-12 .. D-15, D-34, G-01, G-02, G-06, F-03).

Cohorts group *users* by the hour / weekday of their first view; activity
groups *purchase events* by their own hour / weekday.  Activity rows are
dense: a spine of 24 hours and 7 weekdays is left-joined so empty buckets
show zeros.  The spine has a fixed size, so broadcasting it is bounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.columns import (
    WEEKDAYS, add_rates, dimension_rank, hour_label, money, weekday_name, weekday_rank,
)
from cartwheel.operators.summary import funnel_totals

TIME_COLUMNS = ["analysis_type", "time_dimension", "time_value", "view_users", "cart_users",
                "purchase_users", "purchase_events", "revenue", "view_to_cart_rate",
                "cart_to_purchase_rate", "view_to_purchase_rate"]


def _hour(time: str):
    return "hour", hour_label(F.hour(time))


def _weekday(time: str):
    return "day_of_week", weekday_name(time)


def _by_dimension(df: DataFrame, *dimensions) -> DataFrame:
    """Every row once per (dimension, value), from one scan of ``df``."""
    pairs = [F.struct(F.lit(d).alias("time_dimension"), v.alias("time_value")) for d, v in dimensions]
    return df.select("*", F.explode(F.array(*pairs)).alias("_t")).select("*", "_t.*").drop("_t")


def _cohort(user_state: DataFrame, *dimensions) -> DataFrame:
    viewed = user_state.where(F.col("viewed") == 1)
    # one row per user in the state, so a row count is the distinct-user count
    t = funnel_totals(_by_dimension(viewed, *dimensions), "time_dimension", "time_value")
    return add_rates(t).withColumn("analysis_type", F.lit("funnel_cohort")).select(*TIME_COLUMNS)


def cohort_hour(user_state: DataFrame) -> DataFrame:
    """First-view-hour cohorts (only observed hours)."""
    return _cohort(user_state, _hour("first_view_time"))


def cohort_weekday(user_state: DataFrame) -> DataFrame:
    return _cohort(user_state, _weekday("first_view_time"))


def funnel_cohorts(user_state: DataFrame) -> DataFrame:
    """Both cohort tables in one pass over the user state."""
    return _cohort(user_state, _hour("first_view_time"), _weekday("first_view_time"))


def by_hour_and_weekday(events: DataFrame) -> DataFrame:
    """Every event once for its hour and once for its weekday."""
    return _by_dimension(events, _hour("event_time"), _weekday("event_time"))


def dense_activity(activity: DataFrame) -> DataFrame:
    """Activity rows of all hours and weekdays from (time_dimension,
    time_value, purchase_users, purchase_events, revenue) of observed ones."""
    spark = activity.sparkSession
    spine = _spine(spark, "hour").unionByName(_spine(spark, "day_of_week"))
    return _on_spine(spine, activity)


def _activity(events: DataFrame, spine: DataFrame, *dimensions) -> DataFrame:
    p = (_by_dimension(events.where(F.col("event_type") == "purchase"), *dimensions)
         .select("time_dimension", "time_value", "user_id", money(F.coalesce(F.col("price"), F.lit(0))).alias("price")))
    agg = p.groupBy("time_dimension", "time_value").agg(
        F.countDistinct("user_id").alias("purchase_users"),
        F.count(F.lit(1)).alias("purchase_events"),
        F.sum("price").cast("double").alias("revenue"))
    return _on_spine(spine, agg)


def _on_spine(spine: DataFrame, agg: DataFrame) -> DataFrame:
    out = F.broadcast(spine).join(agg, ["time_dimension", "time_value"], "left")
    null_long = F.lit(None).cast("bigint")
    null_dbl = F.lit(None).cast("double")
    return out.select(
        F.lit("purchase_activity").alias("analysis_type"),
        "time_dimension", "time_value",
        null_long.alias("view_users"), null_long.alias("cart_users"),
        F.coalesce("purchase_users", F.lit(0)).cast("bigint").alias("purchase_users"),
        F.coalesce("purchase_events", F.lit(0)).cast("bigint").alias("purchase_events"),
        F.coalesce("revenue", F.lit(0.0)).alias("revenue"),
        null_dbl.alias("view_to_cart_rate"), null_dbl.alias("cart_to_purchase_rate"),
        null_dbl.alias("view_to_purchase_rate"))


def hour_spine(spark) -> DataFrame:
    return spark.range(24).select(hour_label(F.col("id")).alias("time_value"))


def weekday_spine(spark) -> DataFrame:
    return spark.createDataFrame([(d,) for d in WEEKDAYS], "time_value string")


def _spine(spark, dimension: str) -> DataFrame:
    values = hour_spine(spark) if dimension == "hour" else weekday_spine(spark)
    return values.select(F.lit(dimension).alias("time_dimension"), "time_value")


def activity_hour(events: DataFrame) -> DataFrame:
    return _activity(events, _spine(events.sparkSession, "hour"), _hour("event_time"))


def activity_weekday(events: DataFrame) -> DataFrame:
    return _activity(events, _spine(events.sparkSession, "day_of_week"), _weekday("event_time"))


def purchase_activity(events: DataFrame) -> DataFrame:
    """Both activity tables in one pass over the purchases."""
    spine = _spine(events.sparkSession, "hour").unionByName(_spine(events.sparkSession, "day_of_week"))
    return _activity(events, spine, _hour("event_time"), _weekday("event_time"))


def order_time_rows(df: DataFrame) -> DataFrame:
    """analysis type, hour before weekday, hour number / Monday first (F-03)."""
    sort_value = F.coalesce(weekday_rank("time_value"), F.col("time_value").try_cast("int"))
    return df.orderBy("analysis_type", dimension_rank("time_dimension"), sort_value)


def with_day_order(df: DataFrame) -> DataFrame:
    """Reporting sort key ``day_order`` (F-14): Monday = 1 .. Sunday = 7."""
    return df.withColumn("day_order", weekday_rank("time_value"))


def time_analysis(user_state: DataFrame, events: DataFrame) -> DataFrame:
    """Cohorts ∪ dense activity, aligned columns and ordered (G-02)."""
    return order_time_rows(funnel_cohorts(user_state).unionByName(purchase_activity(events)))


def time_composition(time_df: DataFrame) -> DataFrame:
    """Rows per analysis type and time dimension (D-34)."""
    return time_df.groupBy("analysis_type", "time_dimension").agg(F.count(F.lit(1)).alias("rows"))
