"""Validation reports (Q-01 .. Q-18, E-08, G-03).

Every check returns rows ``(check, violations, passed)``.  Checks over a
table are computed in one aggregate pass (``count_if`` per rule) and
unpivoted with ``stack``, so validating a large table is a single scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions.columns import (
    ANALYSIS_TYPES, EVENT_TYPES, PRICE_BANDS, RATE_TOLERANCE, RECONCILE_TOLERANCE,
    TIME_ANALYSIS_ROWS, TIME_DIMENSIONS, WEEKDAYS, money,
)
from cartwheel.operators.joins import join_keys
from cartwheel.operators.summary import SUMMARY_METRICS
from cartwheel.sources.sinks import materialize

REPORT_SCHEMA = "check string, violations bigint"

_COUNTS = ["view_users", "cart_users", "purchase_users", "purchase_events", "revenue"]


def _report(agg_row: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Unpivot a one-row aggregate of named checks into report rows; the
    check names are the aggregate's column names."""
    names = names or agg_row.columns
    pairs = ", ".join(f"'{n}', CAST(`{n}` AS BIGINT)" for n in names)
    return (agg_row.select(F.expr(f"stack({len(names)}, {pairs}) AS (check, violations)"))
            .withColumn("violations", F.coalesce(F.col("violations"), F.lit(0)).cast("bigint"))
            .withColumn("passed", F.col("violations") == 0))


def _const(spark: SparkSession, rows: list[tuple[str, int]]) -> DataFrame:
    return (spark.createDataFrame(rows, REPORT_SCHEMA)
            .withColumn("passed", F.col("violations") == 0))


def required_columns(df: DataFrame, required: list[str], name: str = "required_columns") -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    return _const(df.sparkSession, [(name, len(missing))])


def _dup_keys(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    d = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
         .agg(F.count_if(F.col("n") > 1).alias(name)))
    return _report(d, [name])


def _rate_check(num: str, den: str, rate: str):
    exp = F.try_divide(F.col(num).cast("double"), F.col(den).cast("double"))
    return F.count_if((F.col(den) > 0) & (F.col(rate).isNull() | (F.abs(F.col(rate) - exp) > RATE_TOLERANCE)))


def validate_summary(summary: DataFrame, key: str) -> DataFrame:
    """Checks of a segment summary (brand / category / price band)."""
    summary = materialize(summary)
    req = required_columns(summary, [key] + SUMMARY_METRICS)
    aggs = [F.count_if(F.col(key).isNull()).alias("missing_key")]
    aggs += [F.count_if(F.col(c) < 0).alias(f"negative_{c}") for c in _COUNTS]
    aggs += [
        F.count_if(F.col("cart_users") > F.col("view_users")).alias("cart_gt_view"),
        F.count_if(F.col("purchase_users") > F.col("cart_users")).alias("purchase_gt_cart"),
        F.count_if(F.col("purchase_users") > F.col("view_users")).alias("purchase_gt_view"),
        _rate_check("cart_users", "view_users", "view_to_cart_rate").alias("rate_view_to_cart"),
        _rate_check("purchase_users", "cart_users", "cart_to_purchase_rate").alias("rate_cart_to_purchase"),
        _rate_check("purchase_users", "view_users", "view_to_purchase_rate").alias("rate_view_to_purchase"),
        F.abs(F.count_if(F.col("cart_to_purchase_rate").isNull()) - F.count_if(F.col("cart_users") == 0))
         .alias("undefined_rate_vs_zero_cart"),
        F.count_if((F.col("purchase_events") > 0) & (F.col("revenue") == 0)).alias("purchases_without_revenue"),
    ]
    checks = [req, _dup_keys(summary, [key], "duplicate_key"), _report(summary.agg(*aggs))]
    if key == "price_band":
        checks.append(_report(summary.agg(F.count_if(~F.col(key).isin(PRICE_BANDS)).alias("unexpected_band")),
                              ["unexpected_band"]))
        exp = summary.sparkSession.createDataFrame([(b,) for b in PRICE_BANDS], "price_band string")
        # expected bands that are absent (informational set difference)
        absent = exp.join(summary.select(key), key, "left_anti").agg(F.count(F.lit(1)).alias("absent_band"))
        checks.append(_report(absent, ["absent_band"]).withColumn("passed", F.lit(True)))
    return reduce(DataFrame.unionByName, checks)


def validate_user_funnel(state: DataFrame, keys=("user_id",)) -> DataFrame:
    """Per-user checks: unique key, no missing key, no negatives, cart
    without view, purchase without cart (Q-03 .. Q-07)."""
    keys = list(keys)
    aggs = [F.count_if(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])).alias("missing_key"),
            F.count_if(F.col("purchase_count") < 0).alias("negative_purchase_count"),
            F.count_if(F.col("purchase_revenue") < 0).alias("negative_purchase_revenue"),
            F.count_if((F.col("added_to_cart") == 1) & (F.col("viewed") == 0)).alias("cart_without_view"),
            F.count_if((F.col("purchased") == 1) & (F.col("added_to_cart") == 0)).alias("purchase_without_cart"),
            F.count_if((F.col("purchased") == 1) & (F.col("purchase_count") == 0)).alias("purchased_without_events")]
    return _dup_keys(state, keys, "duplicate_key").unionByName(_report(state.agg(*aggs)))


def _among(c, values):
    """``isin`` that is false for NULL."""
    return F.coalesce(c.isin(list(values)), F.lit(False))


def validate_time(time_df: DataFrame, expected_rows: int = TIME_ANALYSIS_ROWS) -> DataFrame:
    """Time-analysis table checks (Q-02, Q-03, Q-05, Q-06, Q-08, Q-11, Q-14)."""
    time_df = materialize(time_df)
    hours = [f"{h:02d}" for h in range(24)]
    tv, td, at = F.col("time_value"), F.col("time_dimension"), F.col("analysis_type")
    act = at == "purchase_activity"
    coh = at == "funnel_cohort"
    aggs = [
        F.abs(F.count(F.lit(1)) - F.lit(expected_rows)).alias("row_count_vs_expected"),
        F.count_if(~_among(at, ANALYSIS_TYPES)).alias("unexpected_analysis_type"),
        F.count_if(~_among(td, TIME_DIMENSIONS)).alias("unexpected_dimension"),
        F.count_if((td == "hour") & ~_among(tv, hours)).alias("unexpected_hour"),
        F.count_if((td == "day_of_week") & ~_among(tv, WEEKDAYS)).alias("unexpected_weekday"),
        (F.lit(len(ANALYSIS_TYPES)) - F.countDistinct(F.when(_among(at, ANALYSIS_TYPES), at))).alias("missing_analysis_type"),
        (F.lit(len(TIME_DIMENSIONS)) - F.countDistinct(F.when(_among(td, TIME_DIMENSIONS), td))).alias("missing_dimension"),
        (F.lit(24) - F.countDistinct(F.when((td == "hour") & _among(tv, hours), tv))).alias("missing_hour"),
        (F.lit(7) - F.countDistinct(F.when((td == "day_of_week") & _among(tv, WEEKDAYS), tv))).alias("missing_weekday"),
        F.count_if(act & (td == "hour")).alias("activity_hours_vs_24"),
        F.count_if(act & (td == "day_of_week")).alias("activity_days_vs_7"),
        F.count_if(reduce(lambda a, b: a | b, [F.col(c) < 0 for c in _COUNTS])).alias("negative_metrics"),
        F.count_if(coh & ((F.col("cart_users") > F.col("view_users")) |
                          (F.col("purchase_users") > F.col("cart_users")))).alias("hierarchy"),
        (_rate_check("cart_users", "view_users", "view_to_cart_rate")
         + _rate_check("purchase_users", "cart_users", "cart_to_purchase_rate")
         + _rate_check("purchase_users", "view_users", "view_to_purchase_rate")).alias("rate_recompute"),
        F.count_if(act & (F.col("view_users").isNotNull() | F.col("cart_users").isNotNull()
                          | F.col("view_to_cart_rate").isNotNull() | F.col("cart_to_purchase_rate").isNotNull()
                          | F.col("view_to_purchase_rate").isNotNull())).alias("activity_funnel_fields_not_null"),
    ]
    rep = _report(time_df.agg(*aggs))
    fix = (F.when(F.col("check") == "activity_hours_vs_24", F.abs(F.col("violations") - 24))
           .when(F.col("check") == "activity_days_vs_7", F.abs(F.col("violations") - 7))
           .otherwise(F.col("violations")))
    rep = rep.withColumn("violations", fix.cast("bigint")).withColumn("passed", F.col("violations") == 0)
    dup = _dup_keys(time_df, ["analysis_type", "time_dimension", "time_value"], "duplicate_key")
    return required_columns(time_df, ["analysis_type", "time_dimension", "time_value"] + SUMMARY_METRICS) \
        .unionByName(dup).unionByName(rep)


def time_label_differences(time_df: DataFrame) -> DataFrame:
    """The labels behind Q-11, by name: (analysis_type, time_dimension,
    time_value) that every full table has but this one lacks (side =
    'missing') and those that no table should have ('unexpected', NULL
    labels included)."""
    labels = {"hour": [f"{h:02d}" for h in range(24)], "day_of_week": list(WEEKDAYS)}
    keys = ["analysis_type", "time_dimension", "time_value"]
    expected = time_df.sparkSession.createDataFrame(
        [(a, d, v) for a in ANALYSIS_TYPES for d in TIME_DIMENSIONS for v in labels[d]], ", ".join(f"{k} string" for k in keys))
    actual = materialize(time_df.select(*keys).distinct())
    return (join_keys(expected, actual, keys, "left_anti").withColumn("side", F.lit("missing"))
            .unionByName(join_keys(actual, expected, keys, "left_anti").withColumn("side", F.lit("unexpected"))))


def reconcile(time_df: DataFrame, user_state: DataFrame, events: DataFrame) -> DataFrame:
    """Totals that must agree (Q-13): hour-cohort users vs the overall
    funnel, activity events / revenue vs all purchase events.  Expected
    values are computed from the data, not hard-coded.  ``user_state`` is
    read several times, by ``time_df`` too: hand in a materialised one."""
    time_df = materialize(time_df)
    coh = time_df.where("analysis_type = 'funnel_cohort' AND time_dimension = 'hour'").agg(
        F.sum("view_users").alias("v"), F.sum("cart_users").alias("c"), F.sum("purchase_users").alias("p"))
    act = time_df.where("analysis_type = 'purchase_activity' AND time_dimension = 'hour'").agg(
        F.sum("purchase_events").alias("e"), F.sum(money("revenue")).alias("r"))
    fun = user_state.agg(F.sum("viewed").alias("v"), F.sum("added_to_cart").alias("c"),
                         F.sum("purchased").alias("p"))
    pur = events.where(F.col("event_type") == "purchase").agg(
        F.count(F.lit(1)).alias("e"), F.sum(money(F.coalesce(F.col("price"), F.lit(0)))).alias("r"))
    row = (coh.select(F.abs(F.col("v") - fun.select("v").scalar()).alias("cohort_view_users"),
                      F.abs(F.col("c") - fun.select("c").scalar()).alias("cohort_cart_users"),
                      F.abs(F.col("p") - fun.select("p").scalar()).alias("cohort_purchase_users"),
                      F.abs(act.select("e").scalar() - pur.select("e").scalar()).alias("activity_purchase_events"),
                      (F.abs(act.select("r").scalar() - pur.select("r").scalar()) > RECONCILE_TOLERANCE)
                      .cast("bigint").alias("activity_revenue")))
    return _report(row, ["cohort_view_users", "cohort_cart_users", "cohort_purchase_users",
                         "activity_purchase_events", "activity_revenue"])


def quality_report(raw: DataFrame, clean: DataFrame | None = None) -> DataFrame:
    """Cleaning report (Q-16 .. Q-18): rule violations on the raw events,
    plus remaining exact duplicates in the clean events."""
    from cartwheel.sources.events import DEDUP_COLUMNS
    aggs = [
        F.count_if(F.col("price") < 0).alias("negative_price"),
        F.count_if(F.col("product_id") <= 0).alias("nonpositive_product_id"),
        F.count_if(F.col("category_id") <= 0).alias("nonpositive_category_id"),
        F.count_if(F.col("user_id") <= 0).alias("nonpositive_user_id"),
        F.count_if(F.col("event_time").isNull() | F.col("event_type").isNull() | F.col("product_id").isNull()
                   | F.col("user_id").isNull()).alias("null_critical_field"),
        F.count_if(F.col("price").isNull()).alias("null_price"),
        F.count_if(F.col("category_id").isNull()).alias("null_category_id"),
        F.count_if(~F.col("event_type").isin(EVENT_TYPES)).alias("unexpected_event_type"),
    ]
    rep = _report(raw.agg(*aggs))
    if clean is not None:
        d = (clean.groupBy(*DEDUP_COLUMNS).agg(F.count(F.lit(1)).alias("n"))
             .agg(F.sum(F.col("n") - 1).alias("remaining_duplicates")))
        rep = rep.unionByName(_report(d, ["remaining_duplicates"]))
    return rep


def order_check(events: DataFrame, chunk_col: str = "chunk", time: str = "event_time") -> DataFrame:
    """Chronological chunk check (E-08): a chunk's earliest event must not
    precede the latest event of the chunk before it (equal allowed).  The
    per-chunk table is joined to itself shifted by one — an equi-join, so
    it stays distributed however many chunks there are."""
    per = events.groupBy(chunk_col).agg(F.min(time).alias("min_time"), F.max(time).alias("max_time"))
    prev = per.select((F.col(chunk_col) + 1).alias(chunk_col), F.col("max_time").alias("prev_max_time"))
    out = join_keys(per, prev, [chunk_col], "left")
    return out.withColumn("in_order", F.coalesce(F.col("min_time") >= F.col("prev_max_time"), F.lit(True)))


def set_difference(actual: DataFrame, expected: DataFrame, col: str) -> DataFrame:
    """Values missing from ``actual`` and values not expected (G-03)."""
    a = actual.select(col).distinct()
    e = expected.select(col).distinct()
    return (e.join(a, col, "left_anti").withColumn("side", F.lit("missing"))
            .unionByName(a.join(e, col, "left_anti").withColumn("side", F.lit("unexpected"))))
