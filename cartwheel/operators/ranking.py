"""Rankings, benchmarks and opportunity lists over summary tables
(D-31, B-10 .. B-15, F-04 .. F-13).

Summary tables hold one row per segment.  Thresholds (median, P75) are
computed as *scalar subqueries* (``DataFrame.scalar()``) — Spark evaluates
them once and inlines the value, no cross join and no driver round trip.
The summary is checkpointed first (reliable storage), so the funnel behind
it runs once rather than once per threshold.
Top-k uses ``orderBy(...).limit(k)`` → ``TakeOrderedAndProject`` (each task
keeps only its local top k).  Missing rates sort last in both directions
and compare false in filters; the segment name breaks ties.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.columns import HIGH_VALUE_BANDS, UNKNOWN
from cartwheel.sources.sinks import materialize

RATE = "view_to_purchase_rate"


def _order(by: str, ascending: bool, tie: str) -> list[Column]:
    first = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    return [first, F.col(tie).asc()]


def top_k(summary: DataFrame, segment: str, by: str, k: int | None = 10,
          ascending: bool = False) -> DataFrame:
    """Top ``k`` segments by a metric (F-04 / F-05); ``k=None`` sorts only."""
    out = summary.orderBy(*_order(by, ascending, segment))
    return out.limit(k) if k else out


def percentile_of(df: DataFrame, col: str, q: float) -> Column:
    """Exact interpolated percentile of a column as a scalar subquery
    (NULLs skipped, like pandas ``quantile``)."""
    return df.select(F.percentile(F.col(col), F.lit(q))).scalar()


def benchmarks(summary: DataFrame, rate_col: str = RATE) -> DataFrame:
    """Median traffic and median conversion, plus P75 traffic (D-31)."""
    return summary.agg(
        F.median("view_users").alias("median_view_users"),
        F.median(rate_col).alias("median_view_to_purchase_rate"),
        F.percentile("view_users", F.lit(0.75)).alias("p75_view_users"))


def best_conversion(summary: DataFrame, segment: str, min_views: int, k: int | None = 10) -> DataFrame:
    """Best converting segments with a minimum-traffic floor (F-06, B-14)."""
    return top_k(summary.where(F.col("view_users") >= min_views), segment, RATE, k)


def weak_high_traffic(summary: DataFrame, segment: str, k: int = 10, q: float = 0.75) -> DataFrame:
    """Segments at or above the P75 of traffic, weakest conversion first (F-07)."""
    summary = materialize(summary)
    thr = percentile_of(summary, "view_users", q)
    return top_k(summary.where(F.col("view_users") >= thr), segment, RATE, k, ascending=True)


def opportunities(summary: DataFrame, segment: str, traffic_q: float = 0.5, k: int | None = None,
                  exclude: list[str] | None = None) -> DataFrame:
    """The whole set (``k`` cuts it for display): high traffic (≥ quantile ``traffic_q``) but conversion below the
    median, by traffic (F-08 categories with q=0.5; F-10 brands with
    q=0.75 and ``exclude=['Unknown']``)."""
    summary = materialize(summary)
    base = summary.where(~F.col(segment).isin(exclude)) if exclude else summary
    thr = percentile_of(base, "view_users", traffic_q)
    med = percentile_of(base, RATE, 0.5)
    sel = base.where((F.col("view_users") >= thr) & (F.col(RATE) < med))
    return top_k(sel, segment, "view_users", k)


def category_opportunities(summary: DataFrame, k: int | None = None) -> DataFrame:
    return opportunities(summary, "category_code", 0.5, k)


def brand_opportunities(summary: DataFrame, k: int | None = None) -> DataFrame:
    return opportunities(summary, "brand", 0.75, k, exclude=[UNKNOWN])


def stars(summary: DataFrame, segment: str, k: int = 20) -> DataFrame:
    """Traffic ≥ median and conversion ≥ median, by revenue (F-09)."""
    summary = materialize(summary)
    v = percentile_of(summary, "view_users", 0.5)
    r = percentile_of(summary, RATE, 0.5)
    sel = summary.where((F.col("view_users") >= v) & (F.col(RATE) >= r))
    return top_k(sel, segment, "revenue", k)


def known(summary: DataFrame, segment: str, exclude=(UNKNOWN,)) -> DataFrame:
    """Drop placeholder segments such as 'Unknown' or '$0' (B-11)."""
    return summary.where(~F.col(segment).isin(list(exclude)))


def paid_bands(price_summary: DataFrame, by: str = RATE) -> DataFrame:
    """Price bands without ``$0``, by conversion or revenue (F-11)."""
    return top_k(known(price_summary, "price_band", ("$0",)), "price_band", by, None)


def high_value_weakest(price_summary: DataFrame) -> DataFrame:
    """High-value bands, weakest conversion first (F-11, B-12)."""
    return top_k(price_summary.where(F.col("price_band").isin(HIGH_VALUE_BANDS)),
                 "price_band", RATE, None, ascending=True)


def best_time(time_df: DataFrame, dimension: str, analysis: str = "funnel_cohort",
              by: str = RATE, min_views: int | None = None, k: int | None = 10) -> DataFrame:
    """Best first-view hours / days by conversion, or top purchase hours /
    days by revenue (F-12)."""
    x = time_df.where((F.col("analysis_type") == analysis) & (F.col("time_dimension") == dimension))
    if min_views is not None:
        x = x.where(F.col("view_users") >= min_views)
    return top_k(x, "time_value", by, k)


def quadrants(summary: DataFrame, segment: str, min_views: int) -> DataFrame:
    """Revenue × conversion quadrant per segment (F-13).  Only segments with
    traffic ≥ ``min_views`` and revenue > 0; cut points are the medians of
    that set.  Adds percent / million display columns (B-15)."""
    base = materialize(summary.where((F.col("view_users") >= min_views) & (F.col("revenue") > 0)))
    r_med = percentile_of(base, "revenue", 0.5)
    c_med = percentile_of(base, RATE, 0.5)
    hi_r = F.col("revenue") >= r_med
    hi_c = F.col(RATE) >= c_med
    label = (F.when(hi_r & hi_c, "strong performer")
             .when(hi_r, "optimization opportunity")
             .when(hi_c, "scalable performer")
             .otherwise("lower priority"))
    return base.select(segment, "view_users", "revenue", RATE,
                       (F.col(RATE) * 100).alias("view_to_purchase_pct"),
                       (F.col("revenue") / 1_000_000).alias("revenue_millions"),
                       label.alias("quadrant"))


def lookup(summary: DataFrame, segment: str, value: str, case_insensitive: bool = True) -> DataFrame:
    """Point lookup of one segment (B-13)."""
    c = F.col(segment)
    cond = (F.lower(c) == value.lower()) if case_insensitive else (c == value)
    return summary.where(cond)
