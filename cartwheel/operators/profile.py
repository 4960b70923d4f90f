"""Data profiling (D-19 .. D-27, G-07).  All are plain aggregates with
map-side partial aggregation; exact distinct counts use Spark's two-phase
distinct aggregation (no driver-side sets)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def event_distribution(df: DataFrame) -> DataFrame:
    """Events per type, most frequent first; a missing type stays a row."""
    return (df.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))
            .orderBy(F.desc("events"), F.asc_nulls_last("event_type")))


def distinct_counts(df: DataFrame) -> DataFrame:
    """Exact distinct users, sessions, products and categories (NULLs dropped)."""
    return df.agg(
        F.countDistinct("user_id").alias("users"),
        F.countDistinct("user_session").alias("sessions"),
        F.countDistinct("product_id").alias("products"),
        F.countDistinct("category_id").alias("categories"))


def min_max(df: DataFrame) -> DataFrame:
    return df.agg(
        F.min("event_time").alias("min_event_time"), F.max("event_time").alias("max_event_time"),
        F.min("price").cast("double").alias("min_price"), F.max("price").cast("double").alias("max_price"))


def missing_profile(df: DataFrame, columns=None) -> DataFrame:
    """Missing count and percentage per column, most missing first (D-23).
    One aggregate row, then ``stack`` to one row per column."""
    columns = list(columns or df.columns)
    counts = df.agg(F.count(F.lit(1)).alias("__n"),
                    *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    long = counts.select(F.col("__n"), F.expr(f"stack({len(columns)}, {pairs}) AS (column_name, missing)"))
    return (long.select("column_name", F.col("missing").cast("bigint").alias("missing"),
                        F.try_divide(F.col("missing") * 100.0, F.col("__n").cast("double")).alias("missing_pct"))
            .orderBy(F.desc("missing"), "column_name"))


def missing_by_event(df: DataFrame, columns=("category_code", "brand")) -> DataFrame:
    return df.groupBy("event_type").agg(*[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in columns])


def zero_price_profile(df: DataFrame) -> DataFrame:
    """Zero-price rows, their share of all rows and distinct products (D-24, D-27)."""
    z = F.col("price") == 0
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(z).alias("zero_price_rows"),
        F.countDistinct(F.when(z, F.col("product_id"))).alias("zero_price_products")
    ).withColumn("zero_price_pct", F.try_divide(F.col("zero_price_rows") * 100.0, F.col("rows").cast("double")))


def zero_price_by_event(df: DataFrame) -> DataFrame:
    return (df.where(F.col("price") == 0).groupBy("event_type")
            .agg(F.count(F.lit(1)).alias("zero_price_rows")))


def zero_price_top(df: DataFrame, column: str, k: int = 20) -> DataFrame:
    """Most frequent values of ``column`` among zero-price rows (top ``k``)."""
    return (df.where((F.col("price") == 0) & F.col(column).isNotNull())
            .groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
            .orderBy(F.desc("rows"), F.asc(column)).limit(k))


def metric_table(df: DataFrame) -> DataFrame:
    """Wide one-row metrics → long (metric, value) table (G-07)."""
    cols = df.columns
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    return df.select(F.expr(f"stack({len(cols)}, {pairs}) AS (metric, value)"))
