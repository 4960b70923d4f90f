"""Exact de-duplication and duplicate profiling (E-05 .. E-07, D-28 .. D-30, F-15).

Duplicates are found with a hash aggregate on the nine columns.  The
partial (map-side) aggregate collapses copies of a row before the shuffle,
so even a group of copies holding a large share of all rows costs one row
per map task on the wire.  NULLs group together (null-equal duplicates).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.operators.skew import hot_keys_sampled, salted_join
from cartwheel.sources.events import DEDUP_COLUMNS


def dedup_exact(df: DataFrame, keys=DEDUP_COLUMNS, seq: str = "seq") -> DataFrame:
    """Global exact dedup keeping the first occurrence (smallest ``seq``)."""
    keys = [k for k in keys if k in df.columns]
    others = [c for c in df.columns if c not in keys and c != seq]
    aggs = [F.min(seq).alias(seq)] if seq in df.columns else []
    # columns outside the key (if any) are taken from the first occurrence
    aggs += [F.min_by(c, F.col(seq)).alias(c) for c in others] if seq in df.columns else \
            [F.first(c).alias(c) for c in others]
    if not aggs:
        return df.dropDuplicates(keys)
    return df.groupBy(*keys).agg(*aggs).select(*df.columns)


def _text(c: str, dtype: str):
    col = F.col(c)
    if dtype.startswith("timestamp"):
        col = F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    text = col.cast("string")
    return F.when(text.isNull(), F.lit("N")).otherwise(F.concat(F.length(text).cast("string"), F.lit(":"), text))


def fingerprint(df: DataFrame, keys=DEDUP_COLUMNS, name: str = "fingerprint") -> DataFrame:
    """128-bit row fingerprint (E-06): MD5 over the key columns rendered as
    text (fixed time format), each as its length and text or as NULL, which
    no text can imitate; the value is the same in any engine."""
    types = dict(df.dtypes)
    parts = [_text(c, types[c]) for c in keys]
    return df.withColumn(name, F.md5(F.concat(*parts)))


def duplicate_groups(df: DataFrame, keys=DEDUP_COLUMNS, seq: str = "seq") -> DataFrame:
    """One row per distinct key with its number of copies ``n`` and first ``seq``."""
    aggs = [F.count(F.lit(1)).alias("n")]
    if seq in df.columns:
        aggs.append(F.min(seq).alias("first_seq"))
    return df.groupBy(*keys).agg(*aggs)


def duplicate_flags(df: DataFrame, keys=DEDUP_COLUMNS, seq: str = "seq") -> DataFrame:
    """Both pandas-style duplicate flags in one pass (E-07):
    ``duplicate_after_first`` (``keep='first'``: every copy but the first)
    and ``duplicate_any`` (``keep=False``: every row of a repeated key).

    Only the repeated keys (a small share of the data) are looked up, after
    an aggregate with map-side combine; a row without a match is no
    duplicate.  The look-up side is broadcast if Spark finds it small, and
    keys with very many copies are salted across tasks otherwise."""
    keys = list(keys)
    g = duplicate_groups(df, keys, seq).where(F.col("n") > 1)
    hot = hot_keys_sampled(df, keys)
    j = salted_join(df, g, keys, hot, F.col(seq), how="left", null_safe=True)
    return (j.withColumn("duplicate_after_first", F.coalesce(F.col(seq) != F.col("first_seq"), F.lit(False)))
             .withColumn("duplicate_any", F.col("n").isNotNull())
             .drop("n", "first_seq"))


def mark_duplicates(df: DataFrame, keys=DEDUP_COLUMNS, keep="first", seq: str = "seq") -> DataFrame:
    """``is_duplicate`` flag like pandas ``duplicated(keep=...)``."""
    flags = duplicate_flags(df, keys, seq)
    chosen = "duplicate_any" if keep is False else "duplicate_after_first"
    return flags.withColumnRenamed(chosen, "is_duplicate").drop("duplicate_any", "duplicate_after_first")


def duplicate_profile(df: DataFrame, keys=DEDUP_COLUMNS) -> DataFrame:
    """Rows involved in duplication (keep=False count), excess rows
    (keep='first' count) and repeated keys (D-28)."""
    g = duplicate_groups(df, keys, seq="__none__")
    return g.agg(
        F.count(F.lit(1)).alias("distinct_rows"),
        F.sum("n").alias("total_rows"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("bigint").alias("rows_involved"),
        F.sum(F.col("n") - 1).cast("bigint").alias("excess_rows"),
        F.count_if(F.col("n") > 1).alias("repeated_keys"))


def duplicates_by_event_type(df: DataFrame, keys=DEDUP_COLUMNS) -> DataFrame:
    """Duplicate rows by event type, with distinct users and sessions
    involved (D-29)."""
    g = duplicate_groups(df, keys, seq="__none__").where(F.col("n") > 1)
    return g.groupBy("event_type").agg(
        F.sum("n").cast("bigint").alias("rows_involved"),
        F.sum(F.col("n") - 1).cast("bigint").alias("excess_rows"),
        F.countDistinct("user_id").alias("users"),
        F.countDistinct("user_session").alias("sessions"))


def duplicate_involvement(df: DataFrame, keys=DEDUP_COLUMNS) -> DataFrame:
    """Rows, distinct users and distinct sessions involved in duplication,
    over all event types (a user can have several)."""
    g = duplicate_groups(df, keys, seq="__none__").where(F.col("n") > 1)
    return g.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows_involved"),
                 F.countDistinct("user_id").alias("users"), F.countDistinct("user_session").alias("sessions"))


def repetition_histogram(df: DataFrame, keys=DEDUP_COLUMNS) -> DataFrame:
    """How many keys occur exactly n times, for each n (D-30)."""
    return (duplicate_groups(df, keys, seq="__none__")
            .groupBy(F.col("n").alias("copies")).agg(F.count(F.lit(1)).alias("keys")))


def duplicate_examples(df: DataFrame, n: int = 20, keys=DEDUP_COLUMNS,
                       order=("user_id", "event_time", "seq")) -> DataFrame:
    """First ``n`` rows that belong to a repeated key (F-15); top-k by a
    total order so the answer is deterministic."""
    m = mark_duplicates(df, keys, keep=False)
    return m.where("is_duplicate").drop("is_duplicate").orderBy(*order).limit(n)
