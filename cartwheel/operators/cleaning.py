"""Cleaning operators (B-01 .. B-05, B-16, A-11).

Typing, null handling and time features are one projection each; Catalyst
collapses them into a single whole-stage-codegen ``Project``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.columns import (
    DESCRIPTIVE_COLUMNS, EVENT_TYPES, RAW_TIME_FORMAT, UNKNOWN, null_tokens_to_null, parse_raw_time_lenient,
    weekday_name,
)

ID_COLUMNS = ["product_id", "category_id", "user_id"]


def _is_string(df: DataFrame, c: str) -> bool:
    return df.schema[c].dataType.simpleString() == "string"


def _parse_time(c: str, strict: bool):
    if strict:
        return F.to_timestamp_ntz(F.col(c), F.lit(RAW_TIME_FORMAT))
    # lenient: text that does not parse becomes NULL
    return parse_raw_time_lenient(c)


def standardize(df: DataFrame, strict: bool = True) -> DataFrame:
    """Type the raw columns (B-01).  ``strict`` casts raise on bad values
    under ANSI mode like the reference's hard casts; ``strict=False`` is the
    lenient coercion of B-02 (bad value → NULL)."""
    cols = []
    for c in df.columns:
        col = F.col(c)
        if c == "event_time" and _is_string(df, c):
            col = _parse_time(c, strict)
        elif c in ID_COLUMNS:
            col = col.cast("bigint") if strict else col.try_cast("bigint")
        elif c == "price" and _is_string(df, c):
            col = col.cast("double") if strict else col.try_cast("double")
        elif c == "event_type":
            col = col.cast("string")
        cols.append(col.alias(c))
    return df.select(*cols)


def coerce_lenient(df: DataFrame) -> DataFrame:
    return standardize(df, strict=False)


def normalize_null_tokens(df: DataFrame, columns=None) -> DataFrame:
    """Text tokens such as '', 'NA', 'null', 'None' → NULL (B-04)."""
    columns = [c for c in (columns or df.columns) if _is_string(df, c)]
    return df.select(*[null_tokens_to_null(c).alias(c) if c in columns else F.col(c) for c in df.columns])


def fill_unknown(df: DataFrame, columns=DESCRIPTIVE_COLUMNS) -> DataFrame:
    """Missing descriptive values become 'Unknown' (B-03)."""
    return df.fillna(UNKNOWN, subset=[c for c in columns if c in df.columns])


def add_time_features(df: DataFrame, time: str = "event_time") -> DataFrame:
    """event_date, event_hour, day_of_week (English name), day_of_month (B-05)."""
    t = F.col(time)
    return (df.withColumn("event_date", F.to_date(t))
              .withColumn("event_hour", F.hour(t))
              .withColumn("day_of_week", weekday_name(t))
              .withColumn("day_of_month", F.dayofmonth(t)))


# Record-quality rules (B-16 / Q-16); off by default in the clean pipeline.
QUALITY_RULES = {
    "negative_price": "price < 0",
    "invalid_product_id": "product_id <= 0",
    "invalid_category_id": "category_id <= 0",
    "invalid_user_id": "user_id <= 0",
    "unexpected_event_type": "event_type NOT IN ({})".format(", ".join(f"'{t}'" for t in EVENT_TYPES)),
}


def quality_filter(df: DataFrame) -> DataFrame:
    """Keep rows that break none of the quality rules; a NULL in a rule
    column does not count as a violation."""
    bad = None
    for rule in QUALITY_RULES.values():
        e = F.coalesce(F.expr(rule), F.lit(False))
        bad = e if bad is None else (bad | e)
    return df.where(~bad)


def clean_events(df: DataFrame, quality: bool = False, dedup: bool = True,
                 strict: bool = True) -> DataFrame:
    """Raw → clean events: types, null tokens, 'Unknown' fill, optional
    quality rules, exact de-duplication, time features.  De-duplication
    runs on the nine typed columns; the time features derive from
    ``event_time`` so they are added after it (smaller shuffle, same rows).
    """
    from cartwheel.operators.dedup import dedup_exact

    # missing-value tokens count as missing in every text column (a raw
    # price of 'NA' is missing, not a cast error)
    x = standardize(normalize_null_tokens(df), strict=strict)
    x = fill_unknown(x)
    if quality:
        x = quality_filter(x)
    if dedup:
        x = dedup_exact(x)
    return add_time_features(x)


def run_summary(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """Input rows, output rows, duplicates removed and duplicate rate % (A-11).
    Two global counts, each a partial + final aggregate."""
    n_in = raw.select(F.count(F.lit(1)).alias("input_rows"))
    n_out = clean.select(F.count(F.lit(1)).alias("output_rows"))
    return (n_in.select(F.col("input_rows"), n_out.select("output_rows").scalar().alias("output_rows"))
            .withColumn("duplicates_removed", F.col("input_rows") - F.col("output_rows"))
            .withColumn("duplicate_rate_pct",
                        F.try_divide(F.col("duplicates_removed").cast("double") * 100.0,
                                     F.col("input_rows").cast("double"))))
