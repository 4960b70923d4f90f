"""Column expressions shared by the operators.

All of these are native Catalyst expressions (no Python UDF), so they stay
inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the analysed pipeline's outputs exactly.
# ---------------------------------------------------------------------------
EVENT_TYPES = ["view", "cart", "remove_from_cart", "purchase"]
STAGES = ["view", "cart", "purchase"]
DESCRIPTIVE_COLUMNS = ["category_code", "brand", "user_session"]
UNKNOWN = "Unknown"
# Price band labels, in business order (the dash is U+2013 EN DASH).
PRICE_BANDS = ["$0", "$0–$50", "$50–$100", "$100–$250", "$250–$500",
               "$500–$1,000", "$1,000–$2,000", "$2,000+", "Unknown"]
# Upper-inclusive band edges, in the same order as the bands they close.
PRICE_EDGES = [50, 100, 250, 500, 1000, 2000]
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday",
            "Saturday", "Sunday"]
TIME_DIMENSIONS = ["hour", "day_of_week"]
ANALYSIS_TYPES = ["funnel_cohort", "purchase_activity"]
HIGH_VALUE_BANDS = ["$1,000–$2,000", "$2,000+"]
# Text tokens a pandas CSV reader treats as missing by default.
NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN",
               "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL",
               "NaN", "None", "n/a", "nan", "null"]
RAW_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss 'UTC'"
RATE_TOLERANCE = 1e-10
RECONCILE_TOLERANCE = 0.01
TIME_ANALYSIS_ROWS = 62
# ---------------------------------------------------------------------------


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def price_band(price="price") -> Column:
    """Band of one event from its own price (null → Unknown, 0 → $0,
    upper-inclusive edges, negative prices fall in the first paid band)."""
    p = col_(price)
    expr = F.when(p.isNull(), F.lit(UNKNOWN)).when(p == 0, F.lit("$0"))
    for edge, label in zip(PRICE_EDGES, PRICE_BANDS[1:7]):
        expr = expr.when(p <= edge, F.lit(label))
    return expr.otherwise(F.lit(PRICE_BANDS[7]))


def _rank_of(c, labels) -> Column:
    """1-based position of a label in a fixed list (null when absent)."""
    c = col_(c)
    expr = None
    for i, lab in enumerate(labels, start=1):
        expr = (F.when(c == lab, F.lit(i)) if expr is None
                else expr.when(c == lab, F.lit(i)))
    return expr


def price_band_rank(c="price_band") -> Column:
    return _rank_of(c, PRICE_BANDS)


def weekday_rank(c="time_value") -> Column:
    return _rank_of(c, WEEKDAYS)


def dimension_rank(c="time_dimension") -> Column:
    return _rank_of(c, TIME_DIMENSIONS)


def weekday_name(ts) -> Column:
    return F.date_format(col_(ts), "EEEE")


def hour_label(h) -> Column:
    """Two-digit zero-padded hour text."""
    return F.lpad(col_(h).cast("string"), 2, "0")


def rate(num, den) -> Column:
    """Plain division, NULL when the denominator is 0 or NULL."""
    return F.try_divide(col_(num).cast("double"), col_(den).cast("double"))


def add_rates(df, view="view_users", cart="cart_users", purchase="purchase_users"):
    return (df.withColumn("view_to_cart_rate", rate(cart, view))
              .withColumn("cart_to_purchase_rate", rate(purchase, cart))
              .withColumn("view_to_purchase_rate", rate(purchase, view)))


def money(c) -> Column:
    """Exact money type for sums (order-independent); cast to double on output."""
    return col_(c).cast("decimal(18,2)")


def null_tokens_to_null(c) -> Column:
    """Normalise the default missing-value text tokens to SQL NULL."""
    c = col_(c)
    return F.when(c.isin(NULL_TOKENS) | c.isNull(), F.lit(None).cast("string")).otherwise(c)


_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
_SCALE = "CAST(100000000000000000000 AS DECIMAL(21,0))"
_OFFSET = "CAST(9223372036854775808 AS DECIMAL(20,0))"
POS_SCALE = 10 ** 20
SEQ_OFFSET = 2 ** 63
NULL_TIME_MICROS = 9 * 10 ** 17   # beyond year 9999; 9e17 * 1e20 < 1e38


def event_pos(time="event_time", seq="seq") -> Column:
    """Total order of events packed into one ``decimal(38,0)``:
    ``micros(event_time) * 10^20 + (seq + 2^63)``.

    Ties in time are broken by ingestion order (``seq``, any long).  A
    single fixed-width value keeps ``min``/``max`` inside the hash aggregate
    (a struct would force a sort-based aggregate) and compares with one
    decimal comparison.
    """
    micros = F.expr(f"timestampdiff(MICROSECOND, {_EPOCH_NTZ}, cast({time} as timestamp_ntz))") \
        if isinstance(time, str) else F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), time.cast("timestamp_ntz"))
    # a missing time sorts after every real time (like NaT in a pandas sort)
    micros = F.coalesce(micros, F.lit(NULL_TIME_MICROS))
    s = col_(seq).cast("decimal(20,0)") + F.expr(_OFFSET)
    return (micros.cast("decimal(38,0)") * F.expr(_SCALE) + s).cast("decimal(38,0)")


def pos_time(pos) -> Column:
    """Event time (timestamp_ntz) back from a packed position."""
    micros = F.floor(col_(pos) / F.expr(_SCALE))
    secs = (micros.cast("decimal(38,0)") / F.lit(1_000_000)).cast("decimal(24,6)")
    t = F.expr(_EPOCH_NTZ) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)
    return F.when(micros < F.lit(NULL_TIME_MICROS), t)


def ntz_from_instant(ts) -> Column:
    """Wall-clock UTC ``timestamp_ntz`` of an instant, independent of the
    session time zone."""
    secs = (F.unix_micros(col_(ts)).cast("decimal(38,0)") / F.lit(1_000_000)).cast("decimal(24,6)")
    return F.expr(_EPOCH_NTZ) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)


def parse_raw_time_lenient(c) -> Column:
    """Raw ``yyyy-MM-dd HH:mm:ss UTC`` text → timestamp_ntz, NULL when it
    does not parse.  The zone is parsed from the text, so the result does
    not depend on the session time zone."""
    return ntz_from_instant(F.try_to_timestamp(col_(c), F.lit("yyyy-MM-dd HH:mm:ss z")))


def parse_iso_time_lenient(c) -> Column:
    """ISO-8601 wall-clock text (UTC, no zone) → timestamp_ntz or NULL."""
    return ntz_from_instant(F.try_to_timestamp(F.concat(col_(c), F.lit("Z"))))


def micros_ntz(ts) -> Column:
    """Microseconds since the epoch of a ``timestamp_ntz`` wall clock."""
    return F.expr(f"timestampdiff(MICROSECOND, {_EPOCH_NTZ}, cast({ts} as timestamp_ntz))") \
        if isinstance(ts, str) else F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), ts.cast("timestamp_ntz"))


def pos_seq(pos) -> Column:
    """Ingestion sequence back from a packed position."""
    s = col_(pos) - F.floor(col_(pos) / F.expr(_SCALE)).cast("decimal(38,0)") * F.expr(_SCALE)
    return (s - F.expr(_OFFSET)).cast("bigint")


def flag(cond: Column) -> Column:
    return cond.cast("int")
