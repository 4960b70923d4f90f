"""Chronological View → Cart → Purchase funnel per key (D-01 .. D-04,
E-01 .. E-04, D-08 .. D-11, §4.3 ordered merge).

Semantics per key (user, or user × segment), in event order
``(event_time, seq)``:

* a cart qualifies only if a view of the key came before it;
* a purchase qualifies only if a qualifying cart came before it;
* ``viewed`` / ``added_to_cart`` / ``purchased`` flag any view / any
  qualifying cart / any qualifying purchase; first times are the minimum
  over those same events; ``purchase_count`` and ``purchase_revenue`` cover
  every purchase, qualifying or not; any other event type only creates the
  key's row.

Plan shape.  Rather than sorting every key's events and running windows
over them (which puts a hot key — one bot user can hold a third of all
rows — into a single task), the funnel is computed from *positions*:

1. one aggregation over all events per key: first view ``V``, first cart
   ``C``, first purchase ``P``, purchase count and revenue.  It is a
   partial + final hash aggregate, so a hot key is combined map-side before
   the shuffle;
2. only carts and purchases (a few percent of a clickstream) are joined to
   the per-key ``(V, C)`` row to get ``VC`` = first cart after ``V`` and
   ``CP`` = first purchase after ``C``;
3. only purchases are joined to ``VC`` to get ``VCP`` = first purchase
   after ``VC``.

The joins are lookups against one row per key; a hot key on the event side is
salted, and a small per-key side is broadcast by Catalyst's size check.  The
full event set is never shuffled.

``(V, C, P, VC, CP, VCP)`` is also the associative summary of an ordered
slice of events, so per-slice partials can be merged in time order
(:func:`merge_partials`, :func:`fold_slices`) for incremental runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.columns import event_pos, money, pos_time, price_band, UNKNOWN
from cartwheel.operators.joins import join_keys
from cartwheel.operators.skew import hot_keys, salted_join
from cartwheel.sources.sinks import materialize

POS_COLS = ["V", "C", "P", "VC", "CP", "VCP"]
PARTIAL_COLS = POS_COLS + ["purchase_count", "revenue_dec"]
FUNNEL_COLS = ["viewed", "added_to_cart", "purchased", "first_view_time",
               "first_cart_time", "first_purchase_time", "purchase_count",
               "purchase_revenue"]


def _prep(events: DataFrame, keys, time, seq, price, stages):
    v, c, p = stages
    et = F.col("event_type")
    ev = events.select(*keys, et.alias("event_type"), event_pos(time, seq).alias("_pos"),
                       money(price).alias("_price"))
    return ev, et == v, et == c, et == p


def _funnel_parts(events: DataFrame, keys: list[str], time: str = "event_time",
                  seq: str = "seq", price: str = "price", stages=("view", "cart", "purchase")):
    """Partials plus the per-key base aggregate (with row counts)."""
    keys = list(keys)
    ev, is_v, is_c, is_p = _prep(events, keys, time, seq, price, stages)
    pos = F.col("_pos")
    base = ev.groupBy(*keys).agg(
        F.min(F.when(is_v, pos)).alias("V"),
        F.min(F.when(is_c, pos)).alias("C"),
        F.min(F.when(is_p, pos)).alias("P"),
        F.count_if(is_p).alias("purchase_count"),
        F.sum(F.when(is_p, F.col("_price"))).alias("revenue_dec"),
        F.count(F.lit(1)).alias("_n_events"),
        F.count_if(is_c | is_p).alias("_n_cp"))
    # The per-key table feeds four consumers (hot-key detection, the two
    # lookups, the final join) that each need different columns; column
    # pruning would turn them into separate aggregations over all events.
    # A reliable checkpoint (one row per key, far smaller than the events)
    # makes the event scan + aggregate run exactly once.
    base = materialize(base)
    # Carts and purchases only (a few percent of a clickstream).  Keys with
    # very many of them are salted across tasks for the two lookup joins.
    hot = hot_keys(base, keys, "_n_cp")
    cp = ev.where(is_c | is_p).select(*keys, "event_type", "_pos")
    r2 = (salted_join(cp, base.where(F.col("C").isNotNull()).select(*keys, "V", "C"), keys, hot, "_pos")
          .groupBy(*keys).agg(
              F.min(F.when(is_c & (pos > F.col("V")), pos)).alias("VC"),
              F.min(F.when(is_p & (pos > F.col("C")), pos)).alias("CP")))
    # round 3: Catalyst pushes the purchase filter below the join, so only
    # purchases are shuffled for it
    r3 = (salted_join(cp, r2.where(F.col("VC").isNotNull()).select(*keys, "VC"), keys, hot, "_pos")
          .where(is_p & (pos > F.col("VC")))
          .groupBy(*keys).agg(F.min(pos).alias("VCP")))
    out = base.join(r2, keys, "left").join(r3, keys, "left")
    return out.select(*keys, *PARTIAL_COLS), base


def funnel_partials(events: DataFrame, keys: list[str], time: str = "event_time",
                    seq: str = "seq", price: str = "price",
                    stages=("view", "cart", "purchase")) -> DataFrame:
    """Per-key ordered summary: positions V, C, P, VC, CP, VCP (packed
    ``(event_time, seq)`` decimals, NULL when absent), ``purchase_count`` and
    exact ``revenue_dec``.

    Key columns must be non-null (the clean pipeline fills descriptive
    columns with 'Unknown'; ``quality_report`` counts null user ids)."""
    return _funnel_parts(events, keys, time, seq, price, stages)[0]


def finish(partials: DataFrame, keys: list[str]) -> DataFrame:
    """Public funnel row from a per-key summary."""
    def t(c):
        return pos_time(F.col(c))
    return partials.select(
        *keys,
        F.col("V").isNotNull().cast("int").alias("viewed"),
        F.col("VC").isNotNull().cast("int").alias("added_to_cart"),
        F.col("VCP").isNotNull().cast("int").alias("purchased"),
        t("V").alias("first_view_time"),
        t("VC").alias("first_cart_time"),
        t("VCP").alias("first_purchase_time"),
        F.coalesce(F.col("purchase_count"), F.lit(0)).cast("bigint").alias("purchase_count"),
        F.coalesce(F.col("revenue_dec"), F.lit(0)).cast("double").alias("purchase_revenue"))


def funnel(events: DataFrame, keys=("user_id",), **kw) -> DataFrame:
    """Funnel state, one row per key (D-01 .. D-04)."""
    keys = list(keys)
    return finish(funnel_partials(events, keys, **kw), keys)


def user_funnel(events: DataFrame, **kw) -> DataFrame:
    return funnel(events, ["user_id"], **kw)


SEGMENTS = {
    "category": "category_code",
    "brand": "brand",
    "price_band": "price_band",
}


def with_segment(events: DataFrame, segment: str) -> DataFrame:
    """Add the segment column an event belongs to (descriptive columns are
    null-filled; the price band comes from the event's own price)."""
    if segment == "price_band":
        return events.withColumn("price_band", price_band("price"))
    col = SEGMENTS.get(segment, segment)
    return events.withColumn(col, F.coalesce(F.col(col), F.lit(UNKNOWN)))


def segment_funnel(events: DataFrame, segment: str, **kw) -> DataFrame:
    """Independent funnel per (user, segment) (D-02 .. D-04, S8)."""
    col = SEGMENTS.get(segment, segment)
    return funnel(with_segment(events, segment), ["user_id", col], **kw)


def all_funnels(events: DataFrame, segments=SEGMENTS, **kw) -> DataFrame:
    """The user funnel and the funnels of all segments from one pass (D-01 ..
    D-04): one row per (user_id, segment_type, segment), the user funnel being
    segment_type ``user`` with an empty segment.

    Every event stands once for each kind of key, so the partial aggregate
    that precedes the exchange meets all of them in the same scan: three scans
    of the events and one exchange of partials a round for any number of
    segments, where separate funnels take three scans and an exchange each."""
    kinds = [F.struct(F.lit("user").alias("segment_type"), F.lit("").alias("segment"))]
    for name, col in segments.items():
        value = price_band("price") if name == "price_band" else F.coalesce(F.col(col), F.lit(UNKNOWN))
        kinds.append(F.struct(F.lit(name).alias("segment_type"), value.alias("segment")))
    each = events.select("user_id", "event_time", "seq", "event_type", "price", F.explode(F.array(*kinds)).alias("_kind"))
    return funnel(each.select("*", "_kind.*").drop("_kind"), ["user_id", "segment_type", "segment"], **kw)


def funnel_trace(events: DataFrame, keys=("user_id",), time: str = "event_time",
                 seq: str = "seq", **kw) -> DataFrame:
    """Event-level trace (E-01 .. E-04): each event with its running
    ``view_seen``, ``qualifying_cart``, ``cart_seen`` and
    ``qualifying_purchase`` flags, derived from the per-key positions by a
    lookup join (salted for hot keys) instead of a per-key sort."""
    keys = list(keys)
    parts, base = _funnel_parts(events, keys, time=time, seq=seq, **kw)
    st = parts.select(*keys, "V", "VC")
    pos = event_pos(time, seq)
    et = F.col("event_type")
    hot = hot_keys(base, keys, "_n_events")
    out = salted_join(events, st, keys, hot, pos, how="left")
    return (out
            .withColumn("view_seen", F.coalesce(F.col("V") <= pos, F.lit(False)).cast("int"))
            .withColumn("qualifying_cart", F.coalesce((et == "cart") & (F.col("V") < pos), F.lit(False)).cast("int"))
            .withColumn("cart_seen", F.coalesce(F.col("VC") <= pos, F.lit(False)).cast("int"))
            .withColumn("qualifying_purchase", F.coalesce((et == "purchase") & (F.col("VC") < pos), F.lit(False)).cast("int"))
            .drop("V", "VC"))


# ---------------------------------------------------------------------------
# Ordered merge of partial summaries (§4.3) — incremental / sliced runs.
# ---------------------------------------------------------------------------

def _merge_exprs(a: str, b: str):
    """Column expressions combining summary ``a`` (earlier) with ``b`` (later)."""
    A = lambda c: F.col(f"{a}.{c}")
    B = lambda c: F.col(f"{b}.{c}")
    return [
        F.coalesce(A("V"), B("V")).alias("V"),
        F.coalesce(A("C"), B("C")).alias("C"),
        F.coalesce(A("P"), B("P")).alias("P"),
        F.coalesce(A("VC"), F.when(A("V").isNotNull(), B("C")).otherwise(B("VC"))).alias("VC"),
        F.coalesce(A("CP"), F.when(A("C").isNotNull(), B("P")).otherwise(B("CP"))).alias("CP"),
        F.coalesce(A("VCP"),
                   F.when(A("VC").isNotNull(), B("P"))
                    .when(A("V").isNotNull(), B("CP"))
                    .otherwise(B("VCP"))).alias("VCP"),
        (F.coalesce(A("purchase_count"), F.lit(0)) + F.coalesce(B("purchase_count"), F.lit(0))).alias("purchase_count"),
        F.when(A("revenue_dec").isNull() & B("revenue_dec").isNull(), F.lit(None))
         .otherwise(F.coalesce(A("revenue_dec"), F.lit(0)) + F.coalesce(B("revenue_dec"), F.lit(0)))
         .cast("decimal(28,2)").alias("revenue_dec"),
    ]


def merge_partials(earlier: DataFrame, later: DataFrame, keys: list[str]) -> DataFrame:
    """Merge the summary of an earlier slice with a later one (D-11, C-04):
    full outer join on the key and the §4.3 combination.  Equals the
    summary of the concatenated slices when they do not overlap in
    ``(event_time, seq)``."""
    keys = list(keys)
    a = earlier.select(*keys, F.struct(*PARTIAL_COLS).alias("a"))
    b = later.select(*keys, F.struct(*PARTIAL_COLS).alias("b"))
    j = join_keys(a, b, keys, "full")
    return j.select(*keys, *_merge_exprs("a", "b"))


def fold_slices(partials: DataFrame, keys: list[str], slice_col: str) -> DataFrame:
    """Merge many per-(key, slice) summaries in slice order in one pass.

    Equivalent to folding :func:`merge_partials` over the slices, but
    expressed as aggregates: for a key, ``VC`` is ``VC`` of the slice holding
    the first view, else the first ``C`` of a later slice; ``CP`` and ``VCP``
    likewise.  The window groups hold one row per (key, slice), so their
    size is bounded by the number of slices, not by the number of events —
    use time buckets (days, hours) as slices, never row-count chunks, so a
    key's group stays bounded by the time span however many events it has.
    """
    keys = list(keys)
    w = Window.partitionBy(*keys)
    s = F.col(slice_col)
    x = (partials
         .withColumn("_b_v", F.min(F.when(F.col("V").isNotNull(), s)).over(w))
         .withColumn("_b_c", F.min(F.when(F.col("C").isNotNull(), s)).over(w))
         .withColumn("_vc", F.when(s == F.col("_b_v"), F.col("VC")).when(s > F.col("_b_v"), F.col("C")))
         .withColumn("_cp", F.when(s == F.col("_b_c"), F.col("CP")).when(s > F.col("_b_c"), F.col("P")))
         .withColumn("_vc_all", F.min("_vc").over(w))
         .withColumn("_b_vc", F.min(F.when(F.col("_vc") == F.col("_vc_all"), s)).over(w))
         .withColumn("_vcp", F.when(s == F.col("_b_vc"),
                                    F.when(F.col("_b_vc") == F.col("_b_v"), F.col("VCP")).otherwise(F.col("CP")))
                              .when(s > F.col("_b_vc"), F.col("P"))))
    return x.groupBy(*keys).agg(
        F.min("V").alias("V"), F.min("C").alias("C"), F.min("P").alias("P"),
        F.min("_vc").alias("VC"), F.min("_cp").alias("CP"), F.min("_vcp").alias("VCP"),
        F.sum("purchase_count").alias("purchase_count"),
        F.sum("revenue_dec").alias("revenue_dec"))


def sliced_funnel(events: DataFrame, keys: list[str], slice_expr, **kw) -> DataFrame:
    """Funnel computed per ordered slice and merged (I-02 / I-03 batch form)."""
    keys = list(keys)
    sl = events.withColumn("_slice", slice_expr)
    parts = funnel_partials(sl, keys + ["_slice"], **kw)
    return finish(fold_slices(parts, keys, "_slice"), keys)
