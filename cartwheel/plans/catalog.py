"""Named queries over the test tables: ``name -> f(spark, sf_dir) -> DataFrame``.

Each query reads the given tables (through the event adapter) and runs one
operator of the library over the whole data.  Parameters that depend on
scale (traffic floors) are fixed here once.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions.columns import RAW_TIME_FORMAT, micros_ntz, parse_iso_time_lenient
from cartwheel.operators import cleaning as cl
from cartwheel.operators import dedup as dd
from cartwheel.operators import funnel as fn
from cartwheel.operators import incremental as inc
from cartwheel.operators import profile as pf
from cartwheel.operators import ranking as rk
from cartwheel.operators import summary as sm
from cartwheel.operators import time_analysis as ta
from cartwheel.operators import validate as va
from cartwheel.sources.adapter import CHUNK_ROWS, chunk_of, shop_events
from cartwheel.sources.events import DEDUP_COLUMNS, head_sample, prefix_run
from cartwheel.sources.sinks import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# ---------------------------------------------------------------------------
# Fixed query parameters.
# ---------------------------------------------------------------------------
HEAD_ROWS = 100
PREFIX_CHUNKS = 3
MIN_VIEWS_SEGMENT = 20        # reference: 10 000 views on the full data
MIN_VIEWS_HOUR = 5            # reference: 50 000 views on the full data
LOOKUP_BRAND = "brand#22"     # case-insensitive point lookup
TOP_K = 10
# ---------------------------------------------------------------------------

EVENT_COLS = ["seq"] + DEDUP_COLUMNS


def q(name: str):
    def deco(f):
        QUERIES[name] = f
        return f
    return deco


def _dbl_price(df: DataFrame) -> DataFrame:
    return df.withColumn("price", F.col("price").cast("double"))


def shop(spark, d, variant="base", columns=None) -> DataFrame:
    return shop_events(spark, d, variant, columns)


_CLEAN_TABLES: dict[tuple, str] = {}


def _source_stamp(spark, d) -> tuple:
    """Number and hash of (path, size, modification time) of every file of
    the source tables, so that a changed part file is noticed.  Listed by
    Spark; no file is opened."""
    out = []
    for t in ("events", "part"):
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{d.rstrip('/')}/{t}.parquet")
                 .select("path", "length", "modificationTime"))
        out.append(tuple(files.agg(F.count("*"), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))).first()))
    return tuple(out)


def clean(spark, d, variant="base") -> DataFrame:
    """Cleaned events (null tokens, 'Unknown' fill, exact dedup, time features).

    Like the reference pipeline (clean once, then every analysis reads the
    clean file), the base variant is written once per application and input
    version as a Parquet table under the shared checkpoint root; downstream
    queries scan it (column pruning and ``event_type`` pushdown apply, and
    the lineage to the raw scan is cut).  The ``clean_events`` query itself
    always recomputes, so cleaning cost stays measured."""
    if variant != "base":
        return cl.clean_events(shop(spark, d, variant))
    from cartwheel.session import path_exists, scratch_path
    key = (spark.sparkContext.applicationId, d.rstrip("/"), _source_stamp(spark, d))
    path = _CLEAN_TABLES.get(key)
    if path is None or not path_exists(spark, f"{path}/_SUCCESS"):
        path = scratch_path(spark, "clean-events-table")
        cl.clean_events(shop(spark, d)).write.mode("overwrite").parquet(path)
        _CLEAN_TABLES[key] = path
    return spark.read.parquet(path)


def user_state(spark, d) -> DataFrame:
    return fn.user_funnel(clean(spark, d))


def seg_state(spark, d, seg) -> DataFrame:
    return fn.segment_funnel(clean(spark, d), seg)


def seg_summary(spark, d, seg, sort_key=False) -> DataFrame:
    col = fn.SEGMENTS[seg]
    return sm.segment_summary(seg_state(spark, d, seg), col, sort_key=sort_key)


def time_table(spark, d) -> DataFrame:
    ev = clean(spark, d)
    return ta.time_analysis(fn.user_funnel(ev), ev)


def _text(df: DataFrame) -> DataFrame:
    """Events as the raw text export would carry them."""
    return df.select(
        "seq",
        F.date_format("event_time", RAW_TIME_FORMAT).alias("event_time"),
        "event_type",
        *[F.col(c).cast("string").alias(c) for c in
          ["product_id", "category_id", "category_code", "brand", "price", "user_id", "user_session"]])


def _mid_chunk(ev: DataFrame):
    """Middle chunk number, as a scalar subquery over the data."""
    return ev.select(F.floor((F.max(chunk_of()) + 1) / 2)).scalar()


# 1. sources -----------------------------------------------------------------
@q("scan_projected")
def _(spark, d):
    return _dbl_price(shop(spark, d, columns=["seq", "event_time", "event_type", "price", "user_id"]))


@q("head_sample")
def _(spark, d):
    return _dbl_price(head_sample(shop(spark, d), HEAD_ROWS).select(*EVENT_COLS))


@q("prefix_run")
def _(spark, d):
    ev = prefix_run(cl.clean_events(shop(spark, d)), PREFIX_CHUNKS, CHUNK_ROWS)
    return fn.user_funnel(ev)


# 2. cleaning ----------------------------------------------------------------
@q("standardize_types")
def _(spark, d):
    return cl.standardize(_text(shop(spark, d))).select(*EVENT_COLS)


@q("coerce_lenient")
def _(spark, d):
    t = _text(shop(spark, d))
    s = F.col("seq")
    t = (t.withColumn("price", F.when(s % 211 == 0, F.lit("n/a")).otherwise(F.col("price")))
          .withColumn("product_id", F.when(s % 503 == 0, F.lit("bad-id")).otherwise(F.col("product_id")))
          .withColumn("event_time", F.when(s % 307 == 0, F.lit("not a time")).otherwise(F.col("event_time"))))
    return cl.coerce_lenient(t).select(*EVENT_COLS)


@q("fill_unknown")
def _(spark, d):
    x = cl.fill_unknown(cl.normalize_null_tokens(shop(spark, d), ["category_code", "brand", "user_session"]))
    return x.select("seq", "category_code", "brand", "user_session")


@q("time_features")
def _(spark, d):
    return cl.add_time_features(shop(spark, d, columns=["event_time"])).select(
        "seq", "event_date", "event_hour", "day_of_week", "day_of_month")


@q("quality_filter")
def _(spark, d):
    return _dbl_price(cl.quality_filter(shop(spark, d, "dirty")).select(*EVENT_COLS))


@q("clean_events")
def _(spark, d):
    return _dbl_price(clean(spark, d, "duplicates"))


@q("run_summary")
def _(spark, d):
    return cl.run_summary(shop(spark, d, "duplicates"), clean(spark, d, "duplicates"))


# 3. dedup -------------------------------------------------------------------
@q("dedup_exact")
def _(spark, d):
    return _dbl_price(dd.dedup_exact(shop(spark, d, "duplicates")))


@q("event_fingerprint")
def _(spark, d):
    return dd.fingerprint(shop(spark, d)).select("seq", "fingerprint")


@q("dup_profile")
def _(spark, d):
    return dd.duplicate_profile(shop(spark, d, "duplicates"))


@q("dup_by_event_type")
def _(spark, d):
    return dd.duplicates_by_event_type(shop(spark, d, "duplicates"))


@q("dup_histogram")
def _(spark, d):
    return dd.repetition_histogram(shop(spark, d, "duplicates"))


@q("dup_examples")
def _(spark, d):
    return _dbl_price(dd.duplicate_examples(shop(spark, d, "duplicates"), 20).select(*EVENT_COLS))


# 4. funnels -----------------------------------------------------------------
@q("funnel_trace")
def _(spark, d):
    return fn.funnel_trace(clean(spark, d)).select(
        "seq", "user_id", "event_type", "event_time", "view_seen", "qualifying_cart",
        "cart_seen", "qualifying_purchase")


@q("user_funnel")
def _(spark, d):
    return user_state(spark, d)


@q("category_state")
def _(spark, d):
    return seg_state(spark, d, "category")


@q("brand_state")
def _(spark, d):
    return seg_state(spark, d, "brand")


@q("price_state")
def _(spark, d):
    return seg_state(spark, d, "price_band")


# 5. summaries ---------------------------------------------------------------
@q("category_summary")
def _(spark, d):
    return seg_summary(spark, d, "category")


@q("brand_summary")
def _(spark, d):
    return seg_summary(spark, d, "brand")


@q("price_band_summary")
def _(spark, d):
    return seg_summary(spark, d, "price_band", sort_key=True)


@q("overall_funnel")
def _(spark, d):
    return sm.overall_funnel(user_state(spark, d))


@q("revenue_kpis")
def _(spark, d):
    return sm.revenue_kpis(user_state(spark, d))


@q("executive_kpis")
def _(spark, d):
    return sm.executive_kpis(user_state(spark, d))


@q("purchase_only_users")
def _(spark, d):
    return sm.purchase_only_users(user_state(spark, d))


# 6. time --------------------------------------------------------------------
@q("cohort_hour")
def _(spark, d):
    return ta.cohort_hour(user_state(spark, d))


@q("cohort_weekday")
def _(spark, d):
    return ta.cohort_weekday(user_state(spark, d))


@q("activity_hour")
def _(spark, d):
    return ta.activity_hour(clean(spark, d))


@q("activity_weekday")
def _(spark, d):
    return ta.activity_weekday(clean(spark, d))


@q("time_analysis")
def _(spark, d):
    return ta.with_day_order(time_table(spark, d))


@q("time_composition")
def _(spark, d):
    return ta.time_composition(time_table(spark, d))


# 7. rankings ----------------------------------------------------------------
@q("top_traffic_category")
def _(spark, d):
    return rk.top_k(seg_summary(spark, d, "category"), "category_code", "view_users", TOP_K)


@q("top_traffic_brand")
def _(spark, d):
    return rk.top_k(seg_summary(spark, d, "brand"), "brand", "view_users", TOP_K)


@q("top_revenue_category")
def _(spark, d):
    return rk.top_k(seg_summary(spark, d, "category"), "category_code", "revenue", 15)


@q("top_revenue_brand")
def _(spark, d):
    return rk.top_k(rk.known(seg_summary(spark, d, "brand"), "brand"), "brand", "revenue", 20)


@q("best_conversion_category")
def _(spark, d):
    return rk.best_conversion(seg_summary(spark, d, "category"), "category_code", MIN_VIEWS_SEGMENT)


@q("best_conversion_brand")
def _(spark, d):
    return rk.best_conversion(seg_summary(spark, d, "brand"), "brand", MIN_VIEWS_SEGMENT)


@q("weak_high_traffic_category")
def _(spark, d):
    return rk.weak_high_traffic(seg_summary(spark, d, "category"), "category_code")


@q("weak_high_traffic_brand")
def _(spark, d):
    return rk.weak_high_traffic(seg_summary(spark, d, "brand"), "brand")


@q("benchmarks")
def _(spark, d):
    return rk.benchmarks(seg_summary(spark, d, "category"))


@q("category_opportunities")
def _(spark, d):
    return rk.category_opportunities(seg_summary(spark, d, "category"))


@q("category_stars")
def _(spark, d):
    return rk.stars(seg_summary(spark, d, "category"), "category_code")


@q("brand_opportunities")
def _(spark, d):
    return rk.brand_opportunities(seg_summary(spark, d, "brand"))


@q("paid_bands")
def _(spark, d):
    return rk.paid_bands(seg_summary(spark, d, "price_band"))


@q("paid_bands_revenue")
def _(spark, d):
    return rk.paid_bands(seg_summary(spark, d, "price_band"), by="revenue")


@q("high_value_weakest")
def _(spark, d):
    return rk.high_value_weakest(seg_summary(spark, d, "price_band"))


@q("zero_band")
def _(spark, d):
    return seg_summary(spark, d, "price_band").where(F.col("price_band") == "$0")


@q("best_hours")
def _(spark, d):
    return rk.best_time(time_table(spark, d), "hour", min_views=MIN_VIEWS_HOUR)


@q("best_days")
def _(spark, d):
    return rk.best_time(time_table(spark, d), "day_of_week", k=None)


@q("top_purchase_hours")
def _(spark, d):
    return rk.best_time(time_table(spark, d), "hour", "purchase_activity", by="revenue")


@q("top_purchase_days")
def _(spark, d):
    return rk.best_time(time_table(spark, d), "day_of_week", "purchase_activity", by="revenue", k=None)


@q("quadrants")
def _(spark, d):
    return rk.quadrants(seg_summary(spark, d, "brand"), "brand", MIN_VIEWS_SEGMENT)


@q("segment_lookup")
def _(spark, d):
    return rk.lookup(seg_summary(spark, d, "brand"), "brand", LOOKUP_BRAND)


# 8. profiling ---------------------------------------------------------------
@q("row_count")
def _(spark, d):
    return pf.row_count(shop(spark, d, columns=["seq"]))


@q("event_distribution")
def _(spark, d):
    return pf.event_distribution(shop(spark, d, columns=["event_type"]))


@q("distinct_counts")
def _(spark, d):
    return pf.distinct_counts(shop(spark, d))


@q("min_max")
def _(spark, d):
    return pf.min_max(shop(spark, d))


@q("missing_profile")
def _(spark, d):
    return pf.missing_profile(shop(spark, d, "missing_price"), DEDUP_COLUMNS)


@q("missing_by_event")
def _(spark, d):
    return pf.missing_by_event(shop(spark, d))


@q("zero_price_profile")
def _(spark, d):
    return pf.zero_price_profile(shop(spark, d, columns=["product_id", "price"]))


@q("zero_price_by_event")
def _(spark, d):
    return pf.zero_price_by_event(shop(spark, d, columns=["event_type", "price"]))


@q("zero_price_top_category")
def _(spark, d):
    return pf.zero_price_top(clean(spark, d), "category_code")


@q("zero_price_top")
def _(spark, d):
    """Most frequent categories among zero-price rows (D-27)."""
    return pf.zero_price_top(clean(spark, d), "category_code")


@q("zero_price_top_brand")
def _(spark, d):
    return pf.zero_price_top(clean(spark, d), "brand")


# 9. validation --------------------------------------------------------------
@q("validate_user_funnel")
def _(spark, d):
    return va.validate_user_funnel(user_state(spark, d))


@q("validate_category")
def _(spark, d):
    return va.validate_summary(seg_summary(spark, d, "category"), "category_code")


@q("validate_brand")
def _(spark, d):
    return va.validate_summary(seg_summary(spark, d, "brand"), "brand")


@q("validate_price")
def _(spark, d):
    return va.validate_summary(seg_summary(spark, d, "price_band"), "price_band")


@q("validate_time")
def _(spark, d):
    return va.validate_time(time_table(spark, d))


@q("quality_report")
def _(spark, d):
    return va.quality_report(shop(spark, d, "dirty"), clean(spark, d, "duplicates"))


@q("reconcile")
def _(spark, d):
    ev = clean(spark, d)
    us = materialize(fn.user_funnel(ev))
    return va.reconcile(ta.time_analysis(us, ev), us, ev)


@q("order_check")
def _(spark, d):
    return va.order_check(shop(spark, d, "disordered", ["event_time"]).withColumn("chunk", chunk_of()))


# 10. incremental ------------------------------------------------------------
@q("state_semi")
def _(spark, d):
    ev = clean(spark, d)
    mid = _mid_chunk(ev)
    state = fn.user_funnel(ev.where(chunk_of() < mid))
    return inc.state_for_batch(state, ev.where(chunk_of() >= mid), ["user_id"])


@q("state_merge")
def _(spark, d):
    ev = clean(spark, d)
    mid = _mid_chunk(ev)
    a = fn.funnel_partials(ev.where(chunk_of() < mid), ["user_id"])
    return fn.finish(inc.funnel_step(a, ev.where(chunk_of() >= mid), ["user_id"]), ["user_id"])


@q("seen_anti")
def _(spark, d):
    ev = shop(spark, d, "duplicates")
    mid = _mid_chunk(shop(spark, d))
    seen = dd.fingerprint(ev.where(chunk_of() < mid)).select("fingerprint").distinct()
    new, _seen2 = inc.dedup_batch(ev.where(chunk_of() >= mid), seen)
    return _dbl_price(new.select(*EVENT_COLS))


@q("incremental_funnel")
def _(spark, d):
    """Daily partial summaries per (user, day), merged in day order.  Day
    slices keep the number of partials per key bounded by the time span."""
    return fn.sliced_funnel(clean(spark, d), ["user_id"], F.col("event_date"))


@q("incremental_category")
def _(spark, d):
    ev = fn.with_segment(clean(spark, d), "category")
    return fn.sliced_funnel(ev, ["user_id", "category_code"], F.col("event_date"))


@q("incremental_brand")
def _(spark, d):
    ev = fn.with_segment(clean(spark, d), "brand")
    return fn.sliced_funnel(ev, ["user_id", "brand"], F.col("event_date"))


@q("incremental_price")
def _(spark, d):
    ev = fn.with_segment(clean(spark, d), "price_band")
    return fn.sliced_funnel(ev, ["user_id", "price_band"], F.col("event_date"))


@q("state_size")
def _(spark, d):
    return inc.state_size(seg_state(spark, d, "category"))


# 11. streaming --------------------------------------------------------------
STREAM_SLICES = 4


def _replay(spark, d, run, variant="base", fill=True):
    """``run(stream, checkpoint)`` over the events (filled or raw), landing as
    time-ordered slices (equal event-time ranges) of as many files as the
    data has partitions."""
    from cartwheel.streaming import replay_slices
    ev = shop(spark, d, variant)
    if fill:
        ev = cl.fill_unknown(ev)
    secs = micros_ntz("event_time")
    b = ev.agg(F.min(secs).alias("lo"), F.max(secs).alias("hi")).first()
    width = max((b["hi"] - b["lo"]) // STREAM_SLICES + 1, 1)
    sliced = ev.withColumn("_slice", F.floor((secs - F.lit(b["lo"])) / F.lit(width)).cast("int"))
    return replay_slices(sliced, "_slice", run)


@q("stream_dedup")
def _(spark, d):
    from cartwheel.session import scratch_path
    from cartwheel.streaming import stream_dedup
    path = scratch_path(spark, "stream-dedup-out")
    out = _replay(spark, d, lambda stream, ckpt: stream_dedup(stream, path, checkpoint=ckpt), "duplicates")
    return _dbl_price(spark.read.parquet(out).select(*DEDUP_COLUMNS))


def _stream_buckets(spark, d, keys, segment=None):
    """Funnel on bucketed state over the replayed slices; folded every second
    batch, so that folds, appended summaries and their union all take part."""
    from cartwheel.session import scratch_path
    from cartwheel.streaming import stream_funnel_buckets
    path = scratch_path(spark, "stream-" + "-".join(keys))
    state = _replay(spark, d, lambda stream, ckpt: stream_funnel_buckets(
        fn.with_segment(stream, segment) if segment else stream, path, keys, ckpt, buckets=8, fold_every=2))
    return state.funnel()


@q("stream_funnel")
def _(spark, d):
    return _stream_buckets(spark, d, ["user_id"])


@q("stream_funnel_state")
def _(spark, d):
    from cartwheel.session import scratch_path
    from cartwheel.streaming import latest_state, stream_funnel_state
    path = scratch_path(spark, "stream-funnel-log")
    out = _replay(spark, d, lambda stream, ckpt: stream_funnel_state(stream, path, checkpoint=ckpt))
    return latest_state(spark, out)


def _stream_activity(spark, d, dimension, spine):
    from cartwheel.session import scratch_path
    from cartwheel.streaming import stream_activity
    path = scratch_path(spark, f"stream-activity-{dimension}")
    out = _replay(spark, d, lambda stream, ckpt: stream_activity(stream, path, checkpoint=ckpt, dimension=dimension))
    agg = spark.read.parquet(out)
    return (F.broadcast(spine).join(agg, "time_value", "left")
            .select("time_value",
                    F.coalesce("purchase_users", F.lit(0)).cast("bigint").alias("purchase_users"),
                    F.coalesce("purchase_events", F.lit(0)).cast("bigint").alias("purchase_events"),
                    F.coalesce(F.col("revenue").cast("double"), F.lit(0.0)).alias("revenue")))


@q("stream_activity")
def _(spark, d):
    return _stream_activity(spark, d, "hour", ta.hour_spine(spark))


@q("stream_activity_weekday")
def _(spark, d):
    return _stream_activity(spark, d, "day_of_week", ta.weekday_spine(spark))


# 12. sinks ------------------------------------------------------------------
@q("roundtrip_parquet")
def _(spark, d):
    from cartwheel.session import scratch_path
    from cartwheel.sources.sinks import write_clean
    path = scratch_path(spark, "clean-events")
    write_clean(clean(spark, d), path)
    back = spark.read.parquet(path)
    return _dbl_price(back.select(*[c for c in clean(spark, d).columns]))


# 13. text sources / sinks and remaining inventory items ---------------------
def _csv_export(spark, d) -> str:
    """The events as a headered text export in file order (several files,
    written by a range-partitioned sort on the ingestion order)."""
    from cartwheel.session import scratch_path
    path = scratch_path(spark, "raw-csv")
    (_text(shop(spark, d)).orderBy("seq").drop("seq")
     .write.mode("overwrite").option("header", True).csv(path))
    return path


@q("csv_scan")
def _(spark, d):
    from cartwheel.sources.events import read_events
    ev = cl.standardize(read_events(spark, _csv_export(spark, d), "csv"))
    return ev.select(*DEDUP_COLUMNS)


@q("csv_funnel")
def _(spark, d):
    """User funnel from the text export: ties inside a second are broken by
    the file-order sequence generated at scan time."""
    from cartwheel.sources.events import read_events
    return fn.user_funnel(cl.clean_events(read_events(spark, _csv_export(spark, d), "csv")))


def _csv_index(spark, d) -> str:
    from cartwheel.session import scratch_path
    from cartwheel.sources.split_index import build_split_index
    path = scratch_path(spark, "csv-index")
    build_split_index(spark, _csv_export(spark, d), path)
    return path


@q("csv_prefix_run")
def _(spark, d):
    """First chunks of the raw text export only (the reference's
    ``max_chunks``), read from the files that hold them by the split index,
    cleaned and funnelled."""
    from cartwheel.sources.split_index import read_indexed
    return fn.user_funnel(cl.clean_events(read_indexed(spark, _csv_index(spark, d), PREFIX_CHUNKS * CHUNK_ROWS)))


@q("csv_indexed_funnel")
def _(spark, d):
    """User funnel from the text export with the sequence of its split index
    (no second copy of the text)."""
    from cartwheel.sources.split_index import read_indexed
    return fn.user_funnel(cl.clean_events(read_indexed(spark, _csv_index(spark, d))))


@q("funnel_result_load")
def _(spark, d):
    """User funnel written as CSV (ordered by user), loaded back with a
    required-column check and lenient typing, then cohort by first-view hour."""
    from cartwheel.session import scratch_path
    from cartwheel.sources.events import load_result
    from cartwheel.sources.sinks import write_funnel
    path = scratch_path(spark, "user-funnel-csv")
    write_funnel(user_state(spark, d), path, fmt="csv")
    cols = ["user_id", "viewed", "added_to_cart", "purchased", "first_view_time", "purchase_count", "purchase_revenue"]
    raw = load_result(spark, path, cols, fmt="csv")
    typed = raw.select(
        F.col("user_id").try_cast("bigint").alias("user_id"),
        *[F.coalesce(F.col(c).try_cast("int"), F.lit(0)).alias(c) for c in ["viewed", "added_to_cart", "purchased"]],
        parse_iso_time_lenient("first_view_time").alias("first_view_time"),
        F.coalesce(F.col("purchase_count").try_cast("bigint"), F.lit(0)).alias("purchase_count"),
        F.coalesce(F.col("purchase_revenue").try_cast("double"), F.lit(0.0)).alias("purchase_revenue"))
    return ta.cohort_hour(typed)


@q("summary_csv")
def _(spark, d):
    from cartwheel.session import scratch_path
    from cartwheel.sources.sinks import write_summary
    s = seg_summary(spark, d, "category")
    path = scratch_path(spark, "category-summary-csv")
    write_summary(s, path, fmt="csv")
    return spark.read.schema(s.schema).option("header", True).csv(path)


@q("state_semi_category")
def _(spark, d):
    ev = fn.with_segment(clean(spark, d), "category")
    mid = _mid_chunk(ev)
    keys = ["user_id", "category_code"]
    state = fn.funnel(ev.where(chunk_of() < mid), keys)
    return inc.state_for_batch(state, ev.where(chunk_of() >= mid), keys)


@q("incremental_upsert")
def _(spark, d):
    """The reference's per-chunk loop: read the state of the batch's keys,
    merge, upsert — over two halves; must equal the batch funnel."""
    ev = clean(spark, d)
    mid = _mid_chunk(ev)
    keys = ["user_id"]
    state = fn.funnel_partials(ev.where(chunk_of() < mid), keys)
    batch = ev.where(chunk_of() >= mid)
    touched = inc.state_for_batch(state, batch, keys)
    merged = fn.merge_partials(touched, fn.funnel_partials(batch, keys), keys)
    return fn.finish(inc.upsert(state, merged, keys), keys)


@q("dup_marks")
def _(spark, d):
    return dd.duplicate_flags(shop(spark, d, "duplicates")).select("seq", "duplicate_after_first", "duplicate_any")


@q("zero_price_examples")
def _(spark, d):
    ev = shop(spark, d)
    return _dbl_price(ev.where(F.col("price") == 0).orderBy("user_id", "event_time", "seq").limit(20).select(*EVENT_COLS))


@q("negative_price_examples")
def _(spark, d):
    ev = shop(spark, d, "dirty")
    return _dbl_price(ev.where(F.col("price") < 0).orderBy("user_id", "event_time", "seq").limit(20).select(*EVENT_COLS))


@q("set_difference_bands")
def _(spark, d):
    from cartwheel.functions.columns import PRICE_BANDS
    actual = seg_summary(spark, d, "price_band")
    expected = spark.createDataFrame([(b,) for b in PRICE_BANDS], "price_band string")
    return va.set_difference(actual, expected, "price_band")


@q("kpi_table")
def _(spark, d):
    return pf.metric_table(sm.revenue_kpis(user_state(spark, d)))


@q("time_null_summary")
def _(spark, d):
    return pf.missing_profile(time_table(spark, d), ta.TIME_COLUMNS)


@q("category_lookup")
def _(spark, d):
    return rk.lookup(seg_summary(spark, d, "category"), "category_code", "LARGE", case_insensitive=False)


@q("stage_flags")
def _(spark, d):
    et = F.col("event_type")
    return shop(spark, d, columns=["event_type"]).select("seq", *[(et == s).cast("int").alias(f"is_{s}") for s in ("view", "cart", "purchase")])


@q("stream_category")
def _(spark, d):
    return _stream_buckets(spark, d, ["user_id", "category_code"], "category")


@q("stream_brand")
def _(spark, d):
    return _stream_buckets(spark, d, ["user_id", "brand"], "brand")


@q("stream_price")
def _(spark, d):
    return _stream_buckets(spark, d, ["user_id", "price_band"], "price_band")


@q("stream_dedup_watermark")
def _(spark, d):
    from cartwheel.session import scratch_path
    from cartwheel.streaming import stream_dedup
    path = scratch_path(spark, "stream-dedupw-out")
    out = _replay(spark, d, lambda stream, ckpt: stream_dedup(stream, path, watermark="1 hour", checkpoint=ckpt), "duplicates")
    return _dbl_price(spark.read.parquet(out).select(*DEDUP_COLUMNS))


@q("stream_profile")
def _(spark, d):
    from cartwheel.session import scratch_path
    from cartwheel.streaming import stream_counts
    path = scratch_path(spark, "stream-profile")
    out = _replay(spark, d, lambda stream, ckpt: stream_counts(stream, path, checkpoint=ckpt))
    return spark.read.parquet(out)


@q("price_band_summary_missing")
def _(spark, d):
    """Price-band summary when some prices are missing (the Unknown band)."""
    st = fn.segment_funnel(clean(spark, d, "missing_price"), "price_band")
    return sm.segment_summary(st, "price_band", sort_key=True)


@q("clean_quality")
def _(spark, d):
    """Clean pipeline with the optional record-quality rules switched on."""
    return _dbl_price(cl.clean_events(shop(spark, d, "dirty"), quality=True))


@q("stream_missing")
def _(spark, d):
    from cartwheel.session import scratch_path
    from cartwheel.streaming import stream_missing
    path = scratch_path(spark, "stream-missing")
    out = _replay(spark, d, lambda stream, ckpt: stream_missing(stream, path, checkpoint=ckpt), "missing_price", fill=False)
    return spark.read.parquet(out)


@q("dup_involvement")
def _(spark, d):
    return dd.duplicate_involvement(shop(spark, d, "duplicates"))


@q("state_left_fill")
def _(spark, d):
    """Every user of the later half with the state of the earlier half, and
    zeros for users not seen there (C-03)."""
    ev = clean(spark, d)
    mid = _mid_chunk(ev)
    state = fn.user_funnel(ev.where((chunk_of() < mid) & (F.col("user_id") % 2 == 0))).select("user_id", "viewed", "purchase_count", "purchase_revenue")
    users = inc.batch_keys(ev.where(chunk_of() >= mid), ["user_id"])
    return inc.left_fill(users, state, ["user_id"], {"viewed": 0, "purchase_count": 0, "purchase_revenue": 0.0})


@q("seen_insert")
def _(spark, d):
    """The seen set after a batch: its fingerprints are added where absent (C-07)."""
    ev = shop(spark, d, "duplicates")
    mid = _mid_chunk(shop(spark, d))
    seen = dd.fingerprint(ev.where(chunk_of() < mid)).select("fingerprint").distinct()
    batch = dd.fingerprint(ev.where(chunk_of() >= mid)).select("fingerprint")
    return inc.insert_if_absent(seen, batch, ["fingerprint"])


# 14. users without views, and validators on tables with planted faults --------
@q("user_funnel_thinned")
def _(spark, d):
    return fn.user_funnel(clean(spark, d, "thinned"))


@q("purchase_only_users_thinned")
def _(spark, d):
    return sm.purchase_only_users(fn.user_funnel(clean(spark, d, "thinned")))


@q("overall_funnel_thinned")
def _(spark, d):
    return sm.overall_funnel(fn.user_funnel(clean(spark, d, "thinned")))


def _when(cond, value, column):
    return F.when(F.expr(cond), value).otherwise(F.col(column)).alias(column)


def _faulty(df, faults, again):
    """``df`` with columns replaced by {column: (condition, value)} and the
    rows of ``again`` twice."""
    bad = df.select(*[_when(*faults[c], c) if c in faults else c for c in df.columns])
    return bad.unionByName(bad.where(again))


@q("validate_category_faulty")
def _(spark, d):
    s = materialize(seg_summary(spark, d, "category"))
    return va.validate_summary(_faulty(s, {
        "cart_users": ("category_code = 'SMALL'", F.col("view_users") + 1),
        "purchase_users": ("category_code = 'STANDARD'", F.col("view_users") + 2),
        "purchase_events": ("category_code = 'MEDIUM'", F.lit(-1)),
        "revenue": ("category_code = 'ECONOMY'", F.lit(0.0)),
        "category_code": ("category_code = 'Unknown'", F.lit(None)),
    }, "category_code = 'LARGE'"), "category_code")


@q("validate_user_funnel_faulty")
def _(spark, d):
    s = materialize(user_state(spark, d))
    return va.validate_user_funnel(_faulty(s, {
        "viewed": ("user_id % 7 = 0", F.lit(0)),
        "added_to_cart": ("user_id % 5 = 0", F.lit(0)),
        "purchase_count": ("user_id % 11 = 0", F.lit(-1)),
        "purchase_revenue": ("user_id % 13 = 0", F.lit(-0.5)),
    }, "user_id % 17 = 0"))


def _faulty_time(spark, d):
    t = materialize(time_table(spark, d))
    return _faulty(t.where("time_value not in ('03', '04')"), {
        "time_value": ("time_value = 'Monday' or (time_value = '05' and analysis_type = 'funnel_cohort')",
                       F.when(F.col("time_value") == "Monday", "Mon")),
        "cart_users": ("time_value = 'Friday' and analysis_type = 'funnel_cohort'", F.col("view_users") + 1),
        "revenue": ("time_value = '07'", F.lit(-1.0)),
    }, "time_value = '11'")


@q("validate_time_faulty")
def _(spark, d):
    return va.validate_time(_faulty_time(spark, d))


@q("time_label_differences")
def _(spark, d):
    return va.time_label_differences(_faulty_time(spark, d))


# 15. state that outlives a run ------------------------------------------------
BATCHES = 3


def _batches(ev: DataFrame, n: int = BATCHES):
    """(number, rows) of ``n`` batches in ingestion order."""
    top = ev.agg(F.max("seq")).first()[0] + 1
    return [(b, ev.where((F.col("seq") >= b * top // n) & (F.col("seq") < (b + 1) * top // n))) for b in range(n)]


def _fresh(spark, name):
    from cartwheel.session import scratch_path
    return scratch_path(spark, name)


@q("bucketed_upsert")
def _(spark, d):
    """The reference's per-chunk loop on bucketed state: read the buckets of
    the batch's keys, merge, replace those buckets (C-04, C-06)."""
    from cartwheel.operators.keyed_state import BucketTable
    keys = ["user_id"]
    table = BucketTable(spark, _fresh(spark, "bucketed"), keys, buckets=8)
    for b, rows in _batches(clean(spark, d)):
        new = fn.funnel_partials(rows, keys)
        old = table.read(table.touched(table.bucketed(new)))
        if old is not None:
            new = fn.merge_partials(inc.state_for_batch(old.drop("bucket"), new, keys), new, keys)
        table.upsert(new, b)
    return fn.finish(table.read().drop("bucket"), keys)


@q("late_rows")
def _(spark, d):
    """Rows that come after a later time of an earlier batch, with their
    batch; the rest goes into the funnel (I-04)."""
    from cartwheel.operators.keyed_state import FunnelState
    state = FunnelState(spark, _fresh(spark, "late"), buckets=8, late="aside")
    for b, rows in _batches(shop(spark, d, "disordered"), 5):
        state.append(rows, b)
    late = state.late_rows()
    if late is None:
        return shop(spark, d, "disordered").where("false").select(F.lit(0).alias("batch"), "seq", "user_id", "event_type", "event_time")
    return late.select("batch", "seq", "user_id", "event_type", "event_time")


@q("late_rows_funnel")
def _(spark, d):
    """The funnel of the rows that are not late."""
    from cartwheel.operators.keyed_state import FunnelState
    state = FunnelState(spark, _fresh(spark, "late"), buckets=8, late="aside", fold_every=2)
    for b, rows in _batches(shop(spark, d, "disordered"), 5):
        state.append(rows, b)
    return state.funnel()


@q("replayed_batches")
def _(spark, d):
    """Funnel over batches of which each is run twice, with folds in between,
    as after a restart (I-07)."""
    from cartwheel.operators.keyed_state import FunnelState
    state = FunnelState(spark, _fresh(spark, "replayed"), buckets=8, fold_every=2)
    for b, rows in _batches(clean(spark, d)):
        state.append(rows, b)
        state.append(rows, b)
    return state.funnel()


@q("seen_store")
def _(spark, d):
    """Exact dedup over three batches against the stored fingerprints."""
    from cartwheel.operators.seen import SeenStore
    store, out = SeenStore(spark, _fresh(spark, "seen")), _fresh(spark, "seen-rows")
    for b, rows in _batches(shop(spark, d, "duplicates")):
        store.add(rows, b, out)
    return _dbl_price(spark.read.parquet(out).select(*DEDUP_COLUMNS))


@q("clean_append")
def _(spark, d):
    """Clean table appended batch by batch, one of them replayed (A-07)."""
    from cartwheel.sources.sinks import append_clean
    path = _fresh(spark, "clean-append")
    ev = clean(spark, d)
    for b, rows in [*_batches(ev), _batches(ev)[1]]:
        append_clean(rows, path, b)
    return _dbl_price(spark.read.parquet(path).select(*ev.columns))


@q("funnels_all")
def _(spark, d):
    return fn.all_funnels(clean(spark, d))


@q("activity_bitmap_merge")
def _(spark, d):
    """Dense purchase activity from bitmaps and sums of three batches."""
    from cartwheel.operators.bitmaps import ActivityStore
    store = ActivityStore(spark, _fresh(spark, "activity"))
    for b, rows in _batches(clean(spark, d)):
        store.add(rows, b)
    return ta.dense_activity(store.read())


@q("distinct_bitmap")
def _(spark, d):
    """Distinct users, sessions, products and categories from bitmaps of
    three batches."""
    from cartwheel.operators.bitmaps import DistinctStore
    names = {"user_id": "users", "user_session": "sessions", "product_id": "products", "category_id": "categories"}
    store = DistinctStore(spark, _fresh(spark, "distinct"))
    for b, rows in _batches(shop(spark, d)):
        store.add(rows, list(names), b)
    return store.counts().agg(*[F.coalesce(F.max(F.when(F.col("attribute") == a, F.col("distinct_values"))), F.lit(0)).alias(n)
                                for a, n in names.items()])


@q("distinct_sketch")
def _(spark, d):
    """Whether the estimate of united daily sketches lies within its bound of
    the exact count."""
    from cartwheel.operators import bitmaps
    ev, names = shop(spark, d).withColumn("day", F.to_date("event_time")), ["user_id", "user_session", "product_id"]
    est = bitmaps.sketch_estimates(bitmaps.sketches(ev, names, "day"), names)
    exact = ev.agg(*[F.countDistinct(a).alias(a) for a in names]).select(
        F.expr("stack(3, " + ", ".join(f"'{a}', {a}" for a in names) + ") as (name, exact)"))
    return est.join(exact, F.col("attribute") == F.col("name")).select(
        "attribute", "exact", (F.abs(F.col("estimate") - F.col("exact")) <= F.col("bound")).alias("within_bound"))


# 16. malformed and missing input ----------------------------------------------
SHORT_EVERY, LONG_EVERY, BAD_PRICE_EVERY, BAD_TIME_EVERY = 101, 103, 107, 109


def _damaged_export(spark, d) -> str:
    """The events as text lines without a header, of which some lack their
    last field, some have one more, and some hold no number or time."""
    path, t, s = _fresh(spark, "damaged-csv"), _text(shop(spark, d)), F.col("seq")
    t = t.withColumns({"price": F.when(s % BAD_PRICE_EVERY == 0, "free").otherwise(F.col("price")),
                       "event_time": F.when(s % BAD_TIME_EVERY == 0, "yesterday").otherwise(F.col("event_time"))})
    fields = [F.coalesce(F.col(c), F.lit("")) for c in DEDUP_COLUMNS]
    line = (F.when(s % SHORT_EVERY == 0, F.concat_ws(",", *fields[:-1])).when(s % LONG_EVERY == 0, F.concat_ws(",", *fields, F.lit("more")))
            .otherwise(F.concat_ws(",", *fields)))
    t.orderBy("seq").select(line.alias("value")).write.text(path)
    return path


@q("csv_quarantine")
def _(spark, d):
    """Rows kept and set aside of a text file with malformed rows."""
    from cartwheel.sources.events import quarantine_report, read_events_lenient
    return quarantine_report(*read_events_lenient(spark, _damaged_export(spark, d), header=False))


@q("csv_quarantine_funnel")
def _(spark, d):
    """User funnel of the rows that are kept."""
    from cartwheel.sources.events import read_events_lenient
    good, _ = read_events_lenient(spark, _damaged_export(spark, d), header=False)
    return fn.user_funnel(cl.clean_events(good))


@q("input_report")
def _(spark, d):
    """Which inputs of a run are there (A-05): the tables it reads, and a
    clean table of an earlier run, which is not."""
    from cartwheel.sources.events import input_report
    return input_report(spark, {"events": f"{d}/events.parquet", "part": f"{d}/part.parquet", "clean_events": f"{d}/clean_events.parquet"})
