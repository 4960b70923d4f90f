"""Structured Streaming forms of dedup, funnel and purchase activity (I-01 .. I-07).

* ``stream_dedup`` — streaming ``dropDuplicates`` on the nine columns:
  exact global dedup with keyed state in the state store (unbounded, like
  the reference's seen-table); ``watermark=`` switches to
  ``dropDuplicatesWithinWatermark`` (bounded state, documented
  approximation).
* ``stream_funnel_merge`` — ``foreachBatch``: each micro-batch is summarised
  with the batch funnel operator (skew-safe aggregates) and merged into the
  previous state snapshot with the ordered-merge algebra; snapshots are
  written per query (its checkpoint) and batch id, so a replayed batch
  rewrites the same snapshot (idempotent) and a query with a new checkpoint
  starts from empty (I-07).  The snapshot before the latest is kept for
  replays, older ones are removed.
* ``stream_funnel_state`` — ``applyInPandasWithState``: the same summary
  kept per user in Spark's state store, users dealt by hash over a number of
  groups; the function sees only one group's events of one micro-batch.
* ``stream_activity`` — purchases per hour or weekday bucket (complete
  mode) with distinct users through a streaming dedup on (bucket, user).
* ``stream_counts`` / ``stream_missing`` — running profile counters.

Queries with keyed state run on the RocksDB state store, which keeps the
state on disk instead of in executor heap; another provider set in the
session is left as it is.

Micro-batches must arrive in event-time order per key (the reference
rejects out-of-order chunks, I-04); ``check_order=True`` enforces it.
Checkpoints always live under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import hashlib
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from cartwheel.functions.columns import hour_label, money, weekday_name
from cartwheel.operators.funnel import finish, funnel_partials, merge_partials
from cartwheel.operators.incremental import check_batch_order
from cartwheel.operators.keyed_state import FunnelState
from cartwheel.session import scratch_path
from cartwheel.sources.events import DEDUP_COLUMNS


def write_ordered_slices(df: DataFrame, slice_col: str, path: str) -> list[int]:
    """Write ``df`` as one Parquet folder per slice, oldest slice first, so a
    file stream source (ordered by modification time) replays them in order.
    One write job per slice; the slice list itself is a tiny aggregate.

    Test / demo helper for replaying static tables as a stream: each slice
    is one file (so one micro-batch is exactly one slice) and is therefore
    written by one task — keep slices small.  Real streams arrive over time
    and need no replay."""
    slices = sorted(r[0] for r in df.select(slice_col).distinct().collect())
    for s in slices:
        df.where(F.col(slice_col) == s).drop(slice_col).coalesce(1).write.mode("overwrite") \
          .parquet(f"{path}/slice={s:06d}")
    return slices


def event_stream(spark: SparkSession, path: str, schema, files_per_trigger: int | None = 1) -> DataFrame:
    """File stream; ``files_per_trigger=None`` takes all that has landed."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def replay_slices(df: DataFrame, slice_col: str, run):
    """Replay a static table as a stream, oldest slice first: a slice lands as
    as many files as it has partitions, and ``run(stream, checkpoint)``
    processes all that has landed; the next slice continues from the same
    checkpoint.  Returns what the last run returned."""
    spark = df.sparkSession
    path, checkpoint = scratch_path(spark, "stream-input"), scratch_path(spark, "ckpt-replay")
    schema, result = df.drop(slice_col).schema, None
    for s in sorted(r[0] for r in df.select(slice_col).distinct().collect()):
        df.where(F.col(slice_col) == s).drop(slice_col).write.mode("overwrite").parquet(f"{path}/slice={s:06d}")
        result = run(event_stream(spark, path, schema, None), checkpoint)
    return result


PROVIDER = "spark.sql.streaming.stateStore.providerClass"
HEAP_PROVIDER = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
DISK_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _disk_state(spark: SparkSession):
    """Starts a query on the RocksDB state store unless the session has
    chosen another; a query keeps the provider it was first started with."""
    before = spark.conf.get(PROVIDER, HEAP_PROVIDER)
    chosen = before.split(".")[-1] != HEAP_PROVIDER.split(".")[-1]
    if not chosen:
        spark.conf.set(PROVIDER, DISK_PROVIDER)
    try:
        yield
    finally:
        if not chosen:
            spark.conf.set(PROVIDER, before)


def _run(q):
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def stream_dedup(stream: DataFrame, out_path: str, keys=DEDUP_COLUMNS, watermark: str | None = None,
                 time_col: str = "event_time", checkpoint: str | None = None) -> str:
    """Exact streaming dedup into a Parquet sink (append mode).  Without a
    watermark every distinct row stays in the state store, on disk."""
    spark = stream.sparkSession
    s = stream
    if watermark:
        s = s.withColumn("_wm", F.col(time_col).cast("timestamp")).withWatermark("_wm", watermark)
        s = s.dropDuplicatesWithinWatermark(list(keys)).drop("_wm")
    else:
        s = s.dropDuplicates(list(keys))
    with _disk_state(spark):
        q = (s.writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", checkpoint or scratch_path(spark, "ckpt-dedup"))
             .trigger(availableNow=True).start(out_path))
        _run(q)
    return out_path


def _versions(spark: SparkSession, root: str) -> list[int]:
    """Committed snapshot versions, ascending (listed from the snapshot
    folder, so a restarted driver finds them again)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    return sorted(int(st.getPath().getName()[2:]) for st in fs.listStatus(path)
                  if st.getPath().getName().startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")))


def _drop_versions(spark: SparkSession, root: str, before: int) -> None:
    jvm = spark.sparkContext._jvm
    for v in _versions(spark, root):
        if v < before:
            for folder in (f"{root}/v={v:09d}", f"{root}/meta/v={v:09d}"):
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stream_funnel_merge(stream: DataFrame, state_root: str, keys=("user_id",), check_order: bool = True,
                        checkpoint: str | None = None) -> str:
    """Incremental funnel through ``foreachBatch`` ordered merges (I-02 / I-03).

    Each micro-batch is summarised with the batch operator and merged into
    the previous snapshot; snapshot ``v=<batch id>`` holds the partial state
    and ``meta/v=<batch id>`` the latest event time seen.  Both lie in a
    folder of the query's checkpoint and are found again by listing, so a
    restarted query continues from its checkpoint and a new one starts from
    empty; a replayed batch overwrites its own snapshot.  Returns the latest
    snapshot folder."""
    spark = stream.sparkSession
    keys = list(keys)
    checkpoint = checkpoint or scratch_path(spark, "ckpt-funnel")
    root = f"{state_root}/query={hashlib.sha256(checkpoint.encode()).hexdigest()[:16]}"

    def step(batch: DataFrame, batch_id: int):
        batch.persist()
        try:
            merge(batch, batch_id)
        finally:
            batch.unpersist()

    def merge(batch: DataFrame, batch_id: int):
        prev = max((v for v in _versions(spark, root) if v < batch_id), default=None)
        rows, lo, hi = batch.agg(F.count(F.lit(1)), F.min("event_time"), F.max("event_time")).first()
        if rows == 0:
            return
        prev_hi = None
        if prev is not None:
            prev_hi = spark.read.parquet(f"{root}/meta/v={prev:09d}").first()["hi"]
        if check_order:
            check_batch_order(prev_hi, lo, f"batch {batch_id}")
        part = funnel_partials(batch, keys)
        if prev is not None:
            part = merge_partials(spark.read.parquet(f"{root}/v={prev:09d}"), part, keys)
        # a batch without any time still has purchases and revenue to add
        hi = max((h for h in (prev_hi, hi) if h is not None), default=None)
        spark.createDataFrame([(hi,)], "hi timestamp_ntz").write.mode("overwrite") \
            .parquet(f"{root}/meta/v={batch_id:09d}")
        part.write.mode("overwrite").parquet(f"{root}/v={batch_id:09d}")
        if prev is not None:  # kept: a replay of this batch starts from it again
            _drop_versions(spark, root, prev)

    q = (stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    _run(q)
    have = _versions(spark, root)
    return f"{root}/v={have[-1]:09d}" if have else None


def stream_funnel_buckets(stream: DataFrame, state_root: str, keys=("user_id",), checkpoint: str | None = None,
                          buckets: int = 64, fold_every: int = 8, late: str = "reject") -> FunnelState:
    """Incremental funnel on bucketed state (I-02 / I-03): a micro-batch
    appends the summary of its own keys, whatever the state's size, and every
    ``fold_every`` batches what was appended is folded into the buckets it
    touches.  The state belongs to the query's checkpoint, so a restarted
    query goes on and a new one starts from empty; a replayed batch replaces
    its own summary.  ``late`` as in :class:`FunnelState`.  Returns the state."""
    spark = stream.sparkSession
    checkpoint = checkpoint or scratch_path(spark, "ckpt-funnel")
    root = f"{state_root}/query={hashlib.sha256(checkpoint.encode()).hexdigest()[:16]}"
    state = FunnelState(spark, root, keys, buckets, fold_every, late)

    def step(batch: DataFrame, batch_id: int):
        batch.persist()
        try:
            state.append(batch, batch_id)
        finally:
            batch.unpersist()

    _run(stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    return state


# -- applyInPandasWithState --------------------------------------------------

_FIELDS = ["V", "C", "P", "VC", "CP", "VCP", "purchase_count", "cents", "version"]
_STATE_SCHEMA = ("users array<string>, V array<string>, C array<string>, P array<string>, VC array<string>, "
                 "CP array<string>, VCP array<string>, purchase_count array<long>, cents array<long>, version array<long>")


def _first(code, rank, users: int, none: int):
    out = np.full(users, none)
    np.minimum.at(out, code, rank)
    return out


def _summarise(pdfs) -> dict[str, dict]:
    """Ordered summary, by user, of the events of one group of users in one
    micro-batch.

    The rows arrive as several Arrow batches in no particular order, so of
    views each user's first one in a batch is kept, and all positions of carts
    and purchases only (a small share of events), to resolve "first cart
    after the first view" etc. once all batches are seen.
    Positions are fixed-width digit strings, so text order is numeric order;
    events without one ('') count, but are first nowhere."""
    codes: dict[str, int] = {}
    kept, bought, cents = [], [], []
    for pdf in pdfs:
        code = np.array([codes.setdefault(u, len(codes)) for u in pdf["_user"]], dtype=np.int64)
        pos, et = pdf["_pos"].to_numpy().astype("S40"), pdf["event_type"]
        placed = pos != b""
        view, cart, buy = ((et == t).to_numpy(dtype=bool, na_value=False) for t in ("view", "cart", "purchase"))
        bought.append(code[buy])
        cents.append(pdf["_cents"].to_numpy()[buy])
        view, cart, buy = view & placed, cart & placed, buy & placed
        at, rank = np.unique(pos[view], return_inverse=True)
        first = _first(code[view], rank, len(codes), len(at))
        seen = np.flatnonzero(first < len(at))
        for kind, c, p in (("view", seen, at[first[seen]]), ("cart", code[cart], pos[cart]), ("purchase", code[buy], pos[buy])):
            kept.append((np.full(len(c), kind[0]), c, p))
    kind, code, pos = (np.concatenate(x) for x in zip(*kept))
    at, rank = np.unique(pos, return_inverse=True)
    none = len(at)

    def first_after(t, bound):
        m = kind == t
        if bound is not None:
            m &= rank > bound[code]
        return _first(code[m], rank[m], len(codes), none)

    firsts = {"V": first_after("v", None), "C": first_after("c", None), "P": first_after("p", None)}
    firsts["VC"] = first_after("c", firsts["V"])
    firsts["CP"] = first_after("p", firsts["C"])
    firsts["VCP"] = first_after("p", firsts["VC"])
    bought, sums = np.concatenate(bought), np.zeros(len(codes), dtype=np.int64)
    np.add.at(sums, bought, np.concatenate(cents))
    text = [*np.char.decode(at, "ascii").tolist(), None]
    columns = {**{k: [text[i] for i in f.tolist()] for k, f in firsts.items()},
               "purchase_count": np.bincount(bought, minlength=len(codes)).tolist(), "cents": sums.tolist()}
    return {u: dict(zip(columns, row)) for u, row in zip(codes, zip(*columns.values()))}


def _merge(a: dict, b: dict) -> dict:
    """Ordered merge of two summaries (earlier ``a`` then ``b``)."""
    return {
        "V": a["V"] or b["V"], "C": a["C"] or b["C"], "P": a["P"] or b["P"],
        "VC": a["VC"] or (b["C"] if a["V"] else b["VC"]),
        "CP": a["CP"] or (b["P"] if a["C"] else b["CP"]),
        "VCP": a["VCP"] or (b["P"] if a["VC"] else (b["CP"] if a["V"] else b["VCP"])),
        "purchase_count": a["purchase_count"] + b["purchase_count"],
        "cents": a["cents"] + b["cents"],
    }


def _state_fn(key, pdfs, state):
    """One group of users: their state is read and written as a whole; the
    users of this micro-batch are put out."""
    all_users: dict[str, tuple] = {}
    if state.exists:
        users, *columns = state.get
        all_users = dict(zip(users, zip(*columns)))
    rows = []
    for user, cur in _summarise(pdfs).items():
        version = 0
        if user in all_users:
            prev = dict(zip(_FIELDS, all_users[user]))
            cur, version = _merge(prev, cur), prev["version"] + 1
        all_users[user] = (*(cur[k] for k in _FIELDS[:-1]), version)
        rows.append((int(user) if user else None, *all_users[user]))
    state.update((list(all_users), *(list(c) for c in zip(*all_users.values()))))
    yield pd.DataFrame(rows, columns=["user_id", *_FIELDS], dtype=object)


def stream_funnel_state(stream: DataFrame, out_path: str, checkpoint: str | None = None, groups: int = 1 << 12) -> str:
    """User funnel with keyed state (``applyInPandasWithState``), append sink
    of per-batch state versions; read with :func:`latest_state`.

    Users are dealt by hash over ``groups`` keys of the state: a call of the
    function costs milliseconds whatever it does, so it takes a group's users
    at once.  A group's state is rewritten when any of its users has events;
    take more groups for very many users of which few are active at a time.
    The number belongs to the checkpoint and must not change between runs."""
    from cartwheel.functions.columns import event_pos
    spark = stream.sparkSession
    # packed positions are fixed-width decimal text → compare by (length, text)
    ev = stream.select(F.pmod(F.xxhash64("user_id"), F.lit(groups)).alias("_group"),
                       F.coalesce(F.col("user_id").cast("string"), F.lit("")).alias("_user"), "event_type",
                       F.coalesce(F.lpad(event_pos().cast("string"), 40, "0"), F.lit("")).alias("_pos"),
                       F.coalesce(money("price") * 100, F.lit(0)).cast("bigint").alias("_cents"))
    out = ev.groupBy("_group").applyInPandasWithState(
        _state_fn,
        "user_id long, V string, C string, P string, VC string, CP string, VCP string, "
        "purchase_count long, cents long, version long",
        _STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout)
    with _disk_state(spark):
        q = (out.writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", checkpoint or scratch_path(spark, "ckpt-funnel-state"))
             .trigger(availableNow=True).start(out_path))
        _run(q)
    return out_path


def latest_state(spark: SparkSession, path: str, keys=("user_id",)) -> DataFrame:
    """Last emitted version per key of an append-mode state log, as a funnel."""
    keys = list(keys)
    log = spark.read.parquet(path)
    cols = ["V", "C", "P", "VC", "CP", "VCP", "purchase_count", "cents"]
    last = log.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.col("version")).alias("s")).select(*keys, "s.*")
    parts = last.select(*keys, *[F.col(c).cast("decimal(38,0)").alias(c) for c in ["V", "C", "P", "VC", "CP", "VCP"]],
                        "purchase_count", (F.col("cents").cast("decimal(26,2)") / 100).cast("decimal(28,2)").alias("revenue_dec"))
    return finish(parts, keys)


def stream_activity(stream: DataFrame, out_path: str, checkpoint: str | None = None, dimension: str = "hour") -> str:
    """Purchases per bucket of ``dimension`` (hour or day_of_week): events and
    revenue by streaming aggregate, distinct users via streaming dedup on
    (bucket, user) (I-05)."""
    spark = stream.sparkSession
    bucket = {"hour": hour_label(F.hour("event_time")), "day_of_week": weekday_name("event_time")}[dimension]
    p = (stream.where(F.col("event_type") == "purchase")
         .select(bucket.alias("time_value"), "user_id",
                 money(F.coalesce(F.col("price"), F.lit(0))).alias("price"),
                 F.lit(1).alias("first_of_user")))
    # first purchase of a (bucket, user) pair marks a distinct user
    users = p.dropDuplicates(["time_value", "user_id"]).select("time_value", F.lit(1).alias("u"))
    agg = (p.select("time_value", F.lit(0).alias("u"), F.lit(1).alias("e"), "price")
           .unionByName(users.withColumn("e", F.lit(0)).withColumn("price", F.lit(None).cast("decimal(18,2)")))
           .groupBy("time_value").agg(F.sum("u").alias("purchase_users"), F.sum("e").alias("purchase_events"),
                                      F.sum("price").alias("revenue")))

    return _complete(agg, out_path, checkpoint or scratch_path(spark, "ckpt-activity"))


def _complete(agg: DataFrame, out_path: str, checkpoint: str) -> str:
    """Runs a complete-mode aggregate; each trigger rewrites the totals."""
    def sink(batch: DataFrame, batch_id: int):
        batch.write.mode("overwrite").parquet(out_path)

    with _disk_state(agg.sparkSession):
        _run(agg.writeStream.outputMode("complete").foreachBatch(sink).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    return out_path


__all__ = ["write_ordered_slices", "replay_slices", "event_stream", "stream_dedup", "stream_funnel_merge",
           "stream_funnel_state", "stream_activity", "stream_counts", "stream_missing", "latest_state"]


def stream_counts(stream: DataFrame, out_path: str, checkpoint: str | None = None) -> str:
    """Incremental profile counters (I-06): events, zero-price events and
    unknown category / brand per event type of filled events."""
    spark = stream.sparkSession
    agg = stream.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("price") == 0).alias("zero_price_rows"),
        F.count_if(F.col("category_code") == "Unknown").alias("unknown_category_code"),
        F.count_if(F.col("brand") == "Unknown").alias("unknown_brand"))

    return _complete(agg, out_path, checkpoint or scratch_path(spark, "ckpt-profile"))


def stream_missing(stream: DataFrame, out_path: str, columns=DEDUP_COLUMNS, checkpoint: str | None = None) -> str:
    """Running missing-value counts of the raw columns, before any fill
    (I-06): one row of totals over everything that has arrived."""
    agg = stream.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in columns])
    return _complete(agg, out_path, checkpoint or scratch_path(stream.sparkSession, "ckpt-missing"))
