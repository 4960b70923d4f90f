import pytest
from pyspark.sql import functions as F

from cartwheel.operators import funnel as fn
from cartwheel.operators.cleaning import fill_unknown
from cartwheel.operators.incremental import OutOfOrderBatch
from cartwheel.session import scratch_path
from cartwheel.sources.adapter import shop_events
from cartwheel.sources.events import MissingInputError, read_events
from cartwheel.streaming import event_stream, stream_funnel_merge, write_ordered_slices


def test_missing_input_fails_early(spark):
    with pytest.raises(MissingInputError):
        read_events(spark, "/nonexistent/raw.csv")


def test_out_of_order_stream_is_rejected(spark, sf_dir):
    ev = fill_unknown(shop_events(spark, sf_dir))
    # newest slice is written first, so it is replayed first
    sliced = ev.withColumn("_slice", (F.lit(1) - F.floor(F.col("seq") / 5000)).cast("int"))
    src = scratch_path(spark, "disordered-stream")
    write_ordered_slices(sliced, "_slice", src)
    with pytest.raises(Exception) as e:
        stream_funnel_merge(event_stream(spark, src, ev.schema), scratch_path(spark, "bad-state"))
    assert "OutOfOrderBatch" in str(e.value) or isinstance(e.value, OutOfOrderBatch)


def test_stream_funnel_state_matches_batch(spark, sf_dir):
    from cartwheel.plans.catalog import QUERIES
    got = sorted(QUERIES["stream_funnel_state"](spark, sf_dir).collect())
    assert got == sorted(QUERIES["user_funnel"](spark, sf_dir).collect())


def test_csv_sequence_follows_file_order(spark, sf_dir):
    from cartwheel.plans.catalog import _csv_export
    ev = read_events(spark, _csv_export(spark, sf_dir), "csv")
    ordered = [r.user_session for r in ev.orderBy("seq").select("user_session").collect()]
    orig = [r.user_session for r in shop_events(spark, sf_dir).orderBy("seq").select("user_session").collect()]
    assert ordered == orig
    assert ev.select("seq").distinct().count() == ev.count()
    assert fn is not None


def test_stream_funnel_restart_continues(spark, sf_dir):
    """Two runs of the same query (same checkpoint and state folder): the
    second run picks up new input files and continues from the stored
    snapshot, as after a driver restart."""
    ev = fill_unknown(shop_events(spark, sf_dir))
    sliced = ev.withColumn("_slice", F.floor(F.col("seq") / 2500).cast("int"))
    src, state, ckpt = (scratch_path(spark, n) for n in ("restart-src", "restart-state", "restart-ckpt"))
    write_ordered_slices(sliced.where(F.col("_slice") < 2), "_slice", src)
    stream_funnel_merge(event_stream(spark, src, ev.schema), state, checkpoint=ckpt)
    write_ordered_slices(sliced.where(F.col("_slice") >= 2), "_slice", src)
    latest = stream_funnel_merge(event_stream(spark, src, ev.schema), state, checkpoint=ckpt)
    got = sorted(fn.finish(spark.read.parquet(latest), ["user_id"]).collect())
    assert got == sorted(fn.user_funnel(ev).collect())


def test_row_number_with_many_small_splits(spark, sf_dir):
    """Force several splits per file (and several splits per task): the
    dense file-order sequence must still equal the original order."""
    from cartwheel.plans.catalog import _csv_export
    path = _csv_export(spark, sf_dir)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 * 1024))
    spark.conf.set("spark.sql.files.openCostInBytes", str(8 * 1024))
    try:
        ev = read_events(spark, path, "csv")
        got = [r.user_session for r in ev.orderBy("seq").select("user_session").collect()]
        nums = sorted(r.seq for r in ev.select("seq").collect())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    orig = [r.user_session for r in shop_events(spark, sf_dir).orderBy("seq").select("user_session").collect()]
    assert got == orig
    assert nums == list(range(len(orig)))


def test_keyed_state_with_many_arrow_batches(spark, sf_dir):
    """Large groups reach the state function as several Arrow batches in no
    time order (rows are shuffled inside each micro-batch file here); the
    summary must not depend on their order."""
    from cartwheel.streaming import latest_state, stream_funnel_state
    ev = fill_unknown(shop_events(spark, sf_dir))
    sliced = (ev.withColumn("_slice", F.floor(F.col("seq") / 5000).cast("int"))
              .repartition(1).orderBy(F.rand(11)))
    src = scratch_path(spark, "shuffled-stream")
    write_ordered_slices(sliced, "_slice", src)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        out = stream_funnel_state(event_stream(spark, src, ev.schema), scratch_path(spark, "shuffled-log"))
        got = sorted(latest_state(spark, out).collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got == sorted(fn.user_funnel(ev).collect())


HEADER = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session"


def _write(tmp_path, files):
    for i, text in enumerate(files):
        (tmp_path / f"part-{i:05d}.csv").write_text(text)
    return f"file://{tmp_path}"


def test_sequence_over_more_files_than_any_bit_field(spark, tmp_path):
    path = _write(tmp_path, [f"{HEADER}\nt,view,{i},,,,1,2,s{2 * i}\nt,view,{i},,,,1,2,s{2 * i + 1}\n" for i in range(2100)])
    rows = read_events(spark, path, "csv").orderBy("seq").select("seq", "user_session").collect()
    assert [tuple(r) for r in rows] == [(k, f"s{k}") for k in range(4200)]


def test_swapped_header_is_an_error(spark, tmp_path):
    path = _write(tmp_path, [HEADER.replace("category_code,brand", "brand,category_code") + "\nt,view,1,2,acme,toys,1,2,s\n"])
    with pytest.raises(Exception, match="(?i)header"):
        read_events(spark, path, "csv").collect()


def test_short_row_is_an_error(spark, tmp_path):
    path = _write(tmp_path, [f"{HEADER}\nt,view,1,2,c,b,1,2\n"])
    with pytest.raises(Exception, match="(?i)malformed"):
        read_events(spark, path, "csv").collect()


def test_quotes_and_null_tokens_in_every_column(spark, tmp_path):
    from cartwheel.operators.cleaning import normalize_null_tokens
    path = _write(tmp_path, [HEADER + '\n"a ""b"", c",' + ",".join(["NA"] * 8) + "\n" + ",".join(["NaN"] * 9) + "\n"])
    rows = normalize_null_tokens(read_events(spark, path, "csv")).orderBy("seq").drop("seq").collect()
    assert rows[0]["event_time"] == 'a "b", c' and all(v is None for v in rows[0][1:]) and all(v is None for v in rows[1])


def test_new_query_starts_from_empty(spark, sf_dir):
    """A query with a new checkpoint on a used state folder neither returns
    nor continues the older query's snapshots, even with fewer batches (I-07);
    only the latest snapshot and the one before it are kept."""
    ev = fill_unknown(shop_events(spark, sf_dir))
    sliced = ev.withColumn("_slice", F.floor(F.col("seq") / 2500).cast("int"))
    long, short, state = (scratch_path(spark, n) for n in ("long-src", "short-src", "shared-state"))
    write_ordered_slices(sliced, "_slice", long)
    write_ordered_slices(sliced.where("_slice = 3"), "_slice", short)
    first = stream_funnel_merge(event_stream(spark, long, ev.schema), state)
    second = stream_funnel_merge(event_stream(spark, short, ev.schema), state)
    for latest, events in ((first, ev), (second, sliced.where("_slice = 3"))):
        assert sorted(fn.finish(spark.read.parquet(latest), ["user_id"]).collect()) == sorted(fn.user_funnel(events).collect())
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(first).getParent()
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert sorted(s.getPath().getName() for s in fs.listStatus(path)) == ["meta", "v=000000002", "v=000000003"]


def test_batch_order_check():
    from cartwheel.operators.incremental import check_batch_order
    check_batch_order(None, 1)
    check_batch_order(5, None)
    check_batch_order(5, 5)
    with pytest.raises(OutOfOrderBatch, match="batch 7"):
        check_batch_order(5, 4, "batch 7")


def test_funnel_state_calls_are_bounded_by_groups(spark, monkeypatch):
    """One row of state (and one call of the state function) per group of
    users, however many users there are; a user without id, events without
    time and users whose events span micro-batches are summarised alike."""
    from cartwheel.streaming import latest_state, stream, stream_funnel_state
    types = ["cart", "view", "purchase", "remove_from_cart", None, "cart", "purchase"]
    rows = [(i, None if i % 53 == 0 else f"2024-01-{1 + i // 700:02d} {i * 7 % 24:02d}:00:00", types[(i * i + i // 3) % 7], float(i % 9),
             None if i % 101 == 0 else i % 97 + 2 ** 60) for i in range(2800)]
    ev = spark.createDataFrame(rows, "seq long, event_time string, event_type string, price double, user_id long").withColumn(
        "event_time", F.col("event_time").cast("timestamp_ntz"))
    # events without a time come last
    sliced = ev.withColumn("_slice", F.coalesce(F.dayofmonth("event_time"), F.lit(9)))
    src, runs = scratch_path(spark, "grouped-stream"), []
    write_ordered_slices(sliced, "_slice", src)
    run = stream._run
    monkeypatch.setattr(stream, "_run", lambda q: (run(q), runs.extend(q.recentProgress)))
    out = stream_funnel_state(event_stream(spark, src, ev.schema), scratch_path(spark, "grouped-log"), groups=5)
    states = [p["stateOperators"][0]["numRowsTotal"] for p in runs if p["numInputRows"]]
    assert len(states) == 5 and max(states) <= 5
    got = {r.user_id: r for r in latest_state(spark, out).collect()}
    named = {r.user_id: r for r in fn.user_funnel(ev.where("user_id is not null")).collect()}
    unnamed = fn.user_funnel(ev.where("user_id is null").withColumn("user_id", F.lit(0).cast("long"))).first()
    assert len(named) == 97 and set(got) == {*named, None}
    assert all(got[u] == r for u, r in named.items()) and got[None][1:] == unnamed[1:]
