"""State that outlives a run: what a batch reads and writes, replay, restart
after a cut, late rows, seen rows, bitmaps, quarantine."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import bitmaps, funnel as fn, keyed_state, time_analysis as ta
from cartwheel.operators.incremental import OutOfOrderBatch
from cartwheel.operators.keyed_state import BucketTable, FunnelState
from cartwheel.operators.seen import SeenStore
from cartwheel.session import scratch_path
from cartwheel.sources.events import quarantine_report, read_events_lenient
from cartwheel.sources.sinks import append_clean, cut_lineage

KINDS = ["view", "view", "cart", "purchase", "remove_from_cart"]


def made(spark, n=400, users=25, seed=1):
    r, t = random.Random(seed), datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        t += timedelta(minutes=r.choice([0, 1, 30, 300]))
        rows.append((i, t, r.choice(KINDS), r.randint(1, users), r.choice([None, "a", "b", "c"]), r.choice([None, "x", "y"]),
                     float(r.choice([0, 10, 60, 120, 3000]))))
    return cut_lineage(spark.createDataFrame(rows, "seq long, event_time timestamp_ntz, event_type string, user_id long, category_code string, "
                                                   "brand string, price double"), "made")


def parts_of(ev, n, rows=400):
    return [ev.where((F.col("seq") >= b * rows // n) & (F.col("seq") < (b + 1) * rows // n)) for b in range(n)]


def files(root):
    return {os.path.relpath(os.path.join(d, f), root): os.path.getsize(os.path.join(d, f))
            for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def local(path):
    return path.removeprefix("file://").removeprefix("file:")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_a_batch_writes_its_own_keys_only(spark):
    ev = made(spark, users=200)
    state = FunnelState(spark, scratch_path(spark, "state"), buckets=16, fold_every=99)
    batches = parts_of(ev, 4)
    for b in range(3):
        state.append(batches[b], b)
    state.fold()
    root = local(state.root)
    before = files(root)
    one = batches[3].where("user_id = 7").unionByName(batches[3].limit(1).withColumn("user_id", F.lit(7).cast("long")))
    state.append(one, 3)
    added = {k: v for k, v in files(root).items() if k not in before}
    assert set(before) <= set(files(root))  # nothing that was there is rewritten
    assert sum(v for k, v in added.items() if k.startswith("partials/")) < sum(v for k, v in before.items() if k.startswith("base/data")) / 8
    assert len({k.split("bucket=")[1].split("/")[0] for k in added if "bucket=" in k}) == 1
    state.fold()
    data = {k for k in before if k.startswith("base/data")}
    gone = data - set(files(root))
    assert len({k.split("bucket=")[1].split("/")[0] for k in gone}) == 1  # a fold rewrites the bucket it touches
    assert not [k for k in files(root) if k.startswith(("partials/", "base/pending"))]
    expected = fn.user_funnel(ev.where("seq < 300").unionByName(one))
    assert rows(state.funnel()) == rows(expected)


@pytest.mark.parametrize("fold_every", [1, 2, 99])
def test_any_folding_equals_the_batch_funnel(spark, fold_every):
    ev = fn.with_segment(made(spark), "category")
    keys = ["user_id", "category_code"]
    state = FunnelState(spark, scratch_path(spark, "state"), keys, 4, fold_every)
    for b, batch in enumerate(parts_of(ev, 5)):
        state.append(batch, b)
        state.append(batch, b)  # replayed
        state = FunnelState(spark, state.root, keys, 4, fold_every)  # restarted
    state.append(ev.where("seq < 0"), 5)
    assert rows(state.funnel()) == rows(fn.funnel(ev, keys))


def test_a_rewrite_that_was_cut_off_is_completed(spark, monkeypatch):
    ev = made(spark)
    state = FunnelState(spark, scratch_path(spark, "state"), buckets=4, fold_every=99)
    batches = parts_of(ev, 3)
    state.append(batches[0], 0)
    state.fold()
    state.append(batches[1], 1)
    place = BucketTable._place

    def cut(self, tag):  # some buckets are in place, the rewrite isn't noted
        (spark.read.parquet(f"{self.pending}/tag={tag}").where("bucket < 2").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.data))
        raise KeyboardInterrupt

    monkeypatch.setattr(BucketTable, "_place", cut)
    with pytest.raises(KeyboardInterrupt):
        state.fold()
    monkeypatch.setattr(BucketTable, "_place", place)
    again = FunnelState(spark, state.root, buckets=4, fold_every=99)
    assert rows(again.funnel()) == rows(fn.user_funnel(ev.where("seq < 266")))
    again.append(batches[2], 2)
    assert rows(again.funnel()) == rows(fn.user_funnel(ev))


def test_upsert_replaces_and_adds(spark):
    t = BucketTable(spark, scratch_path(spark, "upsert"), ["k"], 8)
    df = lambda pairs: spark.createDataFrame(pairs, "k long, v string")
    assert t.read() is None
    t.upsert(df([(i, "old") for i in range(50)]), 0)
    before = files(local(t.data))
    t.upsert(df([(3, "new"), (77, "new")]), 1)
    t.upsert(df([(3, "never")]), 1)  # a rewrite that is in place isn't repeated
    assert len(set(before) - set(files(local(t.data)))) <= 2
    got = {r["k"]: r["v"] for r in t.read().collect()}
    assert got == {**{i: "old" for i in range(50)}, 3: "new", 77: "new"}


def test_late_rows_are_rejected_or_set_aside(spark):
    ev = made(spark)
    first, second = ev.where("seq < 200"), ev.where("seq >= 200")
    behind = ev.where("seq in (5, 6)").withColumn("seq", F.col("seq") + 1000)
    for late in ("reject", "aside"):
        state = FunnelState(spark, scratch_path(spark, "late"), buckets=4, late=late)
        state.append(first, 0)
        if late == "reject":
            assert state.late_rows() is None
            with pytest.raises(OutOfOrderBatch):
                state.append(second.unionByName(behind), 1)
            continue
        state.append(second.unionByName(behind), 1)
        state.append(second.unionByName(behind), 1)
        assert rows(state.late_rows().select("seq", "batch")) == [(1005, 1), (1006, 1)]
        assert rows(state.funnel()) == rows(fn.user_funnel(ev))
    with pytest.raises(ValueError):
        FunnelState(spark, "x", late="maybe")


def test_seen_store_reads_touched_folders_and_writes_once(spark, tmp_path):
    keys = ["k", "v"]
    store, out = SeenStore(spark, scratch_path(spark, "seen"), keys, prefix=1), scratch_path(spark, "seen-out")
    df = lambda pairs: spark.createDataFrame(pairs, "k long, v string").withColumn("seq", F.monotonically_increasing_id())
    store.add(df([(i % 40, None) for i in range(100)]), 0, out)
    store.add(df([(i, None) for i in range(30, 60)] * 2), 1, out)
    store.add(df([(i, None) for i in range(30, 60)] * 2), 1, out)  # replayed
    store.add(df([(5, None), (99, "x"), (99, "x")]), 2, out)
    store.add(df([]), 3, out)
    got = spark.read.parquet(out).groupBy("batch").count().collect()
    assert {r["batch"]: r["count"] for r in got} == {0: 40, 1: 20, 2: 1}
    seen = store.seen(3, ["0"])
    assert all(r["fingerprint"][0] == "0" for r in seen.collect())
    plan = seen._jdf.queryExecution().executedPlan().toString()
    read = [f for f in seen.inputFiles() if "prefix=0" in f]
    assert "PartitionFilters: [batch" in plan.replace("isnotnull(batch", "[batch") or "prefix" in plan.split("PartitionFilters")[1][:400]
    assert read and not os.path.exists(local(store.staged) + "/batch=2")


def test_bitmaps_merge_over_batches(spark):
    ev = made(spark, users=60)
    store = bitmaps.ActivityStore(spark, scratch_path(spark, "bits"))
    for b, batch in enumerate(parts_of(ev, 4)):
        store.add(batch, b)
        if b == 2:
            store.add(batch, b)  # replayed
    assert rows(ta.dense_activity(store.read())) == rows(ta.purchase_activity(ev))
    stored = spark.read.parquet(f"{store.users.root}/bitmaps")
    assert stored.count() <= 31 * 4  # per group and batch, not per user
    numbers = [r["number"] for r in spark.read.parquet(f"{store.users.root}/numbers").collect()]
    assert sorted(numbers) == list(range(1, len(numbers) + 1))


def test_bitmap_numbers_pass_a_block(spark):
    values = spark.range(100_000).select(F.lit("id").alias("attribute"), F.col("id").cast("string").alias("value"))
    numbers = bitmaps.number_values(values.where("value < 70000"))
    more = bitmaps.number_values(values, numbers)
    both = numbers.unionByName(more)
    assert both.agg(F.min("number"), F.max("number"), F.countDistinct("number")).first() == (1, 100_000, 100_000)
    parts = bitmaps.bitmaps(values, both, []).unionByName(bitmaps.bitmaps(values.limit(10), both, []))
    assert bitmaps.bit_counts(parts, []).first()["distinct_values"] == 100_000 and parts.count() <= 4 + 4


def test_sketches_of_days_are_near_the_exact_count(spark):
    df = spark.range(50_000).select((F.col("id") % 7).alias("day"), (F.col("id") % 9973).alias("user"))
    est = bitmaps.sketch_estimates(bitmaps.sketches(df, ["user"], "day"), ["user"]).first()
    assert abs(est["estimate"] - 9973) <= est["bound"] < 9973 / 10


def test_all_funnels_equal_the_single_ones(spark):
    ev = made(spark)
    got = cut_lineage(fn.all_funnels(ev), "funnels")
    one = lambda kind: got.where(F.col("segment_type") == kind).drop("segment_type")
    assert rows(one("user").drop("segment")) == rows(fn.user_funnel(ev))
    for kind in fn.SEGMENTS:
        assert rows(one(kind)) == rows(fn.segment_funnel(ev, kind))


def test_an_appended_batch_replaces_itself(spark):
    ev = made(spark).withColumn("event_date", F.to_date("event_time"))
    path = scratch_path(spark, "append")
    for b in (0, 1, 0):
        append_clean(parts_of(ev, 2)[b], path, b)
    assert rows(spark.read.parquet(path).select(*ev.columns)) == rows(ev)
    append_clean(ev.where("seq = 399"), path, 1)
    assert spark.read.parquet(path).where("batch = 1").count() == 1


def test_malformed_rows_are_set_aside(spark, tmp_path):
    head = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n"
    good = "2019-10-01 00:00:01 UTC,view,1,2,a,NA,1.50,7,s1\n"
    lines = [good, "2019-10-01 00:00:02 UTC,cart,1\n", good.replace("s1", "s1,extra"), good.replace("1.50", "cheap"), good.replace("2019-10", "soon"),
             good.replace(",7,", ",,"), good.replace("1.50", "")]
    path = str(tmp_path / "bad.csv")
    with open(path, "w") as f:
        f.write(head + "".join(lines))
    kept, bad = read_events_lenient(spark, path)
    assert [r["seq"] for r in kept.orderBy("seq").collect()] == [0, 5, 6]
    assert kept.where("seq = 0").first()["brand"] == "NA"  # raw text stays raw
    assert rows(bad.select("seq", "reason")) == [(1, "fields"), (2, "fields"), (3, "unparsable"), (4, "unparsable")]
    assert "s1,extra" in bad.where("seq = 2").first()["line"]
    assert dict(map(tuple, quarantine_report(kept, bad).collect())) == {"kept": 3, "set_aside_fields": 2, "set_aside_unparsable": 2, "read": 7}


def test_folders_need_a_complete_write(spark, tmp_path):
    os.makedirs(tmp_path / "batch=3")
    assert keyed_state.folders(spark, str(tmp_path), "batch") == []
    assert keyed_state.folders(spark, str(tmp_path / "none"), "batch") == []
