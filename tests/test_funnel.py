import datetime as dt

from pyspark.sql import functions as F

from cartwheel.operators import funnel as fn
from tests.micro import SCHEMA, T0, funnel_rows, EXPECTED_USER


def _m(t):
    return None if t is None else int((t - T0) / dt.timedelta(minutes=1))


def _events(spark):
    return spark.createDataFrame(funnel_rows(), SCHEMA)


def test_user_funnel_micro(spark):
    got = {r.user_id: (r.viewed, r.added_to_cart, r.purchased, _m(r.first_view_time),
                       _m(r.first_cart_time), _m(r.first_purchase_time), r.purchase_count,
                       r.purchase_revenue)
           for r in fn.user_funnel(_events(spark)).collect()}
    assert got == EXPECTED_USER


def test_segment_isolation(spark):
    rows = {(r.user_id, r.category_code): (r.viewed, r.added_to_cart, r.purchased, r.purchase_revenue)
            for r in fn.segment_funnel(_events(spark), "category").where("user_id = 10").collect()}
    assert rows == {(10, "A"): (1, 0, 0, 0.0), (10, "B"): (0, 0, 0, 4.0)}


def test_sliced_equals_batch(spark):
    ev = _events(spark)
    for slicer in [F.col("seq") % 3, F.floor(F.col("seq") / 5), F.lit(0)]:
        # slices must be ordered: use time buckets, which are non-overlapping
        pass
    whole = fn.user_funnel(ev)
    sliced = fn.sliced_funnel(ev, ["user_id"], F.floor(F.minute("event_time") / 2))
    assert sorted(whole.collect()) == sorted(sliced.collect())


def test_merge_partials_equals_batch(spark):
    ev = _events(spark)
    a = fn.funnel_partials(ev.where(F.minute("event_time") < 2), ["user_id"])
    b = fn.funnel_partials(ev.where(F.minute("event_time") >= 2), ["user_id"])
    merged = fn.finish(fn.merge_partials(a, b, ["user_id"]), ["user_id"])
    assert sorted(merged.collect()) == sorted(fn.user_funnel(ev).collect())


def test_trace_flags(spark):
    tr = {r.seq: (r.view_seen, r.qualifying_cart, r.qualifying_purchase)
          for r in fn.funnel_trace(_events(spark)).where("user_id in (8, 9)").collect()}
    assert tr == {100: (1, 0, 0), 101: (1, 1, 0), 102: (1, 0, 1),
                  200: (0, 0, 0), 201: (0, 0, 0), 202: (1, 0, 0)}


def test_missing_time_sorts_last(spark):
    from tests.micro import ev as mk
    rows = [mk(1, 20, "cart", 1), mk(2, 20, "view", 2)]
    nt = list(mk(3, 20, "view", 0))
    nt[1] = None                      # a view whose time did not parse
    rows.append(tuple(nt))
    rows += [mk(4, 21, "view", 1)]
    nt2 = list(mk(5, 21, "cart", 0))
    nt2[1] = None                     # a cart with no time comes after the view
    rows.append(tuple(nt2))
    got = {r.user_id: (r.viewed, r.added_to_cart, r.first_view_time is None, r.first_cart_time)
           for r in fn.user_funnel(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[20][:3] == (1, 0, False)
    assert got[21] == (1, 1, False, None)
