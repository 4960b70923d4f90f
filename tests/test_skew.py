"""Hot keys: the salted join path gives the same answers as the plain one."""

import contextlib

from pyspark.sql import functions as F

from cartwheel.operators import dedup as dd
from cartwheel.operators import funnel as fn
from cartwheel.operators.skew import hot_keys
from cartwheel.plans import catalog as C


@contextlib.contextmanager
def skew_conf(spark, **kv):
    old = {k: spark.conf.get(f"cartwheel.skew.{k}", None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(f"cartwheel.skew.{k}", str(v))
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(f"cartwheel.skew.{k}")
            else:
                spark.conf.set(f"cartwheel.skew.{k}", v)


def _hot_events(spark, sf_dir):
    """Clean events plus one synthetic bot user made of many copies of
    other users' events (a third of all rows)."""
    ev = C.clean(spark, sf_dir)
    bot = (ev.where(F.col("user_id") % 2 == 0)
           .withColumn("user_id", F.lit(-1).cast("bigint"))
           .withColumn("seq", F.col("seq") + 10 ** 10))
    return ev.unionByName(bot)


def test_hot_key_bound(spark, sf_dir):
    ev = _hot_events(spark, sf_dir)
    counts = ev.groupBy("user_id").count()
    hot = [r.user_id for r in hot_keys(counts, ["user_id"], "count", min_rows=100, max_keys=4).collect()]
    assert hot == [-1]


def test_salted_funnel_equals_plain(spark, sf_dir):
    ev = _hot_events(spark, sf_dir)
    plain = sorted(fn.segment_funnel(ev, "category").collect())
    trace_plain = sorted(fn.funnel_trace(ev).collect())
    with skew_conf(spark, hotKeyMinRows=10, maxHotKeys=1000, salts=7):
        assert sorted(fn.segment_funnel(ev, "category").collect()) == plain
        assert sorted(fn.funnel_trace(ev).collect()) == trace_plain


def test_salted_duplicate_marks(spark, sf_dir):
    ev = C.shop(spark, sf_dir, "duplicates")
    plain = sorted(dd.mark_duplicates(ev, keep="first").collect())
    with skew_conf(spark, hotKeyMinRows=1, maxHotKeys=10 ** 6, salts=5):
        assert sorted(dd.mark_duplicates(ev, keep="first").collect()) == plain
        from cartwheel.operators.skew import hot_keys_sampled
        from cartwheel.sources.events import DEDUP_COLUMNS
        assert hot_keys_sampled(ev, DEDUP_COLUMNS, fraction=0.5).count() > 0
