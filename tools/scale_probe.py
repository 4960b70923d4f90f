"""Throughput at a larger size: the clean events of a test scale are
replicated ``copies`` times (user ids and sequence shifted per copy, so each
copy is a distinct population with identical behaviour), written once to
the checkpoint folder, and the headline operators are timed on it.

usage: python tools/scale_probe.py [sf_dir] [copies]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 100
    from pyspark.sql import functions as F

    from cartwheel.operators import dedup as dd
    from cartwheel.operators import funnel as fn
    from cartwheel.operators import summary as sm
    from cartwheel.operators import time_analysis as ta
    from cartwheel.plans import catalog as C
    from cartwheel.session import get_spark, scale_conf, scratch_path
    spark = get_spark("local[8]", extra=dict(scale_conf(copies * 40 * 2 ** 20, 8), **{"spark.driver.memory": "16g"}))
    base = C.clean(spark, sf)
    n_users = base.agg(F.max("user_id")).first()[0] + 1
    n_seq = base.agg(F.max("seq")).first()[0] + 1
    rep = (base.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))))
           .withColumn("user_id", F.col("user_id") + F.col("copy") * n_users)
           .withColumn("seq", F.col("seq") + F.col("copy") * n_seq).drop("copy"))
    path = scratch_path(spark, "scale-probe")
    rep.write.parquet(path)
    ev = spark.read.parquet(path)
    n = ev.count()
    out = {"events": n}

    def t(name, df):
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        out[name] = round(time.perf_counter() - t0, 2)

    t("user_funnel", fn.user_funnel(ev))
    t("category_summary", sm.segment_summary(fn.segment_funnel(ev, "category"), "category_code"))
    t("dedup_exact", dd.dedup_exact(ev.drop("event_date", "event_hour", "day_of_week", "day_of_month")))
    t("time_analysis", ta.time_analysis(fn.user_funnel(ev), ev))
    out["user_funnel_events_per_sec"] = round(n / out["user_funnel"])
    print(json.dumps(out))


if __name__ == "__main__":
    main()
