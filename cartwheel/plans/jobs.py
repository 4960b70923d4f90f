"""Batch jobs over a raw clickstream export, end to end.

``run_all`` does what the reference's scripts do one after the other:

1. raw CSV → clean events (typed, null tokens → 'Unknown', exact dedup,
   time features), written as Parquet partitioned by ``event_date`` plus a
   run summary;
2. clean events → user funnel (Parquet, ordered by user);
3. clean events → category / brand / price-band funnels and summaries;
4. user funnel + clean events → time analysis (cohorts + dense activity);
5. overall funnel, KPIs and validation reports.

Every step reads the previous step's written output, so a failure or a lost
executor only repeats the step that was running.  Usage::

    python -m cartwheel.plans.jobs --raw /data/2019-Oct.csv --out /data/out
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cartwheel.operators import cleaning as cl
from cartwheel.operators import funnel as fn
from cartwheel.operators import summary as sm
from cartwheel.operators import time_analysis as ta
from cartwheel.operators import validate as va
from cartwheel.session import scale_conf
from cartwheel.sources.events import read_events
from cartwheel.sources.sinks import write_clean, write_funnel, write_summary

SEGMENT_OUTPUTS = {"category": "category_analysis", "brand": "brand_analysis", "price_band": "price_band_analysis"}


def run_all(spark: SparkSession, raw: str, out: str, fmt: str = "csv", quality: bool = False) -> dict:
    out = out.rstrip("/")
    raw_df = read_events(spark, raw, fmt)
    clean = cl.clean_events(raw_df, quality=quality)
    write_clean(clean, f"{out}/clean_events")
    clean = spark.read.parquet(f"{out}/clean_events")
    write_summary(cl.run_summary(raw_df, clean), f"{out}/run_summary")

    # the four funnels in one pass over the clean events
    fn.all_funnels(clean).write.mode("overwrite").partitionBy("segment_type").parquet(f"{out}/funnels")
    states = spark.read.parquet(f"{out}/funnels")
    write_funnel(states.where("segment_type = 'user'").drop("segment_type", "segment"), f"{out}/user_funnel")
    users = spark.read.parquet(f"{out}/user_funnel")

    for seg, name in SEGMENT_OUTPUTS.items():
        col = fn.SEGMENTS[seg]
        state = states.where(F.col("segment_type") == seg).withColumnRenamed("segment", col)
        summary = sm.segment_summary(state, col, sort_key=(seg == "price_band"))
        write_summary(summary, f"{out}/eda/{name}")
        write_summary(va.validate_summary(spark.read.option("header", True).schema(summary.schema)
                                          .csv(f"{out}/eda/{name}"), col), f"{out}/validation/{name}")

    time_df = ta.with_day_order(ta.time_analysis(users, clean))
    write_summary(time_df, f"{out}/eda/time_analysis")
    write_summary(sm.overall_funnel(users), f"{out}/eda/overall_funnel")
    write_summary(sm.revenue_kpis(users), f"{out}/eda/revenue_kpis")
    write_summary(va.validate_time(time_df.drop("day_order")), f"{out}/validation/time_analysis")
    write_summary(va.validate_user_funnel(users), f"{out}/validation/user_funnel")
    write_summary(va.reconcile(time_df, users, clean), f"{out}/validation/reconcile")
    write_summary(va.quality_report(raw_df if fmt != "csv" else cl.standardize(cl.normalize_null_tokens(raw_df)), clean),
                  f"{out}/validation/quality_report")
    return {"clean_events": f"{out}/clean_events", "user_funnel": f"{out}/user_funnel", "eda": f"{out}/eda",
            "validation": f"{out}/validation"}


def main(argv=None):
    ap = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    ap.add_argument("--raw", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--format", default="csv", choices=["csv", "parquet"])
    ap.add_argument("--checkpoint-dir", help="folder that driver and executors share; else spark.checkpoint.dir of the session")
    ap.add_argument("--input-bytes", type=int, default=0, help="size of the raw data, to set the partitioning")
    ap.add_argument("--cores", type=int, default=8, help="cores of the whole cluster, to set the partitioning")
    ap.add_argument("--quality", action="store_true", help="drop rows that break the record-quality rules")
    a = ap.parse_args(argv)
    builder = SparkSession.builder.appName("cartwheel-jobs")
    for k, v in (scale_conf(a.input_bytes, a.cores) if a.input_bytes else {}).items():
        builder = builder.config(k, v)
    if a.checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", a.checkpoint_dir)
    spark = builder.getOrCreate()
    for k, v in run_all(spark, a.raw, a.out, a.format, a.quality).items():
        print(f"{k}: {v}")


if __name__ == "__main__":
    main()
