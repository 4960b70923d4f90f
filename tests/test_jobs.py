"""End-to-end batch jobs on a text export of the test events."""

from pyspark.sql import functions as F

from cartwheel.plans.catalog import QUERIES, _csv_export
from cartwheel.plans.jobs import run_all
from cartwheel.session import scratch_path


def test_run_all_from_csv(spark, sf_dir):
    raw = _csv_export(spark, sf_dir)
    out = scratch_path(spark, "jobs-out")
    paths = run_all(spark, raw, out)
    users = spark.read.parquet(paths["user_funnel"])
    assert sorted(users.collect()) == sorted(QUERIES["csv_funnel"](spark, sf_dir).collect())
    cat = spark.read.option("header", True).csv(f"{out}/eda/category_analysis")
    assert cat.count() == QUERIES["category_summary"](spark, sf_dir).count()
    tm = spark.read.option("header", True).csv(f"{out}/eda/time_analysis")
    assert tm.where(F.col("analysis_type") == "purchase_activity").count() == 31
    val = spark.read.option("header", True).csv(f"{out}/validation/category_analysis")
    assert val.where(F.col("passed") == "false").count() == 0
    rec = spark.read.option("header", True).csv(f"{out}/validation/reconcile")
    assert rec.where(F.col("passed") == "false").count() == 0
    clean = spark.read.parquet(paths["clean_events"])
    assert "event_date" in clean.columns
    assert clean.count() == QUERIES["row_count"](spark, sf_dir).first()["rows"]   # no duplicates in the base data
