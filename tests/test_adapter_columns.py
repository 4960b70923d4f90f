"""Queries that need no column of ``part`` neither join it nor parse props."""

import re

import pytest

from cartwheel.plans.catalog import QUERIES


@pytest.mark.parametrize("name", ["row_count", "event_distribution", "scan_projected", "time_features", "stage_flags", "order_check", "zero_price_by_event"])
def test_no_part_join_and_no_props(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    read = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "p_partkey" not in plan and "props" not in "".join(re.findall(r"ReadSchema: \S+", read))


def test_changed_part_file_is_noticed(spark, tmp_path):
    from cartwheel.plans.catalog import _source_stamp
    for t in ("events", "part"):
        spark.range(10).write.parquet(f"file://{tmp_path}/{t}.parquet")
    before = _source_stamp(spark, f"file://{tmp_path}")
    spark.range(1).write.mode("append").parquet(f"file://{tmp_path}/events.parquet")
    assert _source_stamp(spark, f"file://{tmp_path}") != before
