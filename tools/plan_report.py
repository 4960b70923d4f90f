"""Summarise the executed (AQE final) physical plan of catalogue queries.

Broadcast joins are switched off (``autoBroadcastJoinThreshold=-1``) so the
plan approximates a large cluster, where per-key tables are too big to
broadcast; only explicit, size-bounded broadcasts remain.

usage: python tools/plan_report.py [sf_dir] name ...
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

OPS = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition",
       "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin",
       "BroadcastNestedLoopJoin", "CartesianProduct", "HashAggregate", "ObjectHashAggregate",
       "SortAggregate", "Window", "Generate", "TakeOrderedAndProject", "ArrowEvalPython",
       "BatchEvalPython", "FlatMapGroupsInPandas"]


def main():
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    from cartwheel.plans.catalog import QUERIES
    from cartwheel.session import get_spark
    spark = get_spark("local[8]", extra={"spark.sql.autoBroadcastJoinThreshold": "-1"})
    for name in args:
        df = QUERIES[name](spark, sf)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        counts = {op: len(re.findall(re.escape(op) + r"[ (]", plan)) for op in OPS}
        counts = {k: v for k, v in counts.items() if v}
        pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]*)\]", plan)))
        print(f"## {name}")
        print("operators: " + ", ".join(f"{k}×{v}" for k, v in counts.items()))
        for p in pushed:
            if p:
                print(f"pushed filters: [{p}]")
        print()


if __name__ == "__main__":
    main()
