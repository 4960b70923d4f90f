"""How often queries read the events: records read, from Spark's event log."""

import json
import os
import subprocess
import sys

PROGRAM = """
import sys
from cartwheel.session import get_spark
spark = get_spark("local[4]", 8, extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://" + sys.argv[1],
                                        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
                                        "spark.sql.autoBroadcastJoinThreshold": "-1"})
from cartwheel.operators import funnel, time_analysis
from cartwheel.plans.catalog import clean
events = clean(spark, sys.argv[2])
n = events.count()
spark.sparkContext.setJobDescription("measured")
if sys.argv[3] == "time":
    time_analysis.time_analysis(funnel.user_funnel(events), events).collect()
else:
    funnel.all_funnels(events).collect()
spark.sparkContext.setJobDescription("")
print(n)
spark.stop()
"""


def records_read(tmp_path, what):
    """(events, records read by ``what``)."""
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", PROGRAM, str(tmp_path), "/root/testdata/sf0.001", what], cwd=top,
                         env={**os.environ, "PYTHONPATH": top}, capture_output=True, text=True, timeout=300, check=True)
    measured, read = set(), 0
    for name in os.listdir(tmp_path):
        for line in open(tmp_path / name):
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart" and e.get("Properties", {}).get("spark.job.description") == "measured":
                measured.update(e["Stage IDs"])
            if e["Event"] == "SparkListenerTaskEnd" and e["Stage ID"] in measured:
                read += e["Task Metrics"]["Input Metrics"]["Records Read"]
    return int(out.stdout.split()[-1]), read


def test_time_analysis_reads_the_events_four_times_at_most(tmp_path):
    events, read = records_read(tmp_path, "time")
    # the checkpointed table of one row per user is read, too
    assert events <= read <= 4 * events + 8 * 150


def test_four_funnels_read_the_events_three_times(tmp_path):
    events, read = records_read(tmp_path, "funnels")
    # the checkpointed table of one row per key (at most one per event and kind) is read four times
    assert events <= read <= 3 * events + 4 * 4 * events
    assert read < 12 * events
