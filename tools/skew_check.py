"""Hot-key experiment: a bot user holding about a third of the cart/purchase
rows is added to the clean events; the user funnel runs with salting active
(low thresholds) or inactive, and the per-task shuffle-read records of the
worst stage are read from Spark's event log (written to a fresh temp folder).

usage: python tools/skew_check.py salted|plain [sf_dir]
"""
import sys, json, glob, os, time, tempfile
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from cartwheel.session import get_spark
from cartwheel.plans import catalog as C
from cartwheel.operators import funnel as fn
from pyspark.sql import functions as F
mode = sys.argv[1] if len(sys.argv) > 1 else "salted"  # salted | plain
EVDIR = tempfile.mkdtemp(prefix="cartwheel-evlog-")
spark = get_spark("local[8]", shuffle_partitions=16, extra={
    "spark.eventLog.enabled": "true", "spark.eventLog.dir": EVDIR,
    "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1"})
if mode == "salted":
    spark.conf.set("cartwheel.skew.hotKeyMinRows", "1000")
    spark.conf.set("cartwheel.skew.maxHotKeys", "100")
else:
    spark.conf.set("cartwheel.skew.hotKeyMinRows", str(10**12))
d = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
ev = C.clean(spark, d)
bot = ev.where(F.col("event_type").isin("cart", "purchase") | (F.col("user_id") % 3 == 0)) \
        .withColumn("user_id", F.lit(-1).cast("bigint")).withColumn("seq", F.col("seq") + 10**10)
skewed = ev.unionByName(bot)
spark.sparkContext.setJobGroup("timed", "timed")
t0 = time.perf_counter()
fn.user_funnel(skewed).write.format("noop").mode("overwrite").save()
wall = time.perf_counter() - t0
app = spark.sparkContext.applicationId
spark.stop()
path = [p for p in glob.glob(f"{EVDIR}/*{app}*") if os.path.isfile(p)][0]
tasks = {}
timed = set()
for line in open(path):
    e = json.loads(line)
    if e["Event"] == "SparkListenerJobStart" and e.get("Properties", {}).get("spark.jobGroup.id") == "timed":
        timed.update(e["Stage IDs"])
    if e["Event"] == "SparkListenerTaskEnd" and e["Stage ID"] in timed:
        m = e.get("Task Metrics") or {}
        r = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
        tasks.setdefault(e["Stage ID"], []).append(r)
worst = max(((max(v), sorted(v)[len(v)//2], k, len(v)) for k, v in tasks.items() if len(v) > 1 and max(v) > 0))
print(f"MODE {mode} wall={wall:.2f}s worst-stage max/median shuffle records per task = {worst[0]}/{worst[1]} (stage {worst[2]}, {worst[3]} tasks)")
