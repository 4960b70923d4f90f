"""Results must not depend on the session time zone."""

import contextlib

from cartwheel.plans.catalog import QUERIES

NAMES = ["coerce_lenient", "time_features", "cohort_hour", "activity_weekday", "funnel_result_load",
         "user_funnel"]


@contextlib.contextmanager
def session_tz(spark, tz):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        yield
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_time_zone_independent(spark):
    d = "/root/testdata/sf0.001"
    utc = {n: sorted(QUERIES[n](spark, d).collect()) for n in NAMES}
    with session_tz(spark, "America/New_York"):
        other = {n: sorted(QUERIES[n](spark, d).collect()) for n in NAMES}
    for n in NAMES:
        assert other[n] == utc[n], n
