"""cartwheel — e-commerce clickstream funnel and revenue analytics on Spark.

Everything is expressed with the DataFrame / SQL API so Catalyst and AQE
choose the physical plan.  The sub-packages are:

* ``sources``   — event scans (CSV / Parquet), the test-table adapter, sinks
* ``functions`` — column expressions (price bands, rates, time labels, ...)
* ``operators`` — cleaning, dedup, funnels, summaries, time analysis,
                  rankings, profiling, validation, incremental state merges
* ``streaming`` — Structured Streaming versions of dedup / funnel / activity
* ``plans``     — the named query catalogue used by ``__spark_entry__``
"""

from cartwheel.session import get_spark, checkpoint_root  # noqa: F401

__version__ = "0.1.0"
