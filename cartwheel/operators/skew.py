"""Hot-key handling for lookup joins.

A clickstream can have a key (a bot user, one product, a block of copied
rows) holding a large share of all rows.  Aggregations are safe — the
partial aggregate collapses a hot key map-side — but a join of the event
side against a one-row-per-key table puts all of a hot key's events into one
task.  :func:`salted_join` spreads them:

* hot keys are keys whose row count exceeds
  ``max(min_rows, total / max_keys)``.  Fewer than ``max_keys`` keys can pass
  that bar (their counts would otherwise sum past the total), so the hot set
  has a proven size bound and is broadcast;
* each hot key gets its own salt count, ``ceil(count / rows_per_salt)``
  (capped by ``salts``), so a key holding a third of all rows is spread
  over as many tasks as its size needs; the replicated lookup rows number
  at most ``total / rows_per_salt + max_keys``;
* events of a hot key get a salt ``pmod(xxhash64(row id), key's salts)`` —
  deterministic, so a recomputed task after an executor loss produces the
  same salt; the per-key side is replicated only for hot keys;
* the join runs on ``(key, salt)``.

Thresholds are read from the session (``cartwheel.skew.*``) so they can be
tuned per cluster without code changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.operators.joins import join_keys

DEFAULT_MIN_ROWS = 1_000_000
DEFAULT_MAX_KEYS = 100_000
DEFAULT_SALTS = 100_000          # cap on salts for one key
DEFAULT_ROWS_PER_SALT = 1_000_000


def _conf(df: DataFrame, name: str, default: int) -> int:
    return int(df.sparkSession.conf.get(f"cartwheel.skew.{name}", str(default)))


def hot_keys(counts: DataFrame, keys: list[str], count_col: str,
             min_rows: int | None = None, max_keys: int | None = None) -> DataFrame:
    """Keys whose ``count_col`` exceeds ``max(min_rows, total / max_keys)``
    (fewer than ``max_keys`` rows by construction), each with its salt
    count ``_salts``."""
    min_rows = _conf(counts, "hotKeyMinRows", DEFAULT_MIN_ROWS) if min_rows is None else min_rows
    max_keys = _conf(counts, "maxHotKeys", DEFAULT_MAX_KEYS) if max_keys is None else max_keys
    per_salt = _conf(counts, "rowsPerSalt", min(DEFAULT_ROWS_PER_SALT, max(min_rows, 1)))
    cap = _conf(counts, "salts", DEFAULT_SALTS)
    total = counts.select(F.sum(count_col)).scalar()
    bar = F.greatest(F.lit(min_rows).cast("double"), total.cast("double") / F.lit(max_keys))
    salts = F.least(F.lit(cap), F.greatest(F.lit(2), F.ceil(F.col(count_col) / F.lit(per_salt)))).cast("int")
    return counts.where(F.col(count_col) > bar).select(*keys, salts.alias("_salts"))


def salted_join(big: DataFrame, small: DataFrame, keys: list[str], hot: DataFrame, salt_of: Column | str,
                how: str = "inner", null_safe: bool = False) -> DataFrame:
    """``big ⋈ small`` on ``keys`` with the rows of hot keys spread over
    their ``_salts`` tasks.  ``small`` must hold at most one row per key (a
    lookup side); ``how`` is ``inner`` or ``left`` (from ``big``)."""
    keys = list(keys)
    tag = F.broadcast(hot.select(*keys, "_salts"))

    def tagged(df):
        return join_keys(df, tag, keys, "left") if null_safe else df.join(tag, keys, "left")

    salt_col = F.col(salt_of) if isinstance(salt_of, str) else salt_of
    hot_row = F.col("_salts").isNotNull()
    b = tagged(big).withColumn(
        "_salt", F.when(hot_row, F.pmod(F.xxhash64(salt_col), F.col("_salts"))).otherwise(F.lit(0)).cast("int")
    ).drop("_salts")
    s = tagged(small).withColumn(
        "_salt", F.explode(F.when(hot_row, F.sequence(F.lit(0), F.col("_salts") - 1))
                            .otherwise(F.array(F.lit(0))))
    ).drop("_salts")
    if null_safe:
        out = join_keys(b, s, keys + ["_salt"], how)
    else:
        out = b.join(s, keys + ["_salt"], how)
    return out.drop("_salt")


def hot_keys_sampled(df: DataFrame, keys: list[str], fraction: float = 0.01, seed: int = 17,
                     min_rows: int | None = None, max_keys: int | None = None,
                     null_safe: bool = False) -> DataFrame:
    """Hot keys estimated from a fixed-seed Bernoulli sample.

    Used where exact per-key counts would need a second full aggregation
    of the data (e.g. nine-column duplicate groups).  Only the salting plan
    depends on this set, never the result.  The same bound holds: sampled
    counts above ``max(min_rows, total / max_keys) * fraction`` can belong
    to fewer than ``max_keys`` keys."""
    min_rows = _conf(df, "hotKeyMinRows", DEFAULT_MIN_ROWS) if min_rows is None else min_rows
    max_keys = _conf(df, "maxHotKeys", DEFAULT_MAX_KEYS) if max_keys is None else max_keys
    counts = df.select(*keys).sample(fraction=fraction, seed=seed).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_n", F.col("_n") / F.lit(fraction))
    return hot_keys(counts, keys, "_n", min_rows, max_keys)
