"""Join helpers (C-01 .. C-07)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (``<=>``), keeping one
    copy of each key column.  Null-safe equality still plans as a hash /
    sort-merge join key, so no nested-loop join is introduced."""
    r = right
    for k in keys:
        r = r.withColumnRenamed(k, f"__r_{k}")
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[f"__r_{k}"]) for k in keys])
    out = left.join(r, cond, how)
    if how in ("left_semi", "left_anti", "semi", "anti", "leftsemi", "leftanti"):
        return out
    if how in ("full", "outer", "full_outer", "fullouter", "right", "right_outer"):
        for k in keys:
            out = out.withColumn(k, F.coalesce(F.col(k), F.col(f"__r_{k}")))
    return out.drop(*[f"__r_{k}" for k in keys])


def semi_reduce(state: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """State rows whose key occurs in the batch (C-01 / C-02)."""
    return join_keys(state, batch.select(*keys).distinct(), keys, "left_semi")


def upsert(state: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Insert-or-replace by key (C-06): the new snapshot is the old state
    without the batch keys, plus the batch rows."""
    kept = join_keys(state, batch.select(*keys), keys, "left_anti")
    return kept.unionByName(batch.select(*state.columns))


def insert_if_absent(state: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Add only batch keys that are not in the state yet (C-07)."""
    fresh = join_keys(batch.dropDuplicates(keys), state.select(*keys), keys, "left_anti")
    return state.unionByName(fresh.select(*state.columns))


def left_fill(left: DataFrame, right: DataFrame, keys: list[str], fill: dict) -> DataFrame:
    """Left equi-join with defaults for unmatched rows (C-03)."""
    out = join_keys(left, right, keys, "left")
    for c, v in fill.items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return out
