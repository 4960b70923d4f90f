"""Incremental (batch-by-batch) forms of dedup and funnels
(C-01 .. C-08, D-11, D-32, G-05, I-01 .. I-04, I-07).

The reference keeps keyed state in an embedded database and upserts it
chunk by chunk.  Here a state is a DataFrame (on a cluster: a table in
shared storage) and a new batch produces a new snapshot:

* dedup: ``new = batch.dedup() ⋉̸ seen`` (anti-join on the fingerprint);
  ``seen' = seen ∪ fingerprints(new)``
* funnel: ``state' = merge_partials(state, partials(batch))`` — a full
  outer join on the key with the ordered-merge algebra, valid when every
  batch is later in ``(event_time, seq)`` than everything before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.operators.dedup import dedup_exact, fingerprint
from cartwheel.operators.funnel import PARTIAL_COLS, funnel_partials, merge_partials
from cartwheel.operators.joins import insert_if_absent, join_keys, left_fill, semi_reduce, upsert  # noqa: F401
from cartwheel.sources.events import DEDUP_COLUMNS


class OutOfOrderBatch(ValueError):
    pass


def batch_keys(batch: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys of a batch (G-05)."""
    return batch.select(*keys).distinct()


def state_for_batch(state: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Existing state rows of the keys in the batch (C-01 / C-02)."""
    return semi_reduce(state, batch, keys)


def dedup_batch(batch: DataFrame, seen: DataFrame, keys=DEDUP_COLUMNS):
    """One step of incremental global dedup (I-01, C-05, C-07).

    Returns ``(new_rows, seen')``: rows of the batch whose fingerprint was
    never seen (first occurrence inside the batch kept) and the grown
    fingerprint set."""
    fresh = fingerprint(dedup_exact(batch, keys))
    # unique by construction when built by this function; a first set taken
    # from raw rows should be distinct
    seen = seen.select("fingerprint")
    new = join_keys(fresh, seen, ["fingerprint"], "left_anti")
    return new.drop("fingerprint"), seen.unionByName(new.select("fingerprint"))


def funnel_step(state: DataFrame, batch: DataFrame, keys: list[str], **kw) -> DataFrame:
    """New partial-state snapshot after one later batch (I-02 / I-03, C-04, C-06)."""
    return merge_partials(state.select(*keys, *PARTIAL_COLS), funnel_partials(batch, keys, **kw), keys)


def check_batch_order(processed_until, starts_at, batch="batch") -> None:
    """I-04: a batch must not start before the latest time already processed
    (either may be None: nothing processed, or a batch without times)."""
    if processed_until is not None and starts_at is not None and starts_at < processed_until:
        raise OutOfOrderBatch(f"{batch} starts at {starts_at}, before already processed {processed_until}")


def state_size(state: DataFrame) -> DataFrame:
    """Keys tracked by a state snapshot (D-32)."""
    return state.agg(F.count(F.lit(1)).alias("state_rows"))
