"""Keyed state that outlives a run (C-04, C-06, I-02 .. I-04, I-07).

:class:`BucketTable` keeps rows in Parquet folders by a hash bucket of their
key; an upsert reads and rewrites only the buckets of its keys.
:class:`FunnelState` keeps funnel summaries: every batch appends the summary
of its own keys, and now and then what was appended is folded into the
buckets it touches.  A batch neither reads nor rewrites the state.

All writes are Spark's own Parquet writes.  A rewrite of buckets is first
written beside the table and then put in place by dynamic partition
overwrite; a run that was cut off in between repeats the second step.  There
is one writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.operators.funnel import PARTIAL_COLS, finish, fold_slices, funnel_partials
from cartwheel.operators.incremental import check_batch_order
from cartwheel.operators.joins import upsert
from cartwheel.session import path_exists


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def folders(spark: SparkSession, root: str, name: str) -> list[int]:
    """Numbers n of the folders ``name=n`` in ``root`` whose write is complete."""
    if not path_exists(spark, root):
        return []
    fs, p = _fs(spark, root)
    found = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(x.split("=")[1]) for x in found if x.startswith(f"{name}=") and path_exists(spark, f"{root}/{x}/_SUCCESS"))


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


class BucketTable:
    """Rows by key in ``buckets`` folders below ``root``.  ``buckets`` is fixed
    for the life of a table; about the state's size by 128 MB suits."""

    def __init__(self, spark: SparkSession, root: str, keys, buckets: int = 64):
        self.spark, self.root, self.keys, self.buckets = spark, root.rstrip("/"), list(keys), buckets
        self.data, self.pending, self.done = f"{self.root}/data", f"{self.root}/pending", f"{self.root}/done"

    def bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn("bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def last(self) -> int:
        """Number of the last rewrite that is in place, -1 if none is."""
        return max(folders(self.spark, self.done, "tag"), default=-1)

    def recover(self) -> None:
        """Puts a complete rewrite in place that a cut-off run left beside."""
        for tag in folders(self.spark, self.pending, "tag"):
            if tag > self.last():
                self._place(tag)
            remove(self.spark, f"{self.pending}/tag={tag}")

    def read(self, only=None) -> DataFrame | None:
        """All rows, or those of some buckets (other folders aren't read)."""
        if self.last() < 0:
            return None
        df = self.spark.read.parquet(self.data)
        return df if only is None else df.where(F.col("bucket").isin(list(only)))

    def touched(self, rows: DataFrame) -> list[int]:
        """Buckets of ``rows`` (with a bucket column), at most ``buckets``."""
        return sorted(r[0] for r in rows.select("bucket").distinct().collect())

    def replace(self, rows: DataFrame, tag: int) -> None:
        """Rewrites the buckets in ``rows`` as a whole; ``tag`` numbers the
        rewrites upwards, and one that is in place isn't repeated."""
        if tag <= self.last():
            return
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.pending}/tag={tag}")
        self._place(tag)
        remove(self.spark, f"{self.pending}/tag={tag}")

    def _place(self, tag: int) -> None:
        (self.spark.read.parquet(f"{self.pending}/tag={tag}").repartition("bucket").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.data))
        self.spark.createDataFrame([(tag,)], "rewrite long").write.mode("overwrite").parquet(f"{self.done}/tag={tag}")

    def upsert(self, rows: DataFrame, tag: int) -> None:
        """Insert or replace by key (C-06).  Keys are unique in ``rows``."""
        self.recover()
        if tag <= self.last():
            return
        rows = self.bucketed(rows)
        old = self.read(self.touched(rows))
        self.replace(rows if old is None else upsert(old, rows.select(*old.columns), self.keys), tag)


class FunnelState:
    """Funnel per key over batches that come in time order.

    ``late``: what happens to rows before the latest time of earlier batches:
    ``reject`` the batch (the reference's way) or set them ``aside``, in a
    table with their batch, and take the rest.
    """

    def __init__(self, spark: SparkSession, root: str, keys=("user_id",), buckets: int = 64, fold_every: int = 8, late: str = "reject"):
        if late not in ("reject", "aside"):
            raise ValueError(f"late: {late}")
        self.spark, self.root, self.keys, self.fold_every, self.late = spark, root.rstrip("/"), list(keys), fold_every, late
        self.base = BucketTable(spark, f"{self.root}/base", keys, buckets)
        self.parts, self.marks, self.aside = (f"{self.root}/{x}" for x in ("partials", "marks", "late"))

    def mark(self, before: int):
        """Latest event time of the batches before ``before``."""
        if not path_exists(self.spark, self.marks):
            return None
        return self.spark.read.parquet(self.marks).where(F.col("batch") < before).agg(F.max("hi")).first()[0]

    def append(self, events: DataFrame, batch: int) -> None:
        """Adds batch number ``batch``.  Replaying the last batch replaces what
        it wrote; one that is folded already is left alone."""
        self.base.recover()
        if batch <= self.base.last():
            return
        rows, lo, hi = events.agg(F.count(F.lit(1)), F.min("event_time"), F.max("event_time")).first()
        if not rows:
            return
        mark = self.mark(batch)
        if self.late == "reject":
            check_batch_order(mark, lo, f"batch {batch}")
        elif mark is not None and lo is not None and lo < mark:
            behind = F.coalesce(F.col("event_time") < F.lit(mark), F.lit(False))
            events.where(behind).write.mode("overwrite").parquet(f"{self.aside}/batch={batch}")
            events = events.where(~behind)
        (self.base.bucketed(funnel_partials(events, self.keys)).repartition("bucket").write.mode("overwrite").partitionBy("bucket")
         .parquet(f"{self.parts}/batch={batch}"))
        hi = max((h for h in (mark, hi) if h is not None), default=None)
        self.spark.createDataFrame([(hi,)], "hi timestamp_ntz").write.mode("overwrite").parquet(f"{self.marks}/batch={batch}")
        if len(self._open()) >= self.fold_every:
            self.fold()

    def _open(self) -> list[int]:
        last = self.base.last()
        return [b for b in folders(self.spark, self.parts, "batch") if b > last]

    def _summaries(self, batches: list[int], buckets=None) -> DataFrame | None:
        """Base rows (slice -1) and appended rows of ``batches``."""
        base = self.base.read(buckets)
        out = None if base is None else base.withColumn("_slice", F.lit(-1).cast("long"))
        if batches:
            new = self.spark.read.parquet(self.parts).where(F.col("batch").isin(batches)).select(
                *self.keys, *PARTIAL_COLS, "bucket", F.col("batch").cast("long").alias("_slice"))
            out = new if out is None else out.unionByName(new)
        return out

    def fold(self) -> None:
        """Folds what was appended into the buckets it touches."""
        self.base.recover()
        batches = self._open()
        if not batches:
            return
        touched = self.base.touched(self.spark.read.parquet(self.parts).where(F.col("batch").isin(batches)))
        folded = fold_slices(self._summaries(batches, touched), ["bucket", *self.keys], "_slice")
        self.base.replace(folded.select(*self.keys, *PARTIAL_COLS[:-1], F.col("revenue_dec").cast("decimal(28,2)").alias("revenue_dec"), "bucket"),
                          batches[-1])
        for b in folders(self.spark, self.parts, "batch"):
            if b <= batches[-1]:
                remove(self.spark, f"{self.parts}/batch={b}")

    def read(self) -> DataFrame | None:
        """Summary of every key: the buckets and what is not folded yet."""
        self.base.recover()
        rows = self._summaries(self._open())
        return None if rows is None else fold_slices(rows, ["bucket", *self.keys], "_slice").drop("bucket")

    def funnel(self) -> DataFrame | None:
        rows = self.read()
        return None if rows is None else finish(rows, self.keys)

    def late_rows(self) -> DataFrame | None:
        return self.spark.read.parquet(self.aside) if path_exists(self.spark, self.aside) else None
