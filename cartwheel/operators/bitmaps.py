"""Exact distinct counts that merge over batches (D-14, D-15, D-21, I-05).

Values are numbered densely, each once, by a dictionary that grows with the
batches.  A batch stores one bitmap of its numbers per group and 32 768
numbers; bitmaps of batches are united and their bits counted, so no row per
(group, value) is kept and old batches aren't read again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.functions.columns import money
from cartwheel.operators.keyed_state import folders
from cartwheel.sources.sinks import cut_lineage


def number_values(values: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(attribute, value, number) of the distinct ``values`` not in ``known``:
    numbers go on from the last known one of the attribute, dense from 1.

    Values are laid out by range; a number is the place in its range and the
    sizes of the ranges before, so one row per range and attribute meets."""
    new = values.select("attribute", "value").distinct()
    last = None
    if known is not None:
        new = new.join(known.select("attribute", "value"), ["attribute", "value"], "left_anti")
        last = known.groupBy("attribute").agg(F.max("number").alias("last"))
    parts = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut_lineage(new.repartitionByRange(parts, "attribute", "value").withColumn("range", F.spark_partition_id()), "numbered")
    before = placed.groupBy("attribute", "range").agg(F.count(F.lit(1)).alias("rows")).select(
        "attribute", "range", (F.sum("rows").over(Window.partitionBy("attribute").orderBy("range")) - F.col("rows")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("attribute", "range").orderBy("value"))
    out = placed.withColumn("inside", inside).join(before, ["attribute", "range"])
    if last is not None:
        out = out.join(last, "attribute", "left")
    start = F.coalesce("last", F.lit(0)) if last is not None else F.lit(0)
    return out.select("attribute", "value", (F.col("inside") + F.col("before") + start).cast("long").alias("number"))


def bitmaps(pairs: DataFrame, numbers: DataFrame, group: list[str]) -> DataFrame:
    """One bitmap per group, attribute and block of numbers of the distinct
    ``pairs`` (group columns, attribute, value)."""
    return (pairs.distinct().join(numbers, ["attribute", "value"])
            .groupBy(*group, "attribute", F.bitmap_bucket_number("number").alias("block"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")))


def united(parts: DataFrame, group: list[str]) -> DataFrame:
    """The bitmaps of several batches as one per group, attribute and block."""
    return parts.groupBy(*group, "attribute", "block").agg(F.bitmap_or_agg("bits").alias("bits"))


def bit_counts(parts: DataFrame, group: list[str]) -> DataFrame:
    """Distinct values per group and attribute."""
    return united(parts, group).groupBy(*group, "attribute").agg(F.sum(F.bitmap_count("bits")).alias("distinct_values"))


class DistinctStore:
    """Dictionary and bitmaps below ``root``, by batch; a replayed batch
    replaces its own."""

    def __init__(self, spark: SparkSession, root: str, group=()):
        self.spark, self.root, self.group = spark, root.rstrip("/"), list(group)

    def _before(self, name: str, batch: int | None) -> DataFrame | None:
        root = f"{self.root}/{name}"
        have = [b for b in folders(self.spark, root, "batch") if batch is None or b < batch]
        return self.spark.read.parquet(root).where(F.col("batch").isin(have)).drop("batch") if have else None

    def add(self, df: DataFrame, attributes: list[str], batch: int) -> None:
        """Values (nulls left out) of ``attributes`` of a batch, by the group
        columns."""
        each = [F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("value")) for a in attributes]
        pairs = (df.select(*self.group, F.explode(F.array(*each)).alias("_v")).select(*self.group, "_v.*")
                 .where(F.col("value").isNotNull()))
        pairs = cut_lineage(pairs.distinct(), "distinct-pairs")
        known = self._before("numbers", batch)
        number_values(pairs, known).write.mode("overwrite").parquet(f"{self.root}/numbers/batch={batch}")
        bitmaps(pairs, self._before("numbers", batch + 1), self.group).write.mode("overwrite").parquet(f"{self.root}/bitmaps/batch={batch}")

    def counts(self) -> DataFrame:
        return bit_counts(self._before("bitmaps", None), self.group)


class ActivityStore:
    """Purchase activity per time value over batches: distinct users as
    bitmaps, purchases and revenue as sums."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.users = DistinctStore(spark, f"{self.root}/users", ["time_dimension", "time_value"])

    def add(self, events: DataFrame, batch: int) -> None:
        from cartwheel.operators.time_analysis import by_hour_and_weekday
        p = by_hour_and_weekday(events.where(F.col("event_type") == "purchase"))
        self.users.add(p, ["user_id"], batch)
        (p.groupBy("time_dimension", "time_value").agg(
            F.count(F.lit(1)).alias("purchase_events"), F.sum(money(F.coalesce(F.col("price"), F.lit(0)))).alias("revenue"))
         .write.mode("overwrite").parquet(f"{self.root}/sums/batch={batch}"))

    def read(self) -> DataFrame:
        """time_dimension, time_value, purchase_users, purchase_events, revenue."""
        sums = self.spark.read.parquet(f"{self.root}/sums").groupBy("time_dimension", "time_value").agg(
            F.sum("purchase_events").alias("purchase_events"), F.sum("revenue").cast("double").alias("revenue"))
        users = self.users.counts().select("time_dimension", "time_value", F.col("distinct_values").alias("purchase_users"))
        return sums.join(users, ["time_dimension", "time_value"], "left").select(
            "time_dimension", "time_value", F.coalesce("purchase_users", F.lit(0)).cast("long").alias("purchase_users"), "purchase_events", "revenue")


def sketches(df: DataFrame, attributes: list[str], by: str, lg_k: int = 12) -> DataFrame:
    """One HyperLogLog sketch of every attribute per value of ``by``."""
    return df.groupBy(by).agg(*[F.hll_sketch_agg(F.col(a).cast("string"), lg_k).alias(a) for a in attributes])


def sketch_estimates(parts: DataFrame, attributes: list[str], lg_k: int = 12, deviations: float = 3.0) -> DataFrame:
    """attribute, estimate and bound (its error in values, at ``deviations``
    standard errors of a sketch of 2 ** ``lg_k`` registers) of united sketches."""
    one = parts.agg(*[F.hll_sketch_estimate(F.hll_union_agg(a)).alias(a) for a in attributes])
    each = [one.select(F.lit(a).alias("attribute"), F.col(a).alias("estimate")) for a in attributes]
    bound = deviations * 1.04 / 2 ** (lg_k / 2)
    return reduce(DataFrame.unionByName, each).withColumn("bound", F.ceil(F.col("estimate") * bound) + 1)
