"""Rows seen so far, as a table that outlives a run (C-05, C-07, I-01).

Fingerprints lie in folders by batch and prefix.  A batch is deduplicated and
written once, by prefix; only its fingerprints meet those of the same
prefixes, so the wide rows are shuffled for the dedup alone.  Rows seen before
are then left out by their fingerprints, a set that is small where repeats
are rare (Spark broadcasts it if it is).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.operators.dedup import dedup_exact, fingerprint
from cartwheel.operators.keyed_state import folders, remove
from cartwheel.sources.events import DEDUP_COLUMNS


class SeenStore:
    """``prefix`` hex digits of the fingerprint name its folder: two give 256."""

    def __init__(self, spark: SparkSession, root: str, keys=DEDUP_COLUMNS, prefix: int = 2):
        self.spark, self.root, self.keys, self.prefix = spark, root.rstrip("/"), list(keys), prefix
        self.prints, self.staged = f"{self.root}/fingerprints", f"{self.root}/staged"

    def seen(self, before: int, prefixes: list[str]) -> DataFrame | None:
        """Fingerprints of earlier batches in the folders of ``prefixes``."""
        earlier = [b for b in folders(self.spark, self.prints, "batch") if b < before]
        if not earlier:
            return None
        return self.spark.read.schema("fingerprint string, batch int, prefix string").parquet(self.prints).where(
            F.col("batch").isin(earlier) & F.col("prefix").isin(prefixes)).select("prefix", "fingerprint")

    def add(self, batch: DataFrame, number: int, out: str) -> None:
        """Writes the rows of batch ``number`` that no earlier batch held to
        ``out/batch=number`` (of copies inside the batch the first), and
        remembers them.  A replay replaces what the batch wrote."""
        staged, rows = f"{self.staged}/batch={number}", f"{out}/batch={number}"
        fresh = fingerprint(dedup_exact(batch, self.keys), self.keys)
        fresh.withColumn("prefix", F.substring("fingerprint", 1, self.prefix)).write.mode("overwrite").partitionBy("prefix").parquet(staged)
        kind = fresh.schema.add("prefix", "string")
        fresh = self.spark.read.schema(kind).parquet(staged)
        prefixes = [r[0] for r in fresh.select("prefix").distinct().collect()]  # 16 ** prefix at most
        seen = self.seen(number, prefixes)
        if seen is not None:
            again = fresh.select("prefix", "fingerprint").join(seen, ["prefix", "fingerprint"], "left_semi")
            fresh = fresh.join(again, ["prefix", "fingerprint"], "left_anti")
        fresh.drop("prefix").write.mode("overwrite").parquet(rows)
        (self.spark.read.parquet(rows).select("fingerprint", F.substring("fingerprint", 1, self.prefix).alias("prefix"))
         .write.mode("overwrite").partitionBy("prefix").parquet(f"{self.prints}/batch={number}"))
        remove(self.spark, staged)
