"""Mixing sources to target weights by capped water-filling, DataFrame
operations only.

Sources share the words of the whole corpus by weight.  A share stops at
``max_epochs`` times its source's size, and what it can't take is reshared by
weight among the sources that still can, until no share is above its stop.
A source then takes every document as often as its share holds the source
whole; the fraction that is left takes documents once more in the order of a
seeded hash, up to the hash at which the share is reached.  That hash is found
by radix descent: each level sums sizes by the next bits of the hash inside
the cell that holds the cut, so no source is ever sorted or gathered, however
large it is.  The document at the cut gives its first words only, so a source
meets its target to the word.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import table

WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 13
#: Bits of the seeded hash (15 hex digits of an MD5), and bits settled a level.
HASH_BITS, LEVEL_BITS = 60, 15


def _ranked(sources: DataFrame) -> DataFrame:
    """Adds ``rank`` (from 0, by code point, null last).  Sources are laid out
    by range; a rank is the place in its range plus the sizes of the ranges
    before it, so only one row per range meets in one task."""
    spark = sources.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = table(sources.withColumn("unnamed", F.col("source").isNull().cast("int"))
                   .repartitionByRange(parts, "unnamed", "source")
                   .withColumn("range", F.spark_partition_id()), "mix-sources")
    before = placed.groupBy("range").agg(F.count("*").alias("rows")).select(
        "range", (F.sum("rows").over(Window.orderBy("range")) - F.col("rows")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("range").orderBy("unnamed", "source")) - 1
    return (placed.withColumn("inside", inside).join(before, "range")
            .select("source", "source_size", (F.col("inside") + F.col("before")).alias("rank")))


def fill_shares(sources: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds ``target`` (double) to the rows (source, source_size): the water
    level is raised until the shares sum to the whole, every clamped source
    giving its excess to the others by weight.

    One small aggregate a round.  The level only rises, so whatever was above
    its stop stays clamped, and the round that clamps no more is the last.
    Sums and comparisons are exact decimals.
    """
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    weighed = table(_ranked(sources).select(
        "source", "source_size", F.element_at(cycle, (F.pmod("rank", F.lit(len(weights))) + 1).cast("int")).alias("weight"),
        (F.col("source_size") * max_epochs).cast("decimal(25,0)").alias("stop")), "mix-weights")
    whole = int(weighed.agg(F.sum("source_size")).first()[0] or 0)
    clamped, before = F.lit(False), -1
    while True:
        stops, open_weight, n = weighed.agg(F.sum(F.when(clamped, F.col("stop"))), F.sum(F.when(~clamped, F.col("weight"))),
                                            F.sum(clamped.cast("long"))).first()
        if n is None or n == before or not open_weight:
            break
        before, rest, weight = n, whole - int(stops or 0), int(open_weight)
        clamped = F.expr(f"cast(weight as decimal(9,0)) * cast('{rest}' as decimal(25,0)) > stop * cast('{weight}' as decimal(12,0))")
    if before < 0:  # no source
        rest, weight = 0, 1
    share = F.col("weight") * F.lit(float(rest)) / F.lit(float(weight))
    return weighed.select("source", "source_size", F.when(clamped, F.col("stop").cast("double")).otherwise(share).alias("target"))


def _cuts(sized: DataFrame, shares: DataFrame) -> DataFrame:
    """Adds to every source: ``whole`` repetitions, and for the fraction left
    the hash ``cut`` below which documents are taken once more, the words
    ``left`` for the rows whose hash is the cut, and the number of those, ``at``.

    Each level sums by (source, cell), cells being the next bits of the hash
    inside the cell of the cut: at most 2 ** LEVEL_BITS rows a source are put
    in order, and a large source spreads over all tasks."""
    wanted = F.greatest(F.lit(0), F.round("target").cast("long") - F.col("whole") * F.col("source_size"))
    cuts = table(shares.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
                 .withColumn("left", wanted).withColumn("cut", F.lit(0).cast("long")), "mix-cuts")
    for low in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        cell = F.shiftright("hash", low).alias("cell")
        inside = sized
        if low + LEVEL_BITS < HASH_BITS:
            open_cells = cuts.filter("left > 0").select(F.col("source").alias("s"), F.col("cut").alias("c"))
            inside = sized.join(open_cells, sized["source"].eqNullSafe(open_cells["s"]) & (F.shiftright("hash", low + LEVEL_BITS) == open_cells["c"]))
        cells = inside.groupBy(F.col("source").alias("s"), cell).agg(F.sum("size").alias("words"), F.count("*").alias("at"))
        ahead = F.sum("words").over(Window.partitionBy("s").orderBy("cell")) - F.col("words")
        ordered = cells.withColumn("ahead", ahead)
        # the cell in which the running sum passes what is left
        here = (cuts["source"].eqNullSafe(ordered["s"]) & (ordered["ahead"] < cuts["left"])
                & (cuts["left"] <= ordered["ahead"] + ordered["words"]))
        cuts = table(cuts.drop("at").join(ordered, here, "left")
                     .select("source", "source_size", "target", "whole", F.coalesce(F.col("left") - F.col("ahead"), F.lit(0)).cast("long").alias("left"),
                             F.coalesce("cell", F.lit(0)).cast("long").alias("cut"), F.coalesce(ordered["at"], F.lit(1)).alias("at")), "mix-cuts")
    return cuts


def mix(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """doc_id, source, size (words), source_size, target (words of the whole
    source in the mix), whole (full repetitions), part (first words of the
    document taken besides) and taken = size * whole + part of every row.

    Words are runs of bytes other than space and tab to carriage return; null
    text has none.  Sources are weighed by code point, null last, by
    ``weights`` repeating.  A source without words has target 0.  Rows that
    repeat doc_id and text share a hash; at the cut what is left is dealt
    evenly among them, so a source may miss its target by less than one word
    per such row.  Null doc_ids are mixed like others.  An empty table gives
    no rows; other columns are ignored.  Reruns give the same mix.
    """
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce("text", F.lit(""))))
    sized = table(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source",
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long").alias("hash")), "mix-sizes")
    shares = fill_shares(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_epochs)
    cuts = _cuts(sized, shares).withColumnRenamed("source", "s")
    part = (F.when(F.col("left") == 0, 0).when(F.col("hash") < F.col("cut"), F.col("size"))
            .when(F.col("hash") == F.col("cut"), F.least("size", F.floor(F.col("left") / F.col("at")))).otherwise(0).cast("long"))
    return (sized.join(cuts, sized["source"].eqNullSafe(cuts["s"])).withColumn("part", part)
            .select("doc_id", "source", "size", "source_size", "target", "whole", "part",
                    (F.col("size") * F.col("whole") + F.col("part")).alias("taken")))


def render(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The mix itself: doc_id, source, repetition (from 0) and text, each
    document as often as ``mixed`` says, with the first ``part`` words of the
    last repetition where a document is taken in part.  ``docs`` needs unique
    doc_ids (rows without one are left out)."""
    plan = mixed.filter("doc_id is not null and taken > 0").select(F.col("doc_id").alias("id"), "size", "whole", "part")
    times = F.sequence(F.lit(0).cast("long"), F.col("whole") - F.when(F.col("part") > 0, 0).otherwise(1))
    first_words = F.concat_ws(" ", F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), F.col("part").cast("int")))
    return (docs.join(plan, docs["doc_id"] == plan["id"]).withColumn("repetition", F.explode(times))
            .select("doc_id", "source", "repetition",
                    F.when((F.col("repetition") == F.col("whole")) & (F.col("part") < F.col("size")), first_words)
                    .otherwise(F.col("text")).alias("text")))


def op13_source_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken", "source", "whole", "part")
