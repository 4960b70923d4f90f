"""Split index of a text export (A-04, A-06).

One counting scan stores the rows of every split.  A later read takes the
ingestion order from it, so the raw text is neither copied nor shuffled, and a
prefix run opens only the files that its rows lie in.

Splits are the same in every scan because the reader gets a session of its own
in which the bytes of a split and the cost of opening a file are one number:
Spark then cuts files at multiples of it, whatever the number of cores or of
files, and puts one split into a partition.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartwheel.sources.events import RAW_CSV_SCHEMA, require_input

SPLIT_BYTES = 128 << 20
#: Bytes of an offset row, and of all of them, up to which they are broadcast.
OFFSET_BYTES, BROADCAST_BYTES = 32, 64 << 20


def _scan(spark: SparkSession, paths, split_bytes: int) -> DataFrame:
    """Raw columns, split (file, size and time of the file as ``_file``, and
    ``_start``) and position in the split (``_at``)."""
    reader = spark.newSession()
    reader.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    reader.conf.set("spark.sql.files.openCostInBytes", str(split_bytes))
    raw = (reader.read.schema(RAW_CSV_SCHEMA).option("header", True).option("enforceSchema", False)
           .option("escape", '"').option("mode", "FAILFAST").csv(paths))
    m = F.col("_metadata")
    return raw.withColumns({
        "_path": m["file_path"], "_start": m["file_block_start"].cast("long"),
        "_file": F.xxhash64(m["file_path"], m["file_size"], m["file_modification_time"]),
        "_at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})


def build_split_index(spark: SparkSession, path: str, index_path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Counts the rows of every split of the export once and stores, per
    split, ``path``, ``file`` (hash of path, size and time), ``start``,
    ``rows``, ``base`` (rows before it, files in path order), ``file_base``
    (rows before its file) and ``split_bytes``.  Offsets are two-level: splits
    within a file, then one row per file."""
    require_input(spark, path)
    splits = _scan(spark, path, split_bytes).groupBy("_path", "_file", "_start").agg(F.count(F.lit(1)).alias("rows"), F.min("_at").alias("_first"))
    splits = spark.range(1).select(F.lit(split_bytes).cast("long").alias("split_bytes")).join(splits).select(  # one row: back in the caller's session
        F.col("_path").alias("path"), F.col("_file").alias("file"), F.col("_start").alias("start"), "rows", "_first", "split_bytes")
    splits.write.mode("overwrite").parquet(index_path + "/counts")
    counts = spark.read.parquet(index_path + "/counts")
    if not counts.where("_first <> 0").isEmpty() or not counts.groupBy("file", "start").count().where("count > 1").isEmpty():
        raise RuntimeError("splits share a partition or a key; build the index with another split_bytes")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    files = counts.groupBy("path").agg(F.sum("rows").alias("n"))
    files = files.select("path", F.coalesce(F.sum("n").over(before.orderBy("path")), F.lit(0)).alias("file_base"))
    inside = F.coalesce(F.sum("rows").over(before.partitionBy("path").orderBy("start")), F.lit(0))
    (counts.withColumn("inside", inside).join(files, "path")
     .select("path", "file", "start", "rows", (F.col("file_base") + F.col("inside")).alias("base"), "file_base", "split_bytes")
     .write.mode("overwrite").parquet(index_path + "/splits"))
    return spark.read.parquet(index_path + "/splits")


def _literal(path: str) -> str:
    """A file's path as the reader takes it: decoded, no wildcard."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", unquote(path))


def read_indexed(spark: SparkSession, index_path: str, first_rows: int | None = None) -> DataFrame:
    """Raw text events with the dense 0-based ``seq`` of the index; with
    ``first_rows`` only those rows, read from the files that hold them (a file
    is the unit: its splits after the prefix are read and filtered).  An
    export whose files changed since the index was built is an error."""
    index = spark.read.parquet(index_path + "/splits")
    wanted = index if first_rows is None else index.where(F.col("file_base") < first_rows)
    paths = sorted(_literal(r.path) for r in wanted.select("path").distinct().toLocalIterator())
    if not paths:
        return spark.createDataFrame([], RAW_CSV_SCHEMA).withColumn("seq", F.lit(0).cast("long"))
    split_bytes, splits = wanted.agg(F.max("split_bytes"), F.count(F.lit(1))).first()
    offsets = wanted.select(F.col("file").alias("_file"), F.col("start").alias("_start"), F.col("base").alias("_base"))
    if splits * OFFSET_BYTES <= BROADCAST_BYTES:
        offsets = F.broadcast(offsets)
    rows = offsets.join(_scan(spark, paths, split_bytes), ["_file", "_start"], "right")
    changed = F.raise_error(F.concat(F.lit("not in the split index: "), "_path")).cast("long")
    rows = rows.withColumn("seq", F.coalesce("_base", changed) + F.col("_at"))
    if first_rows is not None:
        rows = rows.where(F.col("seq") < first_rows)
    return rows.select(*RAW_CSV_SCHEMA.names, "seq")
