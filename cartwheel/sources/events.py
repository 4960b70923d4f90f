"""Event scans (A-01 .. A-06, A-10).

The raw clickstream is a headered CSV with nine columns.  It is read with a
fixed schema (no inference); every column arrives as text so that the
missing-value tokens can be normalised before typing.  File splits take the
place of the reference's fixed-size chunks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.session import path_exists

RAW_COLUMNS = ["event_time", "event_type", "product_id", "category_id",
               "category_code", "brand", "price", "user_id", "user_session"]
# Exact-duplicate key: the nine original columns.
DEDUP_COLUMNS = list(RAW_COLUMNS)

#: Columns of another type than text.
TYPED_COLUMNS = ["event_time", "product_id", "category_id", "price", "user_id"]

RAW_CSV_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])


class MissingInputError(FileNotFoundError):
    pass


def require_input(spark: SparkSession, path: str) -> str:
    """Fail before any output is touched when the input does not exist (A-05)."""
    if not path_exists(spark, path):
        raise MissingInputError(f"input not found: {path}")
    return path


def with_ingest_seq(df: DataFrame, name: str = "seq") -> DataFrame:
    """Ingestion order of a file scan as a dense 0-based ``long`` (A-06): row
    position in the files in path order.

    The scan runs once: rows, their split (file and start) and their order in
    the task are written to the shared checkpoint folder, so the sequence
    can't depend on how a later scan is split.  Rows are then counted per
    split, and a split's offset is the number of rows before it; offsets are
    two-level (splits within a file, then one row per file).  Splits are
    known by a 64-bit hash of their path, so the offset table has a few bytes
    per split and Spark may broadcast it by its size.  There is no limit on
    files, file sizes or rows.
    """
    from pyspark.sql import Window

    from cartwheel.sources.sinks import cut_lineage
    x = cut_lineage(df.withColumns({
        "_path": F.col("_metadata.file_path"), "_start": F.col("_metadata.file_block_start").cast("long"),
        "_order": F.monotonically_increasing_id()}), "ingest")
    x = x.withColumn("_file", F.xxhash64("_path"))
    splits = x.groupBy("_path", "_file", "_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_order").alias("_first"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("_n").over(before.partitionBy("_path").orderBy("_start")), F.lit(0))
    files = splits.groupBy("_path").agg(F.sum("_n").alias("_rows"))
    files = files.select("_path", F.coalesce(F.sum("_rows").over(before.orderBy("_path")), F.lit(0)).alias("_base"))
    offsets = splits.withColumn("_inside", inside).join(files, "_path").select(
        "_file", "_start", (F.col("_base") + F.col("_inside") - F.col("_first")).alias("_offset"))
    return (x.join(offsets, ["_file", "_start"]).withColumn(name, F.col("_order") + F.col("_offset"))
            .drop("_path", "_file", "_start", "_order", "_offset"))


def read_events(spark: SparkSession, path: str, fmt: str = "csv",
                with_seq: bool = True, columns: list[str] | None = None) -> DataFrame:
    """Scan raw events.  ``fmt='csv'`` reads the headered text export with a
    fixed all-string schema; a file whose header has other names or another
    order, and a row with too few or too many fields, is an error rather than
    shifted columns.  ``fmt='parquet'`` reads already-typed events.
    ``columns`` projects early (A-02) so only those columns are read."""
    require_input(spark, path)
    if fmt == "csv":
        df = (spark.read.schema(RAW_CSV_SCHEMA).option("header", True).option("enforceSchema", False)
              .option("escape", '"').option("mode", "FAILFAST").csv(path))
    else:
        df = spark.read.parquet(path)
    if with_seq and "seq" not in df.columns:
        df = with_ingest_seq(df)
    if columns:
        keep = list(columns) + (["seq"] if with_seq and "seq" not in columns else [])
        df = df.select(*keep)
    return df


CORRUPT = "_corrupt_record"


def read_events_lenient(spark: SparkSession, path: str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """Text events of a file that may hold malformed rows (A-01, Q-16, Q-18):
    (good, bad).  ``good`` has the raw columns and ``seq``; ``bad`` has
    ``seq``, the ``reason`` and the ``line`` of every row that is set aside:

    * ``fields``: too few or too many fields;
    * ``unparsable``: a time, price or id that is there but is none.

    The file is read once, into the checkpoint folder, and both parts come
    from that table."""
    from cartwheel.operators.cleaning import coerce_lenient, normalize_null_tokens
    require_input(spark, path)
    schema = T.StructType([*RAW_CSV_SCHEMA.fields, T.StructField(CORRUPT, T.StringType(), True)])
    raw = with_ingest_seq(spark.read.schema(schema).option("header", header).option("enforceSchema", not header).option("escape", '"')
                          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    read = normalize_null_tokens(raw.withColumns({f"_raw_{c}": F.col(c) for c in RAW_COLUMNS}), RAW_COLUMNS)
    typed = coerce_lenient(read.withColumns({f"_text_{c}": F.col(c) for c in TYPED_COLUMNS}))
    lost = F.lit(False)
    for c in TYPED_COLUMNS:
        lost = lost | (F.col(f"_text_{c}").isNotNull() & F.col(c).isNull())
    reason = F.when(F.col(CORRUPT).isNotNull(), "fields").when(lost, "unparsable")
    marked = typed.withColumn("_reason", reason)
    good = marked.where(F.col("_reason").isNull()).select(*[F.col(f"_raw_{c}").alias(c) for c in RAW_COLUMNS], "seq")
    line = F.coalesce(F.col(CORRUPT), F.concat_ws(",", *[F.coalesce(f"_raw_{c}", F.lit("")) for c in RAW_COLUMNS]))
    bad = marked.where(F.col("_reason").isNotNull()).select("seq", F.col("_reason").alias("reason"), line.alias("line"))
    return good, bad


def quarantine_report(good: DataFrame, bad: DataFrame) -> DataFrame:
    """Rows read, kept and set aside by reason, as (check, rows)."""
    kept = good.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("kept").alias("check"), "rows")
    reasons = good.sparkSession.createDataFrame([("fields",), ("unparsable",)], "reason string")
    aside = reasons.join(bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n")), "reason", "left").select(
        F.concat(F.lit("set_aside_"), "reason").alias("check"), F.coalesce("n", F.lit(0)).alias("rows"))
    both = kept.unionByName(aside)
    return both.unionByName(both.agg(F.sum("rows").alias("rows")).select(F.lit("read").alias("check"), "rows"))


def input_report(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(input, present) of every named path (A-05), for a report before a run."""
    return spark.createDataFrame([(k, path_exists(spark, p)) for k, p in sorted(paths.items())], "input string, present boolean")


def head_sample(df: DataFrame, n: int, order: str = "seq") -> DataFrame:
    """First ``n`` rows in ingestion order (A-03), deterministic.  Planned as
    ``TakeOrderedAndProject``: each task keeps its own top ``n``."""
    return df.orderBy(order).limit(n)


def prefix_run(df: DataFrame, n_chunks: int, chunk_rows: int, seq: str = "seq") -> DataFrame:
    """Only the first ``n_chunks`` chunks of ``chunk_rows`` rows (A-04): a
    plain predicate on the dense sequence, which reaches the scan of a table
    that stores it.  For a text export use ``split_index.read_indexed``."""
    return df.where(F.col(seq) < F.lit(n_chunks * chunk_rows))


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def load_result(spark: SparkSession, path: str, required: list[str], fmt: str = "parquet") -> DataFrame:
    """Load a result table for later analysis and check its columns (A-10)."""
    require_input(spark, path)
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    df = reader.format(fmt).load(path)
    return require_columns(df, required).select(*required)
