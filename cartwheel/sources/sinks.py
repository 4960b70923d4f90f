"""Sinks (A-07 .. A-09) and lineage cuts.

Writes are whole-job overwrites: a re-run replaces old output atomically
per job instead of deleting files up-front (I-07).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from cartwheel.session import scratch_path


def write_clean(df: DataFrame, path: str, fmt: str = "parquet", partitions: int | None = None) -> None:
    """Clean events, partitioned by ``event_date`` so date-range queries
    prune partitions.  The CSV form keeps a header like the original.

    Rows are first range-partitioned on ``(event_date, user_id, seq)``:
    each task then holds one contiguous slice of one date and writes one
    file (instead of every task writing a file into every date folder), the
    sampled range bounds split a heavy date or a heavy user over several
    tasks, and rows are clustered by user inside a date, which tightens the
    Parquet min/max statistics for later reads."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [c for c in ("event_date", "user_id", "seq") if c in df.columns]
    laid_out = df.repartitionByRange(n, *order) if order else df
    w = laid_out.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).partitionBy("event_date").csv(path)
    else:
        w.partitionBy("event_date").parquet(path)


def append_clean(df: DataFrame, path: str, batch: int, partitions: int | None = None) -> None:
    """Clean events of one batch beside those of the others (A-07, I-07):
    folder ``batch=<n>`` below ``path``, laid out as ``write_clean`` does.
    Replaying a batch replaces its folder and no other; the whole table is
    read from ``path``, by batch or by date."""
    write_clean(df, f"{path.rstrip('/')}/batch={batch}", partitions=partitions)


def write_funnel(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """User funnel ordered by user (range-partitioned sort, no single task)."""
    w = df.orderBy("user_id").write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


def write_summary(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Summary tables (segment / time / overall) are a few hundred rows at
    most, so one output file is fine; the sort happens before ``coalesce``."""
    w = df.coalesce(1).write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and read it back.

    Used between long stages so a lost executor only recomputes from the
    written table, never the whole lineage.  Always reliable storage —
    never an executor-local checkpoint.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a result that a plan reads several times
    (e.g. a summary table behind several scalar thresholds), so its upstream
    work runs once.  Written to the SparkContext checkpoint folder, which
    follows ``spark.checkpoint.dir`` (shared storage on a cluster)."""
    from cartwheel.session import checkpoint_root
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(checkpoint_root(df.sparkSession))
    return df.checkpoint(eager=True)
