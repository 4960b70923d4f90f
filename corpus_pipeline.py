"""Corpus pipeline: toxic documents go, one document of each group of near
duplicates stays, contaminated documents go, personal data is masked, and the
rest is encoded.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before
it kept; its result is written as Parquet and read again as the next one's
``docs``.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm import bpe, decontamination, jaccard_join, pii, toxicity
from cartwheel.llm.common import table, text_column

#: SQL has no toxicity model, alignment or byte-pair merges; tests/llm hold
#: the stages against brute force instead.
ORACLE_SQL = None

#: Words of a shingle, and similarity in percent, of the near-duplicate stage.
SHINGLE, PERCENT = 5, 80
#: Characters the encoder's tasks hold at a time, next to what executors keep
#: of the stages before.
BLOCK_CHARS = 8_000_000


def _keeps_columns(stage):
    """A stage that sees columns of its own naming beside doc_id and text, so
    that no column of the input can clash with those of its operator, and
    returns the columns of its input."""
    @functools.wraps(stage)
    def run(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = [c if c in ("doc_id", "text") else f"other_column_{i}" for i, c in enumerate(docs.columns)]
        return stage(spark, docs.toDF(*names), sf_dir).select(*names).toDF(*docs.columns)
    return run


@_keeps_columns
def drop_toxic(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scoring under 0.5.  A null text is scored as empty and stays
    null; null ids are scored; repeated rows are treated alike; without rows
    or labels nothing but the fixed lexicon decides."""
    model = toxicity.fit(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score_texts(docs, model).filter("toxicity < 0.5").drop("toxicity")


@_keeps_columns
def drop_near_duplicates(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates (five words, 80 percent):
    the one of smallest doc_id, null last.

    A document is a doc_id with a text: rows of one doc_id and different texts
    are grouped by their own texts, and of rows equal in both one stays (their
    other columns may differ; which is not fixed).  Texts without words, and
    null texts, are in no group and stay."""
    node = F.xxhash64("doc_id", text_column())
    groups = table(jaccard_join.near_duplicates(docs.select(node.alias("doc_id"), "text"), SHINGLE, PERCENT)
                   .filter("n_shingles > 0").groupBy(F.col("doc_id").alias("node"))
                   .agg(F.min("component_id").alias("component"), F.count("*").alias("rows")), "groups")
    ids = docs.select(node.alias("node"), F.col("doc_id").isNull().alias("unnamed"), "doc_id").distinct()
    members = groups.join(ids, "node")
    first = members.groupBy("component").agg(F.min(F.struct("unnamed", "doc_id", "node")).alias("first"), F.count("*").alias("size")).filter("size > 1")
    goes = members.join(first, "component").filter("node <> first.node").select("node", F.lit(True).alias("goes"))
    marks = table(goes.unionByName(groups.filter("rows > 1").select("node", F.lit(False).alias("goes")))
                  .groupBy(F.col("node").alias("marked_node")).agg(F.max("goes").alias("goes")), "marks")
    marked = docs.join(marks, node == marks["marked_node"], "left")
    repeated = marked.filter("not goes").dropDuplicates(["marked_node"])
    return marked.filter("goes is null").unionByName(repeated).drop("marked_node", "goes")


@_keeps_columns
def drop_contaminated(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a benchmark item.  Null and empty texts
    hold none; rows that repeat doc_id and text stay or go together."""
    found = decontamination.contaminated(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    bad = table(found.select(F.col("doc_id").alias("bad_id"), F.col("key").alias("bad_key")).distinct(), "contaminated")
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["bad_id"]) & (F.xxhash64(text_column()) == bad["bad_key"]), "left_anti")


def mask_personal_data(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind in brackets and
    n_chars counted anew.  Null texts stay null."""
    masked = _keeps_columns(lambda spark, docs, _: pii.find_pii(docs, redact=True).drop("pii_spans"))(spark, docs, sf_dir)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked


def encode_documents(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit) of every document, with
    digests of the ids and of the bytes they decode to."""
    rank_path, pattern = bpe.public_vocabulary()
    return bpe.encode(docs, rank_path, pattern, decoded=True, block_chars=BLOCK_CHARS).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", mask_personal_data),
    ("byte_bpe", encode_documents),
]


def run(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
