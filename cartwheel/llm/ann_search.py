"""Approximate nearest neighbours by an adaptive dimension scan.

Vectors are dealt to lists (k-means fitted on a bounded sample); a query
probes the nearest lists.  Inside a list, rotated vectors are read in column
blocks: after each block a hypothesis test on the partial distance abandons
the candidates that are very unlikely to enter the query's best (ADSampling;
Gao and Long, 2023).  How many lists to probe is measured on the sample until
its recall reaches the target.

Equal vectors are one class, so a vector that a third of all rows hold is
scanned once and only its smallest ids are kept.  Candidates that tie with the
last one kept (scaled copies) are all scored exactly before any is left out.  Large lists are cut into
chunks of bounded size; a query visits all chunks of a probed list.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartwheel.llm.common import ship, table

#: Rows (expected) that the index is fitted on, largest number of lists, rows a list.
SAMPLE, MOST_LISTS, LIST_ROWS = 20_000, 4096, 1000
#: Sample queries and recall aimed at when the number of probed lists is chosen.
PROBE_QUERIES, RECALL = 200, 0.97
#: Rows of a list's chunk, queries of a chunk, columns of a block, test width.
CHUNK, QUERIES, COLUMNS, EPSILON = 8192, 4096, 16, 2.1
#: Squared distances of unit vectors that differ by less count as tied in a scan.
TIED = 1e-9


def _vectors(batches):
    """vec_id, number of dimensions, class hashes and bytes (doubles) of the
    usable vectors."""
    for batch in batches:
        rows = []
        for vec_id, v in zip(batch.column(0).to_pylist(), batch.column(1)):
            x = v.values.to_numpy(zero_copy_only=False).astype(np.float64) if v.is_valid else None
            if x is None or not len(x) or not np.isfinite(x).all() or not x.any():
                continue
            x = x + 0.0  # one zero
            h = pd.util.hash_array(x.view(np.uint64), categorize=False)
            i = np.arange(len(x), dtype=np.uint64)
            h1 = (h * (2 * i + np.uint64(0x9E3779B97F4A7C15))).sum()
            h2 = ((h ^ (h >> np.uint64(29))) * (2 * i + np.uint64(0xD6E8FEB86659FD93))).sum()
            rows.append((vec_id, len(x), int(h1.view(np.int64)), int(h2.view(np.int64)), x.tobytes()))
        if rows:
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["vec_id", "dim", "h1", "h2", "vec"])


def _matrix(column, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_buffer() for x in column), dtype=np.float64).reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


class Index:
    """Centroids of the lists, the rotation, and the lists to probe."""

    def __init__(self, sample: np.ndarray, rows: int, k: int, recall: float, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.dim = sample.shape[1]
        self.rotation = np.linalg.qr(rng.normal(size=(self.dim, self.dim)))[0]
        unit = _unit(sample)
        lists = int(max(1, min(MOST_LISTS, rows // LIST_ROWS, len(unit) // 8)))
        c = unit[rng.choice(len(unit), lists, replace=False)]
        for _ in range(12):
            near = self._nearest(unit, c)
            for j in range(self.dim):
                c[:, j] = np.bincount(near, weights=unit[:, j], minlength=lists)
            size = np.bincount(near, minlength=lists)
            empty = size == 0
            c[~empty] /= size[~empty, None]
            c[empty] = unit[rng.choice(len(unit), int(empty.sum()))]
        self.centroids = c
        self.probes = self._calibrate(unit, rng, k, recall)

    @staticmethod
    def _nearest(x, c):
        return np.concatenate([((c * c).sum(1) - 2 * x[i:i + 4096] @ c.T).argmin(1) for i in range(0, len(x), 4096)]) if len(x) else np.zeros(0, np.int64)

    def lists_of(self, unit: np.ndarray) -> np.ndarray:
        return self._nearest(unit, self.centroids)

    def probed(self, unit: np.ndarray) -> np.ndarray:
        d = (self.centroids ** 2).sum(1) - 2 * unit @ self.centroids.T
        return np.argsort(d, axis=1, kind="stable")[:, :self.probes]

    def _calibrate(self, unit, rng, k, recall):
        """Least number of lists that holds ``recall`` of the sample's own
        nearest neighbours."""
        chosen = rng.choice(len(unit), min(PROBE_QUERIES, len(unit)), replace=False)
        sims = unit[chosen] @ unit.T
        sims[np.arange(len(chosen)), chosen] = -np.inf
        true = np.argsort(-sims, axis=1)[:, :min(k, max(1, len(unit) - 1))]
        home = self.lists_of(unit)
        self.probes = len(self.centroids)
        rank = np.argsort(self.probed(unit[chosen]), axis=1)
        needed = np.sort(np.take_along_axis(rank, home[true], axis=1).ravel())
        return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)]) + 1 if len(needed) else len(self.centroids)


def scan(query: np.ndarray, vectors: np.ndarray, keep: int) -> np.ndarray:
    """Positions of the ``keep`` nearest of the rotated unit ``vectors`` and of
    all that tie with the last of them: column blocks, with candidates
    abandoned by partial distances."""
    n, dim = vectors.shape

    def nearest_of(near, where):
        if len(near) > keep:
            stay = near <= np.partition(near, keep - 1)[keep - 1] + TIED
            near, where = near[stay], where[stay]
        return near, where

    first = min(n, max(4 * keep, 64))
    near, where = nearest_of(((vectors[:first] - query) ** 2).sum(1), np.arange(first))
    for at in range(first, n, 1024):
        live = np.arange(at, min(at + 1024, n))
        partial = np.zeros(len(live))
        limit = np.partition(near, keep - 1)[keep - 1] + TIED if len(near) >= keep else np.inf
        for j in range(0, dim, COLUMNS):
            seen = min(j + COLUMNS, dim)
            partial = partial + ((vectors[live, j:seen] - query[j:seen]) ** 2).sum(1)
            bound = limit if seen == dim else limit * (seen / dim) * (1 + EPSILON / np.sqrt(seen)) ** 2
            stay = partial <= bound
            live, partial = live[stay], partial[stay]
            if not len(live):
                break
        if len(live):
            near, where = nearest_of(np.concatenate((near, partial)), np.concatenate((where, live)))
    return where


def _search_cells(index, keep):
    """One chunk of a list with the queries that probe it."""
    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        i = index.value
        out = []
        if queries.num_rows and rows.num_rows:
            q, x = _matrix(queries.column("vec"), i.dim), _matrix(rows.column("vec"), i.dim)
            q_unit, x_unit = _unit(q), _unit(x)
            turned, q_turned = x_unit @ i.rotation, q_unit @ i.rotation
            ids = np.array(rows.column("vec_id").to_pylist(), dtype=np.int64)
            norms = np.sqrt((x * x).sum(1))
            for n, query_class in enumerate(queries.column("vec_id").to_pylist()):
                at = scan(q_turned[n], turned, keep)
                with np.errstate(all="ignore"):
                    score = (x[at] * q[n]).sum(1) / (norms[at] * np.sqrt((q[n] * q[n]).sum()))
                score = np.where(np.isfinite(score), score, x_unit[at] @ q_unit[n])
                best = np.lexsort((ids[at], -score))[:keep]  # ties of the scan: by the exact score, then the smaller id
                out.append((np.full(len(best), query_class), ids[at][best], score[best]))
        a, b, s = (np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return pa.table({"query_class": a, "class": b, "score": s})
    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, recall: float = RECALL) -> DataFrame:
    """The ``k`` nearest rows (largest cosine, in doubles, of the original
    vectors) of every row of ``queries`` (vec_id): query_id, rank, vec_id,
    score; nearest first, ties to the smaller vec_id, never the query itself.

    Null, empty and zero vectors, vectors with null or non-finite components
    and rows with a null vec_id take no part.  Vectors are compared with
    those of the same number of dimensions.  Repeated rows count once; of
    rows that repeat a vec_id with other vectors each is a candidate.  Fewer
    candidates than k give all of them; an empty table gives no rows; other
    columns are ignored.
    """
    spark = vectors.sparkSession
    ship(spark)
    usable = table(vectors.filter("vec_id is not null and embedding is not null")
                   .select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
                   .mapInArrow(_vectors, "vec_id long, dim int, h1 long, h2 long, vec binary"), "vectors")
    same = ["dim", "h1", "h2"]
    # k + 1 ids stand for a class; the group limit is applied before the shuffle, too
    ranked = (usable.select("vec_id", *same).distinct()
              .withColumn("nth", F.row_number().over(Window.partitionBy(*same).orderBy("vec_id"))).filter(F.col("nth") <= k + 1))
    ids = table(ranked, "class-ids")
    heads = ids.filter("nth = 1").select("vec_id", *same)
    classes = table(usable.join(heads, ["vec_id", *same], "left_semi").dropDuplicates(["vec_id", *same]), "classes")
    ids = ids.join(heads.withColumnRenamed("vec_id", "class"), same).select("class", "vec_id")
    asked = (usable.join(queries.select(F.col("vec_id").cast("long").alias("vec_id")).distinct(), "vec_id", "left_semi")
             .select("vec_id", *same).distinct().join(heads.withColumnRenamed("vec_id", "class"), same).select(F.col("vec_id").alias("query_id"), "class", "dim"))
    keep = 2 * (k + 1)

    found = None
    for dim, rows in sorted(tuple(r) for r in classes.groupBy("dim").agg(F.count("*")).collect()):
        own = classes.filter(F.col("dim") == dim).select("vec_id", "vec")
        steps = 1 << 30
        cut = int(steps * min(1.0, SAMPLE / rows))
        sample = own.filter(F.pmod(F.xxhash64("vec_id"), F.lit(steps)) < cut).orderBy("vec_id").select("vec").collect()
        if not sample:
            sample = own.limit(1).select("vec").collect()
        index = spark.sparkContext.broadcast(Index(np.stack([np.frombuffer(r["vec"], dtype=np.float64) for r in sample]), rows, k, recall))

        def to_list(batches, index=index):
            for b in batches:
                if b.num_rows:
                    lists = index.value.lists_of(_unit(_matrix(b.column(1), index.value.dim)))
                    yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lists.astype(np.int32))], names=["vec_id", "vec", "list"])

        def to_probes(batches, index=index):
            for b in batches:
                if b.num_rows:
                    lists = index.value.probed(_unit(_matrix(b.column(1), index.value.dim))).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lists.tolist(), pa.list_(pa.int32()))], names=["vec_id", "vec", "lists"])

        listed = own.mapInArrow(to_list, "vec_id long, vec binary, list int")
        wanted = own.join(asked.select(F.col("class").alias("vec_id")).distinct(), "vec_id", "left_semi").select("vec_id", "vec")
        probes = (wanted.mapInArrow(to_probes, "vec_id long, vec binary, lists array<int>")
                  .select("vec_id", "vec", F.explode("lists").alias("list")))
        # chunks of a list and of its queries, by their numbers (one row a list)
        size = listed.groupBy("list").agg(F.ceil(F.count("*") / F.lit(CHUNK)).cast("int").alias("chunks"))
        load = probes.groupBy("list").agg(F.ceil(F.count("*") / F.lit(QUERIES)).cast("int").alias("groups"))
        cells = F.broadcast(table(size.join(load, "list"), "cells"))  # MOST_LISTS rows at most

        def one_of(c):
            return F.pmod(F.xxhash64("vec_id"), F.col(c)).cast("int")

        def all_of(c):
            return F.explode(F.sequence(F.lit(0), F.col(c) - 1))

        rows_in = listed.join(cells, "list").withColumn("chunk", one_of("chunks")).withColumn("group", all_of("groups"))
        asks_in = probes.join(cells, "list").withColumn("group", one_of("groups")).withColumn("chunk", all_of("chunks"))
        key = ["list", "chunk", "group"]
        part = (asks_in.select("vec_id", "vec", *key).groupBy(*key).cogroup(rows_in.select("vec_id", "vec", *key).groupBy(*key))
                .applyInArrow(_search_cells(index, keep), "query_class long, class long, score double"))
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    best = (found.withColumn("nth", F.row_number().over(Window.partitionBy("query_class").orderBy(F.desc("score"), "class")))
            .filter(F.col("nth") <= keep).drop("nth"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.join(ids, "class").select(F.col("query_class").alias("class"), "vec_id", "score")
            .join(asked.select("query_id", "class"), "class").filter("vec_id <> query_id")
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def op2_ann_search(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, vectors.filter("vec_id % 50 = 0"), k=5)
