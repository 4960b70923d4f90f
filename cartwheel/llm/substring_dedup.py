"""Substring dedup: repeated fixed-length word windows are removed.

Every window of ``window`` words is fingerprinted by Rabin-Karp hashes and
the fingerprints are counted in Spark.  Windows are shuffled as *runs*:
consecutive windows that contain the same least-hashed short gram (the
anchor).  Two equal windows hold the same anchor, so

* a run whose anchor stands in a single document can't repeat elsewhere;
* runs with equal (anchor, run hash) are equal windows throughout, settled by
  one minimum over document ids;
* only where an anchor has several different runs (the edges of a shared
  passage) are single windows counted, for the first document of each run.

The hash pair that decides equality has 128 bits.  Counts are aggregates with
map-side combine, so a passage that a third of all documents hold sends one
row per task.  The text is shuffled by document once; both look-ups and the
final removal use the same exchange.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import BASES, ship, sliding_min, span_hashes, table, text_column, window_hashes, word_hashes

#: Words of an anchor gram, and windows in one run at most.
ANCHOR_WORDS, RUN_WINDOWS = 8, 64


def window_runs(h: np.ndarray, window: int):
    """Runs of windows with one anchor: first window, end window, anchor,
    run hash (all numpy arrays in text order)."""
    if len(h) < window:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    q = max(1, min(ANCHOR_WORDS, window // 2))
    low = sliding_min(window_hashes(h, q, BASES[1]), window - q + 1)
    cut = np.flatnonzero(low[1:] != low[:-1]) + 1
    starts = np.concatenate(([0], cut))
    ends = np.concatenate((cut, [len(low)]))
    pieces = -(-(ends - starts) // RUN_WINDOWS)
    if pieces.max() > 1:
        within = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts = np.repeat(starts, pieces) + within * RUN_WINDOWS
        ends = np.minimum(starts + RUN_WINDOWS, np.repeat(ends, pieces))
    return starts, ends, low[starts], span_hashes(h, starts, ends - 1 + window, BASES[2])


def _runs(window):
    def run(batches):
        for batch in batches:
            ids, keys, texts = (batch.column(i) for i in range(3))
            out = []
            for i in range(batch.num_rows):
                h, _, _ = word_hashes(texts[i].as_py().encode())
                s, _, anchor, run_hash = window_runs(h, window)
                if len(s):
                    out.append((np.full(len(s), ids[i].as_py()), np.full(len(s), keys[i].as_py()),
                                np.arange(len(s), dtype=np.int32), anchor.view(np.int64), run_hash.view(np.int64)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)],
                                                 names=["doc_id", "key", "k", "anchor", "run"])
    return run


def _edge_windows(window):
    """Single windows of the runs in ``edges``."""
    def run(batches):
        for batch in batches:
            ids, keys, texts, edges = (batch.column(i) for i in range(4))
            out = []
            for i in range(batch.num_rows):
                wanted = edges[i].as_py()
                if not wanted:
                    continue
                h, _, _ = word_hashes(texts[i].as_py().encode())
                s, e, anchor, _ = window_runs(h, window)
                at = np.unique(np.array(wanted))
                size = e[at] - s[at]
                pos = np.repeat(s[at], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                out.append((np.full(len(pos), ids[i].as_py()), np.full(len(pos), keys[i].as_py()),
                            pos.astype(np.int32), np.repeat(anchor[at], size).view(np.int64),
                            span_hashes(h, pos, pos + window, BASES[0]).view(np.int64)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)],
                                                 names=["doc_id", "key", "pos", "anchor", "hash"])
    return run


def _removal(window):
    def run(batches):
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            ids, texts, runs, windows = (batch.column(i) for i in range(4))
            n_words, spans, kept = [], [], []
            for i in range(batch.num_rows):
                raw = texts[i].as_py().encode()
                words = raw.split()
                gone_runs, gone_windows = runs[i].as_py(), windows[i].as_py()
                found = []
                if gone_runs or gone_windows:
                    step = np.zeros(len(words) + 1, dtype=np.int64)
                    if gone_runs:
                        s, e, _, _ = window_runs(word_hashes(raw)[0], window)
                        at = np.array(gone_runs)
                        np.add.at(step, s[at], 1)
                        np.add.at(step, e[at] - 1 + window, -1)
                    if gone_windows:
                        at = np.array(gone_windows)
                        np.add.at(step, at, 1)
                        np.add.at(step, at + window, -1)
                    gone = np.concatenate(([False], np.cumsum(step[:-1]) > 0, [False]))
                    edge = np.flatnonzero(gone[1:] != gone[:-1])
                    found = list(zip(edge[0::2].tolist(), edge[1::2].tolist()))
                    left, at = [], 0
                    for s, e in found:
                        left += words[at:s]
                        at = e
                    words_left = left + words[at:]
                else:
                    words_left = words
                n_words.append(len(words))
                spans.append([{"start": s, "end": e} for s, e in found])
                kept.append(b" ".join(words_left).decode())
            yield pa.RecordBatch.from_arrays([ids, pa.array(n_words, pa.int64()), pa.array(spans, span),
                                              pa.array(kept, pa.large_string()).cast(pa.string())],
                                             names=["doc_id", "n_words", "spans", "kept_text"])
    return run


def remove_repeated_windows(docs: DataFrame, window: int = 50) -> DataFrame:
    """Remove every word covered by a window of ``window`` consecutive words
    that also starts in a document with a smaller doc_id.

    Words are runs of bytes other than space and tab to carriage return;
    windows are judged on the input.  Returns one row per input row: doc_id,
    n_words, spans (maximal removed intervals of word positions, end
    exclusive) and kept_text (kept words joined by one space).

    Null text counts as empty.  A row with a null doc_id has no order among
    the others: it keeps all its words and removes none elsewhere.  Windows
    repeated inside one document, or in rows of the same doc_id, stay.
    Documents shorter than the window and empty tables need no special case;
    other columns of ``docs`` are ignored, whatever their names.
    """
    ship(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    known = base.filter("doc_id is not null").select("doc_id", F.xxhash64("text").alias("key"), "text")

    runs = table(known.select("doc_id", "key", "text")
                 .mapInArrow(_runs(window), "doc_id long, key long, k int, anchor long, run long"), "window-runs")
    shared = (runs.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
              .filter("lo < hi").select("anchor"))
    runs = table(runs.join(shared, "anchor", "left_semi"), "shared-runs")
    first = runs.groupBy("anchor", "run").agg(F.min("doc_id").alias("first_doc"))
    varied = first.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor", F.lit(True).alias("varied"))
    marks = table(
        runs.join(first, ["anchor", "run"]).join(varied, "anchor", "left")
        .select("doc_id", "key",
                F.when(F.col("first_doc") < F.col("doc_id"), F.col("k")).alias("gone"),
                F.when((F.col("first_doc") == F.col("doc_id")) & F.col("varied"), F.col("k")).alias("edge"))
        .filter("gone is not null or edge is not null")
        .groupBy("doc_id", "key").agg(F.collect_list("gone").alias("gone"), F.collect_list("edge").alias("edges")),
        "window-marks")

    windows = (known.join(marks.filter(F.size("edges") > 0).select("doc_id", "key", "edges"), ["doc_id", "key"])
               .select("doc_id", "key", "text", "edges")
               .mapInArrow(_edge_windows(window), "doc_id long, key long, pos int, anchor long, hash long"))
    earliest = (windows.groupBy("anchor", "hash").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
                .filter("lo < hi").select("anchor", "hash", "lo"))
    repeated = (windows.join(earliest, ["anchor", "hash"]).filter("lo < doc_id")
                .groupBy("doc_id", "key").agg(F.collect_list("pos").alias("windows")))
    joined = (known.join(marks.filter(F.size("gone") > 0).select("doc_id", "key", "gone"), ["doc_id", "key"], "left")
              .join(repeated, ["doc_id", "key"], "left").select("doc_id", "text", "gone", "windows"))
    unknown = base.filter("doc_id is null").select(
        "doc_id", "text", F.lit(None).cast("array<int>").alias("gone"), F.lit(None).cast("array<int>").alias("windows"))
    out = "doc_id long, n_words long, spans array<struct<start:long,end:long>>, kept_text string"
    return joined.mapInArrow(_removal(window), out).unionByName(unknown.mapInArrow(_removal(window), out))


def op4_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeated_windows(docs, window=50).select(
        "doc_id", "n_words",
        F.expr("aggregate(spans, 0L, (a, s) -> a + s.end - s.start)").alias("n_removed"),
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"),
        F.size("spans").cast("long").alias("n_spans"))
