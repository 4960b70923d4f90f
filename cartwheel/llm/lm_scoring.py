"""Log-bilinear language model, trained by noise-contrastive estimation in
numpy, scoring every document with normalised token log-probabilities.

Tokens are lower-cased words and one end per document.  The model predicts a
token's class from the classes of the two tokens before it, and the token
within its class from corpus counts:

    log P(w | u, v) = (C1[u] + C2[v]) . Q[k] + b[k] - log Z(u, v) + log P(w | k)

with k the class of w.  The ``own_classes`` most frequent words are classes of
their own; every other word belongs to one of ``rest_classes`` by its last
bytes.  With A = C1 Qt and B = C2 Qt + b, Z is the product exp(A) exp(B)t: one
batched matrix product normalises every context at once.

Counts come from all training documents.  Training is data-parallel: each
task runs NCE steps over its own share, and the parameters are averaged by
tokens after every round.  Words beyond the ``direct_words`` most frequent
(a table of bounded size that every task holds) get their counts by a join,
and none of these can be a hot key.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import fold_column, ship, table, text_column

DIRECT_WORDS, OWN_CLASSES, REST_CLASSES, SUFFIX = 200_000, 1500, 256, 3
DIMENSIONS, NOISE, BATCH, ROUNDS, RATE = 16, 24, 4096, 2, 0.15
#: Distinct words that a task counts before it sends them on, longest word kept whole.
HELD_WORDS, LONG_WORD = 700_000, 256
SLICE = 16384


def words_of(text: str) -> list[bytes]:
    """Lower-cased (A-Z) words; one of over LONG_WORD bytes is stood for by a
    space, which no word has, and its digest."""
    words = text.encode().lower().split()
    if max(map(len, words), default=0) > LONG_WORD:
        words = [w if len(w) <= LONG_WORD else b" " + hashlib.sha256(w).digest() for w in words]
    return words


def _count_words(batches):
    def send(held):
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "c"])

    held = Counter()
    for batch in batches:
        for text in batch.column(0):
            held.update(words_of(text.as_py()))
            if len(held) >= HELD_WORDS:
                yield send(held)
                held = Counter()
    if held:
        yield send(held)


def word_counts(texts: DataFrame) -> DataFrame:
    """word (binary), c: occurrences in the whole texts, pre-counted per task."""
    return (texts.select(text_column().alias("text")).mapInArrow(_count_words, "word binary, c long")
            .groupBy("word").agg(F.sum("c").alias("c")))


def rest_class(word: bytes, rest: int) -> int:
    return zlib.crc32(word[-SUFFIX:]) % rest


class _Numbers(dict):
    """Number of a word: its rank among the direct words, or the next free
    one for any other word."""

    def __init__(self, direct):
        super().__init__(direct)
        self.rare = []
        self.top = len(direct)

    def __missing__(self, word):
        self[word] = n = self.top + len(self.rare)
        self.rare.append(word)
        return n


def _sequences(direct_words, direct_logs, own, rest):
    """Class sequence, sums over direct words, and the rare words of every
    document."""
    def run(batches):
        ranks = {w: i for i, w in enumerate(direct_words.value)}
        logs = direct_logs.value
        own_n = min(own, len(ranks))
        of_direct = np.array([i if i < own_n else own_n + rest_class(w, rest) for i, w in enumerate(ranks)], dtype=np.uint16)
        pack = zstandard.ZstdCompressor(level=3).compress
        numbers = _Numbers(ranks)
        for batch in batches:
            ids, keys, texts = (batch.column(i) for i in range(3))
            for at in range(0, batch.num_rows, 500):
                rows = []
                for i in range(at, min(at + 500, batch.num_rows)):
                    words = words_of(texts[i].as_py())
                    n = np.array([numbers[w] for w in words], dtype=np.int64)
                    is_rare = n >= numbers.top
                    classes = np.empty(len(n), dtype=np.uint16)
                    classes[~is_rare] = of_direct[n[~is_rare]]
                    found, times = np.unique(n[is_rare] - numbers.top, return_counts=True)
                    listed = [numbers.rare[k] for k in found]
                    if len(found):
                        kinds = np.array([own_n + rest_class(w, rest) for w in listed], dtype=np.uint16)
                        classes[is_rare] = kinds[np.searchsorted(found, n[is_rare] - numbers.top)]
                    direct = n[~is_rare]
                    rows.append((ids[i].as_py(), keys[i].as_py(), len(n), len(direct), float(logs[direct].sum()),
                                 float(logs[direct[direct >= own_n]].sum()), pack(classes.tobytes()), listed, times.tolist()))
                    if len(numbers.rare) > HELD_WORDS:
                        numbers = _Numbers(ranks)
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(),
                         pa.list_(pa.binary()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                 names=["doc_id", "key", "n_words", "n_direct", "direct_log", "rest_log", "classes", "rare", "times"])
    return run


SEQUENCE = ("doc_id long, key long, n_words long, n_direct long, direct_log double, rest_log double, classes binary, "
            "rare array<binary>, times array<long>")


class Parameters:
    """C1, C2, Q and b for ``n`` classes; context ``n`` stands before the text."""

    def __init__(self, n: int, d: int, flat: np.ndarray | None = None, prior: np.ndarray | None = None):
        self.n, self.d = n, d
        size = (2 * (n + 1) + n) * d + n
        if flat is None:
            flat = np.random.default_rng(7).normal(0, 0.1, size).astype(np.float32)
            flat[-n:] = np.log(prior)
        self.flat = flat
        cut = np.cumsum([(n + 1) * d, (n + 1) * d, n * d])
        c1, c2, q, self.b = np.split(flat, cut)
        self.c1, self.c2, self.q = c1.reshape(-1, d), c2.reshape(-1, d), q.reshape(-1, d)


def _scatter(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    out = np.empty((n, values.shape[1]), dtype=np.float32)
    for j in range(values.shape[1]):
        out[:, j] = np.bincount(rows, weights=values[:, j], minlength=n)
    return out


def nce_steps(p: Parameters, accumulated: np.ndarray, w, u, v, log_noise, noise_cdf, k, rng, rate=RATE) -> None:
    """One Adagrad step of noise-contrastive estimation: ``w`` with contexts
    ``u`` and ``v`` against ``k`` noise classes shared by the batch."""
    grad = Parameters(p.n, p.d, np.zeros_like(p.flat))
    noise = np.minimum(np.searchsorted(noise_cdf, rng.random(k)), p.n - 1)
    h = p.c1[u] + p.c2[v]
    positive = (h * p.q[w]).sum(1) + p.b[w] - log_noise[w] - np.log(k)
    negative = h @ p.q[noise].T + (p.b[noise] - log_noise[noise] - np.log(k))
    up = 1 / (1 + np.exp(np.clip(positive, -30, 30)))
    down = -1 / (1 + np.exp(np.clip(-negative, -30, 30)))
    gh = up[:, None] * p.q[w] + down @ p.q[noise]
    grad.c1[:] = _scatter(u, gh, p.n + 1)
    grad.c2[:] = _scatter(v, gh, p.n + 1)
    grad.q[:] = _scatter(w, up[:, None] * h, p.n)
    np.add.at(grad.q, noise, down.T @ h)
    grad.b[:] = np.bincount(w, weights=up, minlength=p.n)
    np.add.at(grad.b, noise, down.sum(0))
    g = grad.flat / len(w)
    accumulated += g * g
    p.flat += rate * g / np.sqrt(accumulated + 1e-10)


def _contexts(classes: np.ndarray, n: int):
    """Predicted classes (the words, then the end) and the two before each."""
    w = np.append(classes.astype(np.int64), n - 1)
    u = np.concatenate(([n], w[:-1]))
    v = np.concatenate(([n, n], w[:-2]))[:len(w)]
    return w, u, v


def _train(flat, n, d, prior, seed):
    """NCE over one task's documents; sends the parameters weighted by tokens."""
    def run(batches):
        p = Parameters(n, d, flat.value.copy())
        accumulated = np.full_like(p.flat, 1e-4)
        log_noise, cdf = np.log(prior).astype(np.float32), np.cumsum(prior)
        rng = np.random.default_rng(seed)
        unpack = zstandard.ZstdDecompressor().decompress
        held, size, seen = [], 0, 0

        def steps():
            w, u, v = (np.concatenate(x) for x in zip(*held))
            order = rng.permutation(len(w))
            for at in range(0, len(w), BATCH):
                o = order[at:at + BATCH]
                nce_steps(p, accumulated, w[o], u[o], v[o], log_noise, cdf, NOISE, rng)

        for batch in batches:
            for blob in batch.column(0):
                held.append(_contexts(np.frombuffer(unpack(blob.as_buffer()), dtype=np.uint16), n))
                size += len(held[-1][0])
                if size >= 64 * BATCH:
                    steps()
                    seen += size
                    held, size = [], 0
        if held:
            steps()
            seen += size
        if seen:
            parts = [(p.flat[at:at + SLICE].astype(np.float64) * seen).tobytes() for at in range(0, len(p.flat), SLICE)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([float(seen)] * len(parts)),
                                              pa.array(parts, pa.binary())], names=["part", "weight", "sums"])
    return run


def _add(t: pa.Table) -> pa.Table:
    total = None
    for x in t.column("sums"):
        a = np.frombuffer(x.as_buffer(), dtype=np.float64)
        total = a.copy() if total is None else total + a
    return pa.table({"part": t.column("part")[:1], "weight": [sum(t.column("weight").to_pylist())], "sums": pa.array([total.tobytes()], pa.binary())})


def _average(tasks: DataFrame) -> np.ndarray:
    """Weighted mean of the tasks' parameters, added up in two levels."""
    kind = "part int, weight double, sums binary"
    one = tasks.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(64))).groupBy("part", "salt").applyInArrow(_add, kind)
    rows = sorted(one.groupBy("part").applyInArrow(_add, kind).collect())
    return np.concatenate([np.frombuffer(r["sums"], dtype=np.float64) / r["weight"] for r in rows]).astype(np.float32)


def log_tables(p: Parameters):
    """A, B (with b) and log Z over all pairs of contexts."""
    a, b = p.c1 @ p.q.T, p.c2 @ p.q.T + p.b
    top_a, top_b = a.max(1, keepdims=True), b.max(1, keepdims=True)
    z = np.log(np.exp((a - top_a).astype(np.float64)) @ np.exp((b - top_b).astype(np.float64)).T)
    return a, b, (z + top_a + top_b.T).astype(np.float32)


def _score(flat, n, d, log_mass, own_n):
    def run(batches):
        a, b, z = log_tables(Parameters(n, d, flat.value))
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for blob in batch.column(batch.schema.get_field_index("classes")):
                w, u, v = _contexts(np.frombuffer(unpack(blob.as_buffer()), dtype=np.uint16), n)
                logs = (a[u, w] + b[v, w] - z[u, v]).astype(np.float64).sum() / np.log(10)
                rest = w[(w >= own_n) & (w < n - 1)] - own_n
                out.append(float(logs - log_mass[rest].sum()))
            names = [x for x in batch.schema.names if x != "classes"]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(x)) for x in names), pa.array(out, pa.float64())],
                                             names=[*names, "class_score"])
    return run


def score_documents(docs: DataFrame, parts: int = 5, held_part: int = 1, rounds: int = ROUNDS) -> DataFrame:
    """Unigram and model log10 probability of every whole text.

    Learns from the documents whose crc32(doc_id as text) modulo ``parts``
    isn't ``held_part`` (a null doc_id counts as empty text) and scores all.
    Returns doc_id, held_out, n_tokens (words and one end), n_known (tokens
    with a count), train_tokens, base_score, score; one row per input row.

    Null and empty texts are one end token.  Words are never cut; the model
    gives every class one unseen word, so unknown words have a finite score.
    With no training document every count is 0 and the model stays at its
    start.  Rows that repeat both doc_id and text score alike; an empty table
    gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    training = base.filter(fold_column("doc_id", parts) != held_part)
    counts = table(word_counts(training), "lm-counts")
    n_docs = training.count()
    words, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    total, types = words + n_docs, distinct + (n_docs > 0)
    log_total = float(np.log10(total + 0.5 * (types + 1)))
    end_log = float(np.log10(n_docs + 0.5))

    # the most frequent words: whole steps of the count's logarithm, as many as DIRECT_WORDS allows
    step = F.floor(F.log2("c") * 16).cast("int")
    cut, held = None, 0
    for k, words_there in sorted(counts.groupBy(step.alias("k")).agg(F.count("*")).collect(), reverse=True):
        held += words_there
        if held > DIRECT_WORDS:
            break
        cut = k
    top = sorted(counts.filter(step >= cut).collect(), key=lambda r: (-r["c"], r["word"])) if cut is not None else []
    direct = [bytes(r["word"]) for r in top]
    logs = np.log10(np.array([r["c"] for r in top], dtype=np.float64) + 0.5)
    own_n = min(OWN_CLASSES, len(direct))
    n = own_n + REST_CLASSES + 1

    # mass of every class: its words' counts plus a half each, and one unseen word
    mass = np.full(REST_CLASSES, 0.5)
    kind = F.pmod(F.crc32(F.substring("word", -SUFFIX, SUFFIX)), F.lit(REST_CLASSES))
    kind = F.when(F.octet_length("word") < SUFFIX, F.pmod(F.crc32("word"), F.lit(REST_CLASSES))).otherwise(kind)
    for k, m in counts.groupBy(kind.alias("k")).agg(F.sum(F.col("c") + F.lit(0.5)).alias("m")).collect():
        mass[k] += m
    for r in top[:own_n]:
        mass[rest_class(bytes(r["word"]), REST_CLASSES)] -= r["c"] + 0.5
    mass = np.maximum(mass, 0.5)
    prior = np.concatenate((10 ** logs[:own_n], mass, [n_docs + 0.5]))
    prior = prior / prior.sum()

    sc = spark.sparkContext
    sequences = table(base.select("doc_id", F.xxhash64("text").alias("key"), "text")
                      .mapInArrow(_sequences(sc.broadcast(direct), sc.broadcast(logs), OWN_CLASSES, REST_CLASSES), SEQUENCE), "lm-sequences")
    learn = sequences.filter(fold_column("doc_id", parts) != held_part).select("classes")
    p = Parameters(n, DIMENSIONS, prior=prior)
    for r in range(rounds if n_docs else 0):
        p = Parameters(n, DIMENSIONS, _average(learn.mapInArrow(_train(sc.broadcast(p.flat), n, DIMENSIONS, prior, r),
                                                                "part int, weight double, sums binary")))

    rare = (sequences.select("doc_id", "key", F.explode(F.arrays_zip("rare", "times")).alias("x"))
            .select("doc_id", "key", F.col("x.rare").alias("word"), F.col("x.times").alias("times"))
            .join(counts, "word", "left")
            .groupBy("doc_id", "key").agg(F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.5))).alias("rare_log"),
                                          F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("rare_known")))
    copies = sequences.groupBy("doc_id", "key").agg(F.count("*").alias("copies"))
    scored = (sequences.drop("rare", "times")
              .mapInArrow(_score(sc.broadcast(p.flat), n, DIMENSIONS, np.log10(mass), own_n),
                          "doc_id long, key long, n_words long, n_direct long, direct_log double, rest_log double, class_score double"))
    extra = copies.alias("a").join(rare.alias("b"), F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.key") == F.col("b.key")), "left").select(
        "a.doc_id", "a.key", (F.coalesce("rare_log", F.lit(0.0)) / F.col("copies")).alias("rare_log"),
        (F.coalesce("rare_known", F.lit(0)) / F.col("copies")).cast("long").alias("rare_known"))
    whole = scored.alias("s").join(extra.alias("x"), F.col("s.doc_id").eqNullSafe(F.col("x.doc_id")) & (F.col("s.key") == F.col("x.key")), "left")
    return whole.select(
        "s.doc_id", (fold_column("s.doc_id", parts) == held_part).alias("held_out"),
        (F.col("n_words") + 1).alias("n_tokens"),
        (F.col("n_direct") + F.col("rare_known") + F.lit(int(n_docs > 0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("direct_log") + F.col("rare_log") + F.lit(end_log) - (F.col("n_words") + 1) * F.lit(log_total)).alias("base_score"),
        (F.col("class_score") + F.col("rest_log") + F.col("rare_log")).alias("score"))


def op10_lm_scoring(spark, sf_dir: str) -> DataFrame:
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), parts=5, held_part=1)
