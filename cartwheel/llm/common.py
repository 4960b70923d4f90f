"""Helpers shared by the training-data operators: tables in shared storage,
vectorised word hashing and connected components."""

from __future__ import annotations

import ctypes
import functools
import hashlib
import os
import tempfile
import zipfile
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.session import scratch_path

#: Bytes that separate words: space and tab to carriage return.
SEPARATORS = np.zeros(256, dtype=bool)
SEPARATORS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: A longer word is hashed by blake2b instead of the vectorised polynomial.
LONG_WORD = 1 << 16
#: Bytes (or words) hashed at a time, which bounds the helper arrays.
CHUNK = 1 << 16

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def ship(spark) -> None:
    """Send this package to the executors (once per application), so that
    tasks can import it wherever the driver was started from."""
    sc = spark.sparkContext
    if getattr(sc, "_cartwheel_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="cartwheel-"), "cartwheel_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    sc._cartwheel_shipped = True


def give_back() -> None:
    """Freed memory goes back to the system, so that reused workers don't hold
    what an earlier task needed."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def tidy(run):
    """Wraps a task's generator, which gives memory back when it ends."""
    @functools.wraps(run)
    def wrapped(batches):
        yield from run(batches)
        give_back()
    return wrapped


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: the
    lineage is cut and a lost executor costs only its own tasks."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.table_path = path
    return out


def drop_tables(*tables: DataFrame) -> None:
    """Delete tables of :func:`table` that no later plan reads, so that an
    operator's steps don't hold disk until the application ends."""
    for df in tables:
        jvm = df.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.table_path)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def text_column(name: str = "text"):
    """The text, with null read as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def fold(doc_id: int, parts: int = 5) -> int:
    """crc32 of the id as text, modulo ``parts``; a null id counts as ''."""
    return zlib.crc32(str(doc_id).encode() if doc_id is not None else b"") % parts


def fold_column(name: str = "doc_id", parts: int = 5):
    return F.pmod(F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the whole 64-bit word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64 for i < n (n <= 2 * CHUNK)."""
    key = int(base)
    have = _POWERS.get(key)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        inverse = np.uint64(pow(key, -1, 1 << 64))
        out = []
        for b in (base, inverse):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        have = _POWERS[key] = (out[0], out[1])
    return have


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash, start and end byte of every maximal run of
    non-separator bytes.  Polynomial prefix sums give every word's hash
    without a Python object per word."""
    buf = np.frombuffer(raw, dtype=np.uint8)
    sep = SEPARATORS[buf]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], sep, [True])).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    n = len(starts)
    out = np.empty(n, dtype=np.uint64)
    length = ends - starts
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + CHUNK, side="right")))
        if j == i + 1 and length[i] > LONG_WORD:
            i = j
            continue
        at = starts[i]
        part = buf[at:ends[j - 1]]
        p, q = _powers(BASES[0], max(len(part) + 1, 2))
        sums = np.empty(len(part) + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(_BYTE[part] * p[:len(part)], out=sums[1:])
        s, e = starts[i:j] - at, ends[i:j] - at
        out[i:j] = (sums[e] - sums[s]) * q[s]
        i = j
    out = mix(out + length.astype(np.uint64))
    for i in np.flatnonzero(length > LONG_WORD):
        out[i] = int.from_bytes(hashlib.blake2b(raw[starts[i]:ends[i]], digest_size=8).digest(), "little")
    return out, starts, ends


def span_hashes(h: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64) -> np.ndarray:
    """Rabin-Karp hash of every span ``h[start:end]`` (starts ascending, spans
    short against CHUNK): two prefix-sum look-ups per span."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        at = int(starts[i])
        j = int(np.searchsorted(starts, at + CHUNK, side="left"))
        part = h[at:int(ends[i:j].max())]
        p, q = _powers(base, max(len(part) + 1, 2))
        sums = np.empty(len(part) + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(part * p[:len(part)], out=sums[1:])
        s, e = starts[i:j] - at, ends[i:j] - at
        out[i:j] = (sums[e] - sums[s]) * q[s]
        i = j
    return mix(out + (ends - starts).astype(np.uint64))


def window_hashes(h: np.ndarray, k: int, base: np.uint64) -> np.ndarray:
    """Hash of every ``k`` consecutive values."""
    s = np.arange(max(0, len(h) - k + 1))
    return span_hashes(h, s, s + k, base)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values, by doubling."""
    have, size = x, 1
    while size * 2 <= w:
        have = np.minimum(have[:-size], have[size:])
        size *= 2
    return have if size == w else np.minimum(have[:len(x) - w + 1], have[w - size:])


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest node reachable from every node of the undirected ``edges``
    (a, b): columns node, component.

    Alternating large-star and small-star rounds (Kiveris et al., 2014): each
    node hooks its neighbours to the smallest one, so the edge set shrinks to
    stars in O(log n) rounds.  Minima are hash aggregates with map-side
    combine and the hooks are joins, which AQE can split for a hot node; every
    round is cut by a table in shared storage.
    """
    def both(e):
        return e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def large_star(e):
        d = both(e)
        low = d.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        return d.join(low, "a").filter("b > a").select(F.col("b").alias("x"), F.col("m").alias("y"))

    def small_star(e):
        d = e.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).filter("a <> b")
        low = d.groupBy("a").agg(F.min("b").alias("m"))
        hooked = d.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        return hooked.unionByName(low.select("a", F.col("m").alias("b"))).distinct()

    e = table(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        e = table(small_star(large_star(e)), "edges")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
