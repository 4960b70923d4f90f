"""Vector code compression: product codes whose nearest codebook entries are
found in a GNAT (geometric near-neighbour access tree) over the entries.

Vectors become integers and are cut into consecutive parts; every part
position has a codebook.  A node of its GNAT holds a few entries as split
points and deals the others to the nearest one.  For every pair of split
points it stores the range of distances from the first to the second and all
that lies below it.  A query that knows its distance to a split point drops
every subtree whose range lies outside its distance plus or minus the best so
far: strictly, with square roots rounded away from a wrong drop, so that an
entry as near as the best is never lost.  Squared distances are integers, and
ties are settled on them, to the lower index.

Vectors are only read, once a round: each task sends sums per part, entry and
component, which Spark adds up, and the codebooks are a few kilobytes.
"""

from __future__ import annotations

import functools
import hashlib
import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import ship, table, tidy

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Split points of a node, entries of a leaf, and vectors compared at a time.
SPLITS, LEAF, HELD = 4, 4, 1 << 14
#: Components below this bound have squared distances within 64 bits; others
#: are compared as Python integers.
SMALL = 1 << 22
#: Sums are sent in limbs of so many bits.
LIMB = 40


def _roots(square: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the square roots of 64-bit integers."""
    root = np.sqrt(square.astype(np.float64))
    return np.maximum(root * (1 - 1e-14), 0), root * (1 + 1e-14)


def _squares(x: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of ``x`` from one entry, as integers."""
    d = x - entry
    return np.einsum("ij,ij->i", d, d) if d.dtype == np.int64 else (d * d).sum(axis=1)


class Gnat:
    """Tree over the rows ``indices`` of ``entries`` (64-bit integers)."""

    def __init__(self, entries: np.ndarray, indices=None):
        self.entries = entries
        indices = np.arange(len(entries)) if indices is None else np.asarray(indices)
        self.leaf = indices if len(indices) <= LEAF else None
        if self.leaf is not None:
            return
        # split points lie far apart: each is the entry farthest from those chosen
        splits = [int(indices[0])]
        near = _squares(entries[indices], entries[splits[0]])
        while len(splits) < SPLITS:
            splits.append(int(indices[int(near.argmax())]))
            near = np.minimum(near, _squares(entries[indices], entries[splits[-1]]))
        # equal entries may be chosen twice
        self.splits = splits = list(dict.fromkeys(splits))
        rest = indices[~np.isin(indices, splits)]
        apart = np.stack([_squares(entries[rest], entries[s]) for s in splits])
        owner = apart.argmin(axis=0)
        below = [rest[owner == j] for j in range(len(splits))]
        self.low, self.high = np.empty((len(splits),) * 2), np.empty((len(splits),) * 2)
        for i, s in enumerate(splits):
            for j, child in enumerate(below):
                low, high = _roots(_squares(entries[np.append(child, splits[j])], entries[s]))
                self.low[i, j], self.high[i, j] = low.min(), high.max()
        self.children = [Gnat(entries, c) if len(c) else None for c in below]

    def search(self, x: np.ndarray, rows: np.ndarray, best: np.ndarray, code: np.ndarray) -> int:
        """Lowers ``best`` (squared distances) and ``code`` of ``rows`` of
        ``x`` by the entries below this node; the number of distances taken."""
        taken = 0
        if self.leaf is not None:
            for k in self.leaf:
                taken += self._compare(x, rows, best, code, int(k))[1]
            return taken
        alive = np.ones((len(rows), len(self.splits)), dtype=bool)
        for i, s in enumerate(self.splits):
            at = np.flatnonzero(alive[:, i])
            if not len(at):
                continue
            square, n = self._compare(x, rows[at], best, code, s)
            taken += n
            (low, high), (_, reach) = _roots(square), _roots(best[rows[at]])
            # outside [distance - reach, distance + reach], strictly
            alive[at] &= ~((low[:, None] > self.high[i] + reach[:, None]) | (high[:, None] + reach[:, None] < self.low[i]))
        for j, child in enumerate(self.children):
            if child is not None and alive[:, j].any():
                taken += child.search(x, rows[alive[:, j]], best, code)
        return taken

    def _compare(self, x, rows, best, code, k):
        square = _squares(x[rows], self.entries[k])
        better = (square < best[rows]) | ((square == best[rows]) & (k < code[rows]))
        best[rows[better]], code[rows[better]] = square[better], k
        return square, len(rows)


def nearest(x: np.ndarray, entries: np.ndarray, tree: Gnat | None) -> tuple[np.ndarray, np.ndarray]:
    """Index of, and squared distance from, the nearest entry of every row;
    without a tree (integers past 64 bits) entry after entry."""
    if tree is not None:
        code = np.full(len(x), len(entries), dtype=np.int64)
        best = np.full(len(x), np.iinfo(np.int64).max)
        tree.search(x, np.arange(len(x)), best, code)
        return code, best
    squares = np.stack([_squares(x, e) for e in entries])
    code = np.array([min(range(len(entries)), key=lambda k: c[k]) for c in squares.T], dtype=np.int64)
    return code, squares[code, np.arange(len(x))]


def integers(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x), exactly: 64-bit integers where all are small."""
    values = np.asarray(values, dtype=np.float64)
    if not len(values) or np.abs(values).max() < SMALL / scale:
        return np.floor(values * scale).astype(np.int64)
    return np.array([math.floor(Fraction(v) * scale) for v in values], dtype=object)


def _cuts(dim: int, parts: int) -> np.ndarray:
    """Ends of the parts: equal ones, or the first ones longer by one."""
    return np.array([sum(dim // parts + (p < dim % parts) for p in range(k)) for k in range(parts + 1)])


class Codebooks:
    def __init__(self, dim: int, entries: list[np.ndarray], scale: int):
        """``entries`` of every part position: rows of integers."""
        self.dim, self.scale, self.parts = dim, scale, len(entries)
        self.cuts = _cuts(dim, self.parts)
        self.entries = [np.array(e, dtype=object) for e in entries]
        self.small = all(abs(v) < SMALL for e in self.entries for v in e.ravel())
        self.fast = [e.astype(np.int64) for e in self.entries] if self.small else []

    @functools.cached_property
    def trees(self) -> list[Gnat]:
        return [Gnat(e) for e in self.fast]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (rows x parts) and summed squared distances."""
        codes, error = np.zeros((len(x), self.parts), dtype=np.int64), np.zeros(len(x), dtype=object if x.dtype == object else x.dtype)
        fast = self.small and x.dtype == np.int64
        if not fast:
            x, error = x.astype(object), error.astype(object)
        for p in range(self.parts):
            part = np.ascontiguousarray(x[:, self.cuts[p]:self.cuts[p + 1]])
            codes[:, p], square = nearest(part, self.fast[p] if fast else self.entries[p], self.trees[p] if fast else None)
            error = error + square
        return codes, error

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(v) for e in self.entries for v in e.ravel()).encode()).hexdigest()


def _blocks(batch: pa.RecordBatch, column: int, dim: int, scale: int):
    """(first row, integer matrix) of blocks of a batch."""
    flat = batch.column(column).flatten().to_numpy(zero_copy_only=False)
    for at in range(0, batch.num_rows, HELD):
        n = min(HELD, batch.num_rows - at)
        yield at, integers(flat[at * dim:(at + n) * dim], scale).reshape(n, dim)


def _sums(books):
    @tidy
    def run(batches):
        total = [[[0] * (int(b) - int(a) + 1) for _ in range(len(e))] for a, b, e in zip(books.cuts, books.cuts[1:], books.entries)]
        for batch in batches:
            for _, x in _blocks(batch, 0, books.dim, books.scale):
                codes, _ = books.encode(x)
                for p in range(books.parts):
                    part = x[:, books.cuts[p]:books.cuts[p + 1]]
                    for k in np.unique(codes[:, p]):
                        mine = part[codes[:, p] == k]
                        own = total[p][k]
                        own[0] += len(mine)
                        for j, s in enumerate(mine.sum(axis=0).tolist()):
                            own[1 + j] += s
        rows = []
        for p, part in enumerate(total):
            for k, own in enumerate(part):
                for j, s in enumerate(own if own[0] else ()):
                    sign, s, limb = (-1 if s < 0 else 1), abs(s), 0
                    while s or not limb:
                        rows.append((p, k, j, limb, sign * (s & ((1 << LIMB) - 1))))
                        s, limb = s >> LIMB, limb + 1
        names = ["part", "entry", "place", "limb", "s"]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int32() if i < 4 else pa.int64()) for i in range(5)], names=names)
    return run


def _encoded(books):
    @tidy
    def run(batches):
        for batch in batches:
            codes, errors = [], []
            for _, x in _blocks(batch, 2, books.dim, books.scale):
                code, error = books.encode(x)
                codes += ["".join("%02x" % c for c in row) for row in code.tolist()]
                errors += [int(e) if e < 1 << 63 else None for e in error]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes, pa.string()), pa.array(errors, pa.int64())],
                                             names=["vec_id", "label", "code", "error"])
    return run


def _kept(vectors: DataFrame) -> DataFrame:
    """Rows that take part: vec_id, label, vec."""
    vec = F.col("embedding").cast("array<double>")
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int").alias("label")
    return vectors.filter(F.col("embedding").isNotNull() & ~bad).select(F.col("vec_id").cast("long").alias("vec_id"), label, vec.alias("vec"))


def learn(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks | None:
    """Codebooks after ``rounds`` rounds over all kept vectors; None where no
    vector takes part."""
    ship(vectors.sparkSession)
    kept = _kept(vectors)
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vec").limit(entries).collect()
    if not first:
        return None
    dim = len(first[0]["vec"])
    first = [integers(r["vec"], scale) for r in first if len(r["vec"]) == dim]
    cuts = _cuts(dim, parts)
    books = Codebooks(dim, [[v[cuts[p]:cuts[p + 1]] for v in first] for p in range(parts)], scale)
    same = kept.filter(F.size("vec") == dim).select("vec")
    for _ in range(rounds):
        found = (same.mapInArrow(_sums(books), "part int, entry int, place int, limb int, s long")
                 .groupBy("part", "entry", "place", "limb").agg(F.sum("s").alias("s")).collect())
        sums: dict[tuple[int, int], dict[int, int]] = {}
        for r in found:
            own = sums.setdefault((r["part"], r["entry"]), {})
            own[r["place"]] = own.get(r["place"], 0) + (r["s"] << (LIMB * r["limb"]))
        grown = [e.copy() for e in books.entries]
        for (p, k), own in sums.items():
            for j in range(grown[p].shape[1]):
                grown[p][k, j] = own[j + 1] // own[0]
        books = Codebooks(dim, grown, scale)
    return books


def encode(vectors: DataFrame, books: Codebooks | None) -> DataFrame:
    """vec_id, label, code (two hex digits a part) and error (summed squared
    distance) of every kept vector.

    Vectors that are null or hold null or non-finite components take no part,
    nor do vectors of another length than that of the smallest kept vec_id.
    Any finite component is exact; an error past 64 bits is null.  Null and
    repeated vec_ids and null labels are kept, tied distances go to the lower
    index, fewer vectors than entries make smaller codebooks (equal ones equal
    entries, of which the first is used), a dimension that the parts don't
    divide makes the first parts longer by one, an empty table gives no rows,
    and other columns are ignored.
    """
    ship(vectors.sparkSession)
    kept = _kept(vectors)
    kind = f"vec_id long, label {kept.schema['label'].dataType.simpleString()}, code string, error long"
    if books is None:
        return vectors.sparkSession.createDataFrame([], kind)
    return kept.filter(F.size("vec") == books.dim).mapInArrow(_encoded(books), kind)


def decode(codes: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id and the entries' components divided by the scale."""
    book = F.array(*[F.array(*[F.array(*[F.lit(float(Fraction(int(v), books.scale))) for v in e]) for e in part]) for part in books.entries])
    parts = [F.element_at(F.element_at(book, p + 1), (F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int") + 1)) for p in range(books.parts)]
    return codes.select("vec_id", F.concat(*parts).alias("vec"))


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """``encode`` with learnt codebooks, and label_error (error summed over
    equal labels, nulls together) and codebooks_sha256."""
    books = learn(vectors, parts, entries, rounds, scale)
    coded = encode(vectors, books)
    if books is None:
        return coded.withColumns({"label_error": F.lit(None).cast("long"), "codebooks_sha256": F.lit(None).cast("string")})
    coded = table(coded, "vector-codes")
    by_label = coded.groupBy(F.col("label").alias("l")).agg(F.expr("try_sum(error)").alias("label_error"))
    return (coded.join(by_label, coded["label"].eqNullSafe(by_label["l"])).drop("l")
            .withColumn("codebooks_sha256", F.lit(books.digest())))


def op11_vector_codes(spark, sf_dir: str) -> DataFrame:
    return compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).select("vec_id", "code", "error", "label_error", "codebooks_sha256", "label")
