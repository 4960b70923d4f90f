"""Jaccard similarity join on word n-grams, by size-banded tiles.

Every document becomes a sorted array of hashed shingles.  Sizes are cut into
bands; in a band the hash range is cut into one more slice than two sets of
that band can differ by, so a linked pair agrees on at least one whole slice.
Documents that share a slice (a *tile*) are candidates, and tiles are swept
without listing all their pairs:

1. copies of one set are a single class; only its first document is compared;
2. each tile compares its members with its first one (a star).  Hashed bitmap
   signatures, as long as the set asks for, bound the overlap from above by
   bit counts; pairs that pass are settled by exact intersection of the
   sorted arrays;
3. tiles whose other members aren't all in one component yet are compared
   exhaustively in blocks of bounded size, of tiles with the same members one
   only; pairs of different components that pass the size and bit bounds
   leave a block.  A block with many such pairs first sends the most alike
   ones that would join its members (a forest, less pairs than members); its
   tile is compared again with the components these make.

No link between different components can be missed: two linked documents
share a tile, and in it they are compared unless already connected.  Empty
slices make no tile: a set with more slices that hold something than two
linked sets can differ by agrees on one of those.  Only sets that are too
thin for that (few, as there are spare slices) also meet in empty ones.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import BASES, components, drop_tables, mix, ship, table, text_column, tidy, word_hashes

#: Words of a shingle, unless a caller asks for others; links need
#: 100 * intersection >= PERCENT * union.
WORDS, PERCENT = 3, 90
#: Upper ends of the size bands grow by this factor; bits of a bitmap for each
#: shingle, at least; members of one block of a tile.
BAND, BITS, BLOCK = 1.5, 2, 1024
#: Open tiles that a document's rows list, so that a pair leaves the first one
#: it shares only; the pairs of a document in more may leave several.
LISTED = 4096
#: Pairs for each member of a block, beyond which a forest of them is tried first.
DENSE = 4
#: Bits of the filter before a join, and of one of Spark's bitmaps.
FILTER_BITS, PAGE_BITS = 1 << 26, 1 << 15


def _edges(limit: int) -> np.ndarray:
    out = [1]
    while out[-1] <= limit:
        out.append(max(out[-1] + 1, int(out[-1] * BAND)))
    return np.array(out, dtype=np.int64)


def shingles(text: str, size: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams; a shorter text's
    whole sequence is one; no words, none."""
    h, _, _ = word_hashes(text.encode().lower())
    if not len(h):
        return h
    k = min(size, len(h))
    out = np.full(len(h) - k + 1, k, dtype=np.uint64)
    for j in range(k):
        out = out * BASES[1] + mix(h[j:len(h) - k + 1 + j] + BASES[j % 3])
    return np.unique(mix(out))


def _slices(s: np.ndarray, edges: np.ndarray, percent: int) -> list[np.ndarray]:
    """Hashes of the set's slices that make tiles, for its own band and, if a
    linked set may lie there, the next one."""
    n, out = len(s), []
    band = int(np.searchsorted(edges, n, side="right")) - 1
    spread = mix(s)
    for k in (band, band + 1):
        if k > band and 100 * n < percent * edges[k]:
            break
        top = int(edges[k + 1]) - 1
        # |x ^ y| <= (|x| + |y|) (100 - percent) / (100 + percent) for linked sets
        differ = 2 * top * (100 - percent) // (100 + percent)
        # spare slices for those that chance leaves empty
        empty = (differ + 1) * float(np.exp(-edges[k] / (differ + 1)))
        m = differ + 2 + int(2 * empty + 6 * empty ** 0.5)
        at = np.searchsorted(s, np.array([(i << 64) // m for i in range(m)], dtype=np.uint64))
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(spread)))
        size = np.diff(np.append(at, n))
        slices = mix(total[at + size] - total[at] + mix((size.astype(np.uint64) << np.uint64(40)) + np.arange(m, dtype=np.uint64) * BASES[2]
                                                        + np.uint64(k * int(BASES[0]) % (1 << 64))))
        out.append(slices[size > 0] if (size > 0).sum() > differ else slices)
    return out


def bitmap(s: np.ndarray) -> np.ndarray:
    """Hashed bits of a set, in a power of two of 64-bit words: at least BITS
    a shingle.  The bitmap of half the length is that of both halves joined."""
    words = 1 << max(0, (BITS * len(s) - 1) // 64).bit_length()
    bits = np.zeros(64 * words, dtype=np.uint8)
    # words are cut from the low end, so that halves fold onto each other
    bits[(s % np.uint64(64 * words)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64)


def _signatures(size, percent):
    @tidy
    def run(batches):
        edges = _edges(1 << 40)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                rows = []
                for doc_id, text in zip(part.column(0), part.column(1)):
                    s = shingles(text.as_py(), size)
                    if not len(s):
                        rows.append((doc_id.as_py(), 0, 0, 0, [], []))
                        continue
                    rows.append((doc_id.as_py(), len(s), *(np.array([mix(s).sum(), mix(s ^ BASES[0]).sum()], dtype=np.uint64).view(np.int64).tolist()),
                                 bitmap(s), np.concatenate(_slices(s, edges, percent)).view(np.int64)))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                 names=["doc_id", "n", "h1", "h2", "bits", "slices"])
    return run


def _intersections(size, percent):
    """Exact check of the pairs (a, b, text of a, text of b)."""
    @tidy
    def run(batches):
        for batch in batches:
            linked, last, x = [], None, None
            for a, b in zip(batch.column(2), batch.column(3)):
                a = a.as_py()
                if a != last:
                    last, x = a, shingles(a, size)
                y = shingles(b.as_py(), size)
                if not len(x) or not len(y):
                    linked.append(False)
                    continue
                at = np.minimum(np.searchsorted(x, y), len(x) - 1)
                both = int((x[at] == y).sum())
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])
    return run


def _only_near(rows: DataFrame, wanted: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows whose ``key`` may stand in ``wanted``: a bitmap of FILTER_BITS
    hashed keys (of that size whatever the data) keeps most others out of the
    shuffle; the join that follows decides."""
    slot = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))
    pages = wanted.select((slot + 1).alias("s")).groupBy((F.bitmap_bucket_number("s") - 1).alias("page")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("bits")).collect()
    bitmap = np.zeros((FILTER_BITS // PAGE_BITS, PAGE_BITS // 8), dtype=np.uint8)
    for r in pages:
        bitmap[r["page"]] = np.frombuffer(r["bits"], dtype=np.uint8)
    shared = rows.sparkSession.sparkContext.broadcast(bitmap.reshape(-1))

    @F.pandas_udf("boolean")
    def held(s: pd.Series) -> pd.Series:
        at = s.to_numpy()
        return pd.Series((shared.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1)

    return rows.filter(held(slot))


def _fold(bits: np.ndarray) -> np.ndarray:
    half = bits.shape[1] // 2
    return bits[:, :half] | bits[:, half:]


def _forest(a, b, differ, comp_a, comp_b) -> list[int]:
    """Places of the pairs that join components, smallest difference first."""
    root: dict[int, int] = {}

    def find(x):
        while x in root:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    out = []
    for at in np.lexsort((b, a, differ)).tolist():
        x, y = find(int(comp_a[at])), find(int(comp_b[at]))
        if x != y:
            root[x] = y
            out.append(at)
    return out


def _tile_pairs(percent, dense=None):
    """Pairs of one block (sorted rows of one tile and block pair) that the
    sizes and bit counts allow and no component joins yet, unless both
    documents list an earlier tile.  Of a block with more than ``dense`` pairs
    a member, a forest only, and the tile (in ``again``)."""
    @tidy
    def run(batches):
        def pairs(tile, rows):
            early: list = [None] * len(rows)

            def earlier(i):
                if early[i] is None:
                    tiles = rows[i][5]
                    early[i] = frozenset(tiles[tiles < tile].tolist())
                return early[i]

            rows.sort(key=lambda r: r[1])
            doc, n, comp, block = (np.array(c) for c in list(zip(*rows))[:4])
            two = block.min() != block.max()
            # rows of one bitmap length are neighbours; linked sets differ by one doubling at most
            words = np.array([len(r[4]) for r in rows])
            maps = {w: np.stack([r[4] for r in rows if len(r[4]) == w]).view(np.uint64) for w in np.unique(words).tolist()}
            folded = {w: _fold(maps[2 * w]) for w in maps if 2 * w in maps}
            begin = {w: int(np.searchsorted(words, w)) for w in maps}
            a, b, apart, comps = [], [], [], ([], [])
            for i in range(len(doc) - 1):
                w = int(words[i])
                middle = int(np.searchsorted(words, w, side="right"))
                j = int(np.searchsorted(n, n[i] * 100 // percent, side="right"))
                own = maps[w][i - begin[w]]
                for start, end, others in ((i + 1, min(j, middle), maps[w][i + 1 - begin[w]:]), (middle, j, folded.get(w))):
                    at = np.arange(start, end)
                    if not len(at):
                        continue
                    keep = comp[at] != comp[i]
                    if two:
                        keep &= block[at] != block[i]
                    at = at[keep]
                    differ = np.bitwise_count(others[at - start] ^ own).sum(1, dtype=np.int64)
                    near = differ * (100 + percent) <= (100 - percent) * (n[at] + n[i])
                    at, differ = at[near], differ[near]
                    if len(at):
                        new = np.array([earlier(i).isdisjoint(earlier(j)) for j in at.tolist()])
                        at, differ = at[new], differ[new]
                    a.append(np.minimum(doc[at], doc[i]))
                    b.append(np.maximum(doc[at], doc[i]))
                    apart.append(differ / (n[at] + n[i]))
                    comps[0].append(np.full(len(at), comp[i]))
                    comps[1].append(comp[at])
            if not a:
                return (np.zeros(0, np.int64),) * 2
            a, b = np.concatenate(a), np.concatenate(b)
            if dense is None or len(a) <= dense * len(doc):
                return a, b
            again.append(tile)
            chosen = _forest(a, b, np.concatenate(apart), *(np.concatenate(c) for c in comps))
            return a[chosen], b[chosen]

        key, rows, out, again = None, [], [], []
        width = 2 if dense is None else 3
        names = ["a", "b", "again"][:width]

        def batch_of(found):
            a, b = (pa.array(np.concatenate([x[i] for x in found])) for i in (0, 1))
            return pa.RecordBatch.from_arrays([a, b, pa.nulls(len(a), pa.int64())][:width], names=names)

        for batch in batches:
            sigs, firsts, seconds, docs, sizes, comps, blocks = (batch.column(k).to_pylist() for k in range(7))
            (cut, flat), (ends, tiles) = ((c.offsets.to_numpy(), c.values.to_numpy()) for c in (batch.column(7), batch.column(8)))
            for at, (sig, i, j, doc, n, comp, block) in enumerate(zip(sigs, firsts, seconds, docs, sizes, comps, blocks)):
                if (sig, i, j) != key:
                    if len(rows) > 1:
                        out.append(pairs(key[0], rows))
                        if sum(len(x[0]) for x in out) > 100_000:
                            yield batch_of(out)
                            out = []
                    key, rows = (sig, i, j), []
                rows.append((doc, n, comp, block, flat[cut[at]:cut[at + 1]], tiles[ends[at]:ends[at + 1]]))
        if len(rows) > 1:
            out.append(pairs(key[0], rows))
        if out:
            yield batch_of(out)
        if again:
            none = pa.nulls(len(again), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, pa.array(again, pa.int64())], names=names)
    return run


def links(docs: DataFrame, size: int = WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(signatures, components): n and class hashes of every row, and the
    component of every class that has a link."""
    if percent < 50:
        raise ValueError("percent has to be 50 or more: linked sets differ in size by one doubling at most")
    ship(docs.sparkSession)
    base = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    signed = table(base.mapInArrow(_signatures(size, percent), "doc_id long, n long, h1 long, h2 long, bits array<long>, slices array<long>"), "signatures")
    classes = signed.filter("n > 0").groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("doc_id"))
    narrow = table(signed.select("doc_id", "n", "h1", "h2", "bits").join(classes, ["doc_id", "n", "h1", "h2"], "left_semi")
                   .select("doc_id", "n", "bits"), "classes")
    sizes = table(signed.select("doc_id", "n", "h1", "h2"), "sizes")

    sliced = signed.select("doc_id", F.explode("slices").alias("slice"))
    shared = table(sliced.groupBy("slice").agg(F.count("*").alias("rows")).filter("rows > 1").select("slice"), "shared")
    # a table first: else the documents' whole slice arrays would meet the class rows
    held = table(_only_near(sliced, shared, "slice").join(shared, "slice"), "met")
    drop_tables(signed, shared)
    met = held.join(narrow.select("doc_id"), "doc_id", "left_semi").distinct()
    first = met.groupBy("slice").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi").select("slice", "lo")
    members = table(met.join(first, "slice"), "tiles")
    drop_tables(held)

    def folded(name, other):  # the longer bitmap to the length of the shorter
        half = f"size({other})"
        return f"if(size({name}) > {half}, zip_with(slice({name}, 1, {half}), slice({name}, {half} + 1, {half}), (x, y) -> x | y), {name})"

    allowed = (f"case when least(na, nb) * 100 < {percent} * greatest(na, nb) then false else {100 + percent} * aggregate("
               f"zip_with({folded('bits_a', 'bits_b')}, {folded('bits_b', 'bits_a')}, (x, y) -> bit_count(x ^ y)), 0L, (s, x) -> s + x)"
               f" <= {100 - percent} * (na + nb) end")

    def bounded(pairs):
        a = narrow.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("bits").alias("bits_a"))
        b = narrow.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bits_b"))
        return pairs.join(b, "b").join(a, "a").filter(allowed).select("a", "b").distinct()

    def exact(pairs):
        pairs = table(pairs, "pairs")
        wanted = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id")))
        near = _only_near(base, wanted)
        both = (pairs.join(near.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
                .join(near.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a"))
        return table(both.select("a", "b", "text_a", "text_b").mapInArrow(_intersections(size, percent), "a long, b long, linked boolean")
                     .filter("linked").select("a", "b"), "links")

    star = exact(bounded(members.filter("doc_id <> lo").select(F.col("lo").alias("a"), F.col("doc_id").alias("b")).distinct()))
    found = components(star)

    placed = members.join(found.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left").select(
        "slice", "doc_id", "lo", F.coalesce("component", "doc_id").alias("comp"))
    # the pairs with the tile's first member are settled: what is open lies between the others
    # of tiles with the same members (by count and two 64-bit hashes of the set) one is compared
    open_tiles = (placed.filter("doc_id <> lo").groupBy("slice")
                  .agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count("*").alias("members"),
                       F.bit_xor(F.xxhash64("doc_id")).alias("set1"), F.bit_xor(F.xxhash64(F.lit(1), "doc_id")).alias("set2")).filter("x < y")
                  .groupBy("members", "set1", "set2").agg(F.min("slice").alias("slice")))
    blocks = F.ceil(F.col("members") / F.lit(BLOCK)).cast("int")
    inside = table(placed.filter("doc_id <> lo").join(open_tiles.select("slice", blocks.alias("blocks")), "slice")
                   .select("slice", "doc_id", "comp", "blocks"), "open-tiles")
    listed = inside.groupBy("doc_id").agg(F.collect_list("slice").alias("listed")).withColumn(
        "listed", F.when(F.size("listed") <= LISTED, F.col("listed")).otherwise(F.array().cast("array<long>")))
    def compared(inside, dense=None):
        tiled = (inside.join(listed, "doc_id").withColumn("listed", F.expr("filter(listed, x -> x < slice)"))
                 .withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                 .join(narrow, "doc_id")
                 .select("slice", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "doc_id", "n", "comp", "block", "bits", "listed"))
        return (tiled.repartition("slice", "i", "j").sortWithinPartitions("slice", "i", "j")
                .mapInArrow(_tile_pairs(percent, dense), "a long, b long" + (", again long" if dense else "")).distinct())

    tried = table(compared(inside, DENSE), "tried")
    joined = star.unionByName(exact(tried.filter("again is null").select("a", "b")))
    found = components(joined)
    dense = tried.filter("again is not null").select(F.col("again").alias("slice"))
    if dense.isEmpty():
        return sizes, found
    # pairs that a forest stood for, between components that are still apart
    left = (inside.join(dense, "slice").join(found.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
            .select("slice", "doc_id", F.coalesce("component", "doc_id").alias("comp"), "blocks"))
    return sizes, components(joined.unionByName(exact(compared(left).select("a", "b"))))


def near_duplicates(docs: DataFrame, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles (distinct word n-grams of ``size`` words) and
    component_id (smallest doc_id reachable by links, Jaccard similarity of
    ``percent`` or more) of every row.

    Words are runs of bytes other than space and tab to carriage return, with
    A-Z lower-cased.  Null and empty texts have an empty set and no link.  A
    row with a null doc_id is returned unlinked, with a null component_id.
    Copies are one class; rows that repeat a doc_id with other texts count as
    one document, linked if any of them is.  An empty table gives no rows;
    other columns are ignored.
    """
    signed, found = links(docs, size, percent)
    rep = signed.filter("n > 0").groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("rep"))
    joined = (signed.join(rep, ["n", "h1", "h2"], "left")
              .join(found.select(F.col("node").alias("rep"), "component"), "rep", "left")
              .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep", "doc_id").alias("component_id")))
    unknown = (docs.filter("doc_id is null").select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
               .mapInArrow(_signatures(size, percent), "doc_id long, n long, h1 long, h2 long, bits array<long>, slices array<long>")
               .select("doc_id", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id")))
    return joined.unionByName(unknown)


def op8_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
