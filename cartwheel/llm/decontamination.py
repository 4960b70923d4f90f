"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman.

Grams of the items that the corpus holds at all are found with a bitmap of
fixed size in one pass over the documents, and their document frequencies are
counted.  The rarest grams of every short window of an item are its seeds;
grams that many items share (a common question head) seed nothing as long as
the item has others.  Seeds join texts to items, and the stretches around the
seeds of a (document, item) pair are aligned word by word, which scores edited
and paraphrased copies.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import BASES, ship, table, text_column, tidy, window_hashes, word_hashes

GRAM = 4
MATCH, MISMATCH, GAP = 2, -1, -1
SIMILARITY = 0.4
#: A gram is a seed if, in one of the windows of WINDOW grams that hold it, none
#: is more than CLOSE times rarer.  With more than SHARED item texts holding it,
#: it is one only for items that have no other gram.
WINDOW, CLOSE, SHARED = 4, 16, 16
#: Bits of the bitmaps of item grams and wanted texts (8 MB); false positives
#: only cost rows.
MASK_BITS = 1 << 26
#: Cells of the alignment matrices held at a time, and words of stretches that
#: a task gathers before it aligns them.
CELLS, HELD_WORDS = 500_000, 2_000_000

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def hashes_of(text: str) -> np.ndarray:
    """64-bit hash of every word."""
    return word_hashes(" ".join(words_of(text)).encode())[0]


def gram_keys(words: np.ndarray) -> np.ndarray:
    """64-bit key of the GRAM words from each position on; a shorter text is
    one gram as a whole."""
    return window_hashes(words, min(GRAM, len(words)), BASES[0]) if len(words) else np.zeros(0, dtype=np.uint64)


@tidy
def _item_grams(batches):
    for batch in batches:
        rows = [(item.as_py(), gram_keys(hashes_of(text.as_py()))) for item, text in zip(batch.column(0), batch.column(1))]
        n = [len(keys) for _, keys in rows]
        keys = np.concatenate([keys for _, keys in rows]) if rows else np.zeros(0, dtype=np.uint64)
        at = np.concatenate([np.arange(k) for k in n]) if rows else np.zeros(0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.array([item for item, _ in rows], dtype=np.int64), n)), pa.array(at, pa.int32()), pa.array(keys.view(np.int64))],
            names=["item", "at", "gram"])


def _mask(keys: DataFrame) -> np.ndarray:
    """Bitmap of MASK_BITS bits with two of them set for every 64-bit key, the
    only column."""
    key = keys.columns[0]
    places = keys.select(F.explode(F.array(key, F.shiftrightunsigned(key, 32))).alias("x")).select(
        (F.col("x").bitwiseAND(F.lit(MASK_BITS - 1)) + 1).alias("place"))
    out = np.zeros(MASK_BITS // 8, dtype=np.uint8)
    pages = places.groupBy(F.bitmap_bucket_number("place").alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    for page, bits in pages.collect():  # at most MASK_BITS / 32768 rows of 4 KB
        part = np.frombuffer(bits, dtype=np.uint8)
        out[(page - 1) * 4096:(page - 1) * 4096 + len(part)] = part
    return out


def _in_mask(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    def has(x):
        x = x & np.uint64(MASK_BITS - 1)
        return (bits[x >> np.uint64(3)] >> (x & np.uint64(7)).astype(np.uint8)) & 1
    return (has(keys) & has(keys >> np.uint64(32))) > 0


def _hits(mask):
    """One row per text and gram that the mask may hold, with its positions."""
    @tidy
    def run(batches):
        for batch in batches:
            rows, grams, places, counts = [], [], [], []
            for i, text in enumerate(batch.column(2)):
                keys = gram_keys(hashes_of(text.as_py()))
                at = np.flatnonzero(_in_mask(mask.value, keys))
                if not len(at):
                    continue
                at = at[np.argsort(keys[at], kind="stable")]
                found = keys[at]
                first = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1])))
                rows.append(np.full(len(first), i))
                grams.append(found[first])
                places.append(at)
                counts.append(np.diff(np.append(first, len(at))))
            if rows:
                take = pa.array(np.concatenate(rows))
                ends = np.concatenate(([0], np.cumsum(np.concatenate(counts))))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), pa.array(np.concatenate(grams).view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(places), pa.int32()))],
                    names=["doc_id", "key", "gram", "positions"])
    return run


def _masked(mask):
    """The rows whose key (the second column) the mask may hold."""
    @tidy
    def run(batches):
        for batch in batches:
            keys = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            yield batch.filter(pa.array(_in_mask(mask.value, keys)))
    return run


def _seeds(grams: DataFrame, hits: DataFrame) -> DataFrame:
    """item, gram, lo and hi (first and last place of the gram in the item) of
    the grams that the corpus is searched with."""
    shared = grams.select("item", "gram").distinct().groupBy("gram").agg(F.count("*").alias("items"))
    frequency = hits.groupBy("gram").agg(F.count("*").alias("df"))
    along = Window.partitionBy("item").orderBy("at")
    own = F.max(F.col("items") <= SHARED).over(Window.partitionBy("item"))
    return (grams.join(shared, "gram").join(frequency, "gram", "left").withColumn("own", own)
            .withColumn("rarest", F.min("df").over(along.rangeBetween(0, WINDOW - 1)))
            .withColumn("rarest", F.max("rarest").over(along.rangeBetween(1 - WINDOW, 0)))
            .filter((F.col("df") <= CLOSE * F.col("rarest")) & ((F.col("items") <= SHARED) | ~F.col("own")))
            .groupBy("item", "gram").agg(F.min("at").alias("lo"), F.max("at").alias("hi")))


def _stretches(seeds, length: int, n_words: int):
    """Merged intervals of the text's words around an item's seeds."""
    pos = np.concatenate([np.array(s["positions"], dtype=np.int64) for s in seeds])
    lo, hi = (np.repeat([s[name] for s in seeds], [len(s["positions"]) for s in seeds]) for name in ("lo", "hi"))
    pad = length // 4 + 2
    start, end = np.maximum(0, pos - hi - pad), np.minimum(n_words, pos - lo + length + pad)
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.concatenate(([True], start[1:] > end[:-1])))
    return zip(start[new].tolist(), end[np.append(new[1:], len(end)) - 1].tolist())


def _copies(similarity: float):
    """Aligns the stretches of every text with its items: those of at least
    ``similarity``."""
    def near(text, items):
        words = hashes_of(text)
        for item in items:
            own = hashes_of(item["item_text"])
            known, number, times = np.unique(own, return_inverse=True, return_counts=True)
            for s, e in _stretches(item["seeds"], len(own), len(words)):
                at = np.minimum(np.searchsorted(known, words[s:e]), len(known) - 1)
                ids = np.where(known[at] == words[s:e], at + 1, 0)
                common = np.minimum(np.bincount(ids, minlength=len(known) + 1)[1:], times).sum()
                if common / len(own) >= similarity:  # no alignment has more matches
                    yield item["item"], s, number + 1, ids.astype(np.int32)

    def aligned(held):
        doc, key, item, start, own, ids = zip(*held)
        score, where = align_pairs(own, ids)
        share = score / (MATCH * np.array([len(x) for x in own]))
        good = np.flatnonzero(share >= similarity)

        def kept(values):
            return [values[i] for i in good]
        return pa.RecordBatch.from_arrays(
            [pa.array(kept(doc), pa.int64()), pa.array(kept(key), pa.int64()), pa.array(kept(item), pa.int64()), pa.array(score[good], pa.int64()),
             pa.array(np.array(kept(start), dtype=np.int64) + where[good], pa.int64()), pa.array(share[good], pa.float64())],
            names=["doc_id", "key", "item", "score", "end_word", "similarity"])

    @tidy
    def run(batches):
        held, n = [], 0
        for batch in batches:
            for doc_id, key, text, items in zip(*(batch.column(i) for i in range(4))):
                for item, start, own, ids in near(text.as_py(), items.as_py()):
                    held.append((doc_id.as_py(), key.as_py(), item, start, own, ids))
                    n += len(ids) + len(own)
                    if n > HELD_WORDS:
                        yield aligned(held)
                        held, n = [], 0
        if held:
            yield aligned(held)
    return run


def align_pairs(items: list[np.ndarray], stretches: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score of each item with its stretch (arrays of
    word numbers, of items above 0), and the word of the stretch where it ends
    (exclusive).  Pairs of similar size advance together one item word at a
    time; a running maximum carries the gaps."""
    best, where = np.zeros(len(items), dtype=np.int64), np.zeros(len(items), dtype=np.int64)
    order = sorted(range(len(items)), key=lambda i: (len(stretches[i]), len(items[i])))
    while order:
        n = max(1, min(len(order), CELLS // max(1, len(stretches[order[-1]]))))
        part, order = order[-n:], order[:-n]
        best[part], where[part] = _align([items[i] for i in part], [stretches[i] for i in part])
    return best, where


def _align(items, stretches):
    longest = max(map(len, stretches))
    a = np.full((max(map(len, items)), len(items)), -2, dtype=np.int32)  # past an item's end nothing matches
    b = np.full((len(stretches), longest), -1, dtype=np.int32)
    for i, (x, y) in enumerate(zip(items, stretches)):
        a[:len(x), i], b[i, :len(y)] = x, y
    inside = np.arange(longest) < np.array([len(s) for s in stretches])[:, None]
    slope = -GAP * np.arange(1, longest + 1, dtype=np.int32)
    h = np.zeros((len(stretches), longest + 1), dtype=np.int32)
    best, where = np.zeros(len(stretches), dtype=np.int32), np.zeros(len(stretches), dtype=np.int64)
    for w in a:
        step = np.where(b == w[:, None], np.int32(MATCH), np.int32(MISMATCH))
        now = np.maximum(np.maximum(h[:, :-1] + step, h[:, 1:] + GAP), 0)
        now = np.maximum.accumulate(now + slope, axis=1) - slope
        now[~inside] = 0
        h[:, 1:] = now
        at = now.argmax(1)
        top = now[np.arange(len(now)), at]
        better = top > best
        best[better], where[better] = top[better], at[better] + 1
    return best, where


def align(item: list[str], stretches: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score of the item with each stretch, and the word
    of the stretch where it ends (exclusive)."""
    number = {}
    a = np.array([number.setdefault(w, len(number) + 1) for w in item], dtype=np.int64)
    return align_pairs([a] * len(stretches), [np.array([number.get(w, 0) for w in s], dtype=np.int64) for s in stretches])


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds a copy of:
    doc_id, key (hash of the text), item_id, score (of the best alignment),
    end_word (word of the document where it ends), similarity (score as a
    share of a perfect copy's), at least ``similarity``.

    Words are runs of letters and digits, lower-cased.  A copy has to hold a
    seed of the item (see the module); what only repeats words that more than
    SHARED items have in common is none.  Items of fewer than GRAM words match
    texts of exactly these words.  Null and empty texts hold nothing; of several
    copies of an item in one document the best counts; rows that repeat doc_id
    and text give one pair, as do items that repeat item_id (the best); null ids
    are kept; an empty table on either side gives no pairs; other columns are
    ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text")).select(
        "doc_id", F.xxhash64("text").alias("key"), "text")
    named = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_column().alias("item_text")).withColumn("item", F.xxhash64("item_text"))
    texts = named.groupBy("item").agg(F.first("item_text").alias("item_text"))

    grams = table(texts.select("item", "item_text").mapInArrow(_item_grams, "item long, at int, gram long"), "item-grams")
    mask = spark.sparkContext.broadcast(_mask(grams.select("gram")))
    hits = table(base.mapInArrow(_hits(mask), "doc_id long, key long, gram long, positions array<int>"), "gram-hits")
    mask.unpersist()
    seeds = table(_seeds(grams, hits), "seeds")
    pairs = table(hits.join(seeds, "gram").dropDuplicates(["doc_id", "key", "item", "gram"])
                  .groupBy("doc_id", "key", "item").agg(F.collect_list(F.struct("positions", "lo", "hi")).alias("seeds")), "seeded-pairs")

    # only texts that may be wanted are shuffled, whatever join Spark picks
    mask = spark.sparkContext.broadcast(_mask(pairs.select("key")))
    likely = base.mapInArrow(_masked(mask), "doc_id long, key long, text string")
    wanted = pairs.select(F.col("doc_id").alias("id"), F.col("key").alias("hash")).distinct()
    found_texts = table(likely.join(wanted, likely["doc_id"].eqNullSafe(wanted["id"]) & (likely["key"] == wanted["hash"]), "left_semi")
                        .dropDuplicates(["doc_id", "key"]), "seeded-texts")
    mask.unpersist()
    items = (pairs.join(texts, "item").groupBy(F.col("doc_id").alias("id"), F.col("key").alias("hash"))
             .agg(F.collect_list(F.struct("item", "item_text", "seeds")).alias("items")))
    best = F.max(F.struct("similarity", "score", "end_word")).alias("b")
    return (found_texts.join(items, found_texts["doc_id"].eqNullSafe(items["id"]) & (found_texts["key"] == items["hash"]))
            .select("doc_id", "key", "text", "items")
            .mapInArrow(_copies(similarity), "doc_id long, key long, item long, score long, end_word long, similarity double")
            .join(named.select("item", "item_id").distinct(), "item")
            .groupBy("doc_id", "key", "item_id").agg(best)
            .select("doc_id", "key", "item_id", "b.score", "b.end_word", "b.similarity"))


def op3_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("key")
