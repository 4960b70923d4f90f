"""Spelling variant grouping over a trie-node pair dictionary.

The prefixes of all words are the nodes of a trie, their suffixes those of a
reversed trie.  A word with one position skipped is the integer pair (node of
the prefix before it, node of the suffix after it); a word with a position
opened between two letters is the pair of the prefix and the suffix that meet
there.  Two words differ by a replacement where they share a skipped pair, and
by an insertion where the skipped pair of one is an opened pair of the other.

Nodes are numbered along their path, the same in every task: a node's number
is made from its parent's and the letter.  That the numbers are one to one is
checked on all nodes, and another seed is taken where they aren't, so pairs
are exact.  A skipped pair is shared by at most as many words as the alphabet
has letters, an opened pair by one, so no group of the dictionary is large.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import mix, ship, table, text_column, tidy

LETTERS = re.compile("[a-zÀ-ÿ]+")
#: One in so many runs is misspelt on purpose.
MISSPELT = 199
SHORTEST, FEWEST, RATIO = 6, 5, 5
#: Distinct words a counting task holds, letters a numbering task numbers, and
#: dictionary rows a pairing task compares at a time.
HELD_WORDS, HELD_LETTERS, HELD_ROWS = 300_000, 400_000, 500_000
#: What a dictionary row is: a skipped position (the first, or a later one, of
#: a run of equal letters), or an opened one.
FIRST_SKIP, LATER_SKIP, OPENED = 0, 1, 2


def words_in(doc_id, text: str, misspelt: int = MISSPELT) -> Counter:
    """Occurrences of the words of one text: runs of letters, A-Z lower-cased,
    less one letter where ``misspelt`` divides the CRC of id and run."""
    before = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    found = Counter(LETTERS.findall(text.encode().lower().decode()))
    moved = []
    for run in [r for r in found if zlib.crc32(r.encode(), before) % misspelt == 0]:
        at = zlib.crc32(run.encode(), before) % len(run)
        moved.append((run[:at] + run[at + 1:], found.pop(run)))
    for word, n in moved:
        found[word] += n
    return found


def _counted(misspelt, shortest):
    @tidy
    def run(batches):
        total: Counter = Counter()

        def send():
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                for word, n in words_in(doc_id.as_py(), text.as_py(), misspelt).items():
                    if len(word) >= shortest:
                        total[word] += n
                if len(total) > HELD_WORDS:
                    yield send()
                    total.clear()
        if total:
            yield send()
    return run


def word_counts(docs: DataFrame, misspelt: int = MISSPELT, shortest: int = SHORTEST, fewest: int = FEWEST) -> DataFrame:
    """word and n (occurrences over all texts) of words long and frequent enough."""
    ship(docs.sparkSession)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
            .mapInArrow(_counted(misspelt, shortest), "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= fewest))


def number_nodes(codes: list[np.ndarray], seed: int) -> list[np.ndarray]:
    """Numbers of the trie nodes on the path of every word (its letters as an
    array), the root's first; words of one length at a depth go together."""
    order = sorted(range(len(codes)), key=lambda i: -len(codes[i]))
    lengths = np.array([len(codes[i]) for i in order])
    letters = np.zeros((0,), dtype=np.uint64) if not len(codes) else np.concatenate([codes[i] for i in order]).astype(np.uint64)
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1])) if len(codes) else lengths
    out = np.empty(int(lengths.sum()) + len(order), dtype=np.uint64)
    at = starts + np.arange(len(order))
    with np.errstate(over="ignore"):
        root = mix(np.array([seed], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[0]
        node = np.full(len(order), root, dtype=np.uint64)
        out[at] = node
        for depth in range(int(lengths[0]) if len(order) else 0):
            longer = int(np.searchsorted(-lengths, -depth, side="left"))
            node = mix(node[:longer] * np.uint64(0xD6E8FEB86659FD93) + letters[starts[:longer] + depth] + np.uint64(1))
            out[at[:longer] + depth + 1] = node
    numbered: list = [None] * len(codes)
    for k, i in enumerate(order):
        numbered[i] = out[at[k]:at[k] + lengths[k] + 1]
    return numbered


def _chunks(batches):
    """(ids, words as arrays of code points) of bounded size; a longer word
    makes a chunk of its own."""
    ids, words, letters = [], [], 0
    for batch in batches:
        for i, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids.append(i)
            words.append(np.frombuffer(word.encode("utf-32-le"), dtype=np.uint32))
            letters += len(word)
            if letters >= HELD_LETTERS:
                yield ids, words
                ids, words, letters = [], [], 0
    if ids:
        yield ids, words


def _nodes(seed):
    """Distinct nodes: number, parent's number and letter."""
    @tidy
    def run(batches):
        for _, words in _chunks(batches):
            for side, codes in ((0, words), (1, [w[::-1] for w in words])):
                numbers = number_nodes(codes, 2 * seed + side)
                node = np.concatenate([n[1:] for n in numbers])
                _, first = np.unique(node, return_index=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[first].view(np.int64)), pa.array(np.concatenate([n[:-1] for n in numbers])[first].view(np.int64)),
                     pa.array(np.concatenate(codes)[first].astype(np.int32)), pa.array(np.full(len(first), side, dtype=np.int32))],
                    names=["node", "parent", "letter", "side"])
    return run


def _dictionary(seed):
    """Pairs (prefix node, suffix node) of every word's skipped and opened
    positions, with the word's id and the kind of the position."""
    @tidy
    def run(batches):
        for ids, words in _chunks(batches):
            forward = number_nodes(words, 2 * seed)
            backward = [n[::-1] for n in number_nodes([w[::-1] for w in words], 2 * seed + 1)]
            kinds = [np.concatenate(([FIRST_SKIP], np.where(w[1:] == w[:-1], LATER_SKIP, FIRST_SKIP))) for w in words]
            prefix = np.concatenate([x for f in forward for x in (f[:-1], f)])
            suffix = np.concatenate([x for b in backward for x in (b[1:], b)])
            kind = np.concatenate([x for k in kinds for x in (k, np.full(len(k) + 1, OPENED))])
            member = np.repeat(np.array(ids, dtype=np.int64), [2 * len(w) + 1 for w in words]) * 4 + kind
            for at in range(0, len(member), HELD_ROWS):
                cut = slice(at, at + HELD_ROWS)
                yield pa.RecordBatch.from_arrays([pa.array(prefix[cut].view(np.int64)), pa.array(suffix[cut].view(np.int64)), pa.array(member[cut])],
                                                 names=["prefix", "suffix", "member"])
    return run


def neighbours(prefix: np.ndarray, suffix: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, ...]:
    """(id, near words found, smallest id among them) of the members of the
    pairs that words share, from dictionary rows sorted by pair."""
    new = np.concatenate(([True], (prefix[1:] != prefix[:-1]) | (suffix[1:] != suffix[:-1])))
    start = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    size = np.diff(np.append(start, len(member)))
    shared = size[group] > 1
    if not shared.any():
        return (np.zeros(0, np.int64),) * 3
    member, group = member[shared], group[shared]
    order = np.lexsort((member, group))
    member, group = member[order], group[order]
    word, kind = member >> 2, member & 3
    start = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    size = np.diff(np.append(start, len(member)))
    skip, first, opened = (np.repeat(np.add.reduceat(x.astype(np.int64), start), size) for x in (kind != OPENED, kind == FIRST_SKIP, kind == OPENED))
    near = np.where(kind == OPENED, first, skip - 1 + np.where(kind == FIRST_SKIP, opened, 0))
    best, second = np.repeat(word[start], size), np.repeat(word[start + 1], size)
    return word, near, np.where(word == best, second, best)


def _near():
    """Sorted dictionary rows to (id, near, best); a pair's rows, of which
    there are at most as many as letters and one, are kept together."""
    @tidy
    def run(batches):
        held: list[tuple[np.ndarray, ...]] = []

        def send(rows):
            found = neighbours(*rows)
            return pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["id", "near", "best"])

        for batch in batches:
            held.append(tuple(batch.column(i).to_numpy() for i in range(3)))
            if sum(len(h[0]) for h in held) < HELD_ROWS // 4:
                continue
            rows = tuple(np.concatenate(c) for c in zip(*held))
            last = (rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1])
            cut = len(last) - int(last.sum())
            held = [tuple(c[cut:] for c in rows)]
            if cut:
                yield send(tuple(c[:cut] for c in rows))
        if held and len(held[0][0]):
            yield send(tuple(np.concatenate(c) for c in zip(*held)))
    return run


def _roots(form: DataFrame) -> DataFrame:
    """(id, root): last word reached along (id, form).  Each step at least
    multiplies n by the ratio, so chains are short; a round halves them."""
    paths = table(form.select("id", F.col("form").alias("root")), "spelling-paths")
    while True:
        onward = paths.select(F.col("id").alias("at"), F.col("root").alias("next"))
        if not paths.join(onward, paths["root"] == onward["at"], "left_semi").head(1):
            return paths
        paths = table(paths.join(onward, paths["root"] == onward["at"], "left").select("id", F.coalesce("next", "root").alias("root")), "spelling-paths")


def group_variants(counts: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form, form_n and root of every row (word, n), words
    being distinct.

    Words are near if exactly one inserted, deleted or replaced code point
    parts them.  A word's form is its near word of largest n, ties to the
    smallest in code-point order, where that n is at least ``ratio`` times the
    word's; the root is the last word along the forms, or the word itself.
    Null words are left out; an empty table gives no rows.  A word of any
    length takes rows in proportion to its length.
    """
    ship(counts.sparkSession)
    # ids ascend by n descending, then word: of near words the smallest id is the form
    words = table(counts.filter("word is not null").select("word", "n").orderBy(F.desc("n"), "word")
                  .withColumn("id", F.monotonically_increasing_id()), "spelling-words")
    spelt = words.select("id", "word")
    seed = 0
    while spelt.mapInArrow(_nodes(seed), "node long, parent long, letter int, side int").groupBy("side", "node").agg(
            F.min("parent").alias("p"), F.max("parent").alias("q"), F.min("letter").alias("l"), F.max("letter").alias("m")).filter(
            "p <> q or l <> m").head(1):
        seed += 1
    pairs = spelt.mapInArrow(_dictionary(seed), "prefix long, suffix long, member long")
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = (pairs.repartition(parts, "prefix", "suffix").sortWithinPartitions("prefix", "suffix")
            .mapInArrow(_near(), "id long, near long, best long")
            .groupBy("id").agg(F.sum("near").alias("n_near"), F.min("best").alias("best")))
    best = words.select(F.col("id").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    placed = table(words.join(near, "id", "left").select("id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "best")
                   .join(best, "best", "left").withColumn("has", F.coalesce(F.col("form_n") >= ratio * F.col("n"), F.lit(False)))
                   .select("id", "word", "n", "n_near", F.when(F.col("has"), F.col("best")).alias("form_id"),
                           F.when(F.col("has"), F.col("form")).alias("form"), F.when(F.col("has"), F.col("form_n")).alias("form_n")), "spelling-near")
    roots = _roots(placed.filter("form_id is not null").select("id", F.col("form_id").alias("form")))
    ends = words.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    return (placed.join(roots, "id", "left").join(ends, "root", "left")
            .select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n"))


def spelling_variants(docs: DataFrame, misspelt: int = MISSPELT) -> DataFrame:
    """``group_variants`` of the words of all whole texts.

    Null texts have no words; a null doc_id counts as the empty string in the
    misspelling rule; repeated rows count as often as they occur; other
    columns are ignored; an empty table gives no rows.
    """
    return group_variants(word_counts(docs, misspelt))


def op12_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return spelling_variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))
