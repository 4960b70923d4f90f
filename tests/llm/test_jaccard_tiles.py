"""Slices, bitmaps and tile blocks of the Jaccard join."""

import random

import numpy as np
import pyarrow as pa
import pytest

from cartwheel.llm import jaccard_join as J


def linked(x, y, percent):
    both = len(np.intersect1d(x, y))
    return 100 * both >= percent * (len(x) + len(y) - both)


def sets_around(r, n, edits):
    base = np.unique(r.integers(0, (1 << 64) - 1, n, dtype=np.uint64))
    drop, add = int(r.integers(0, edits + 1)), int(r.integers(0, edits + 1))
    return base, np.unique(np.concatenate((r.permutation(base)[drop:], r.integers(0, (1 << 64) - 1, add, dtype=np.uint64))))


@pytest.mark.parametrize("percent", [80, 90, 95])
def test_linked_sets_share_a_slice(percent):
    r, edges, seen = np.random.default_rng(percent), J._edges(1 << 40), 0
    for n in [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 13, 15, 19, 22, 28, 33, 40, 48, 63, 80, 94, 141, 300, 475, 1000, 2500]:
        for _ in range(60):
            x, y = sets_around(r, n, max(1, n * (100 - percent) // 100))
            if len(x) and len(y) and linked(x, y, percent):
                a, b = (np.concatenate(J._slices(s, edges, percent)) for s in (x, y))
                assert len(np.intersect1d(a, b)), n
                seen += 1
    assert seen > 300


def test_sparse_sets_make_no_empty_tile():
    """Sets of one band without a common hash share no slice."""
    r, edges = np.random.default_rng(1), J._edges(1 << 40)
    counts = {}
    for _ in range(400):
        s = np.unique(r.integers(0, (1 << 64) - 1, int(r.integers(480, 700)), dtype=np.uint64))
        for x in np.concatenate(J._slices(s, edges, 90)).tolist():
            counts[x] = counts.get(x, 0) + 1
    assert max(counts.values()) == 1


def test_a_bitmap_folds_to_the_shorter_length():
    r = np.random.default_rng(2)
    for n in (1, 20, 32, 33, 64, 65, 500, 3000):
        s = np.unique(r.integers(0, (1 << 64) - 1, n, dtype=np.uint64))
        bits = J.bitmap(s).view(np.uint64)
        assert len(bits) * 64 >= J.BITS * len(s)
        half = len(bits) // 2
        if half:
            expected = np.zeros(64 * half, dtype=np.uint8)
            expected[(s % np.uint64(64 * half)).astype(np.int64)] = 1
            assert (np.packbits(expected).view(np.uint64) == J._fold(bits[None])[0]).all()


def blocks_of(sets, percent, comps=None, tiles=(4,)):
    rows = [(t, 0, 0, i, len(s), comps[i] if comps else i, 0, J.bitmap(s), sorted(tiles, reverse=True)) for t in tiles for i, s in enumerate(sets)]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                       names=["slice", "i", "j", "doc_id", "n", "comp", "block", "bits", "listed"])
    out = []
    for size in (batch.num_rows, 7):  # batches cut tiles anywhere
        parts = [batch.slice(at, size) for at in range(0, batch.num_rows, size)]
        found = [p for b in J._tile_pairs(percent)(iter(parts)) for p in zip(*(c.to_pylist() for c in b.columns))]
        out.append(sorted(found))
    assert out[0] == out[1]
    return out[0]


def test_a_block_leaves_no_linked_pair_out_and_few_others():
    """Long texts that share two thirds of their shingles leave no block."""
    r = np.random.default_rng(3)
    shared = r.integers(0, (1 << 64) - 1, 1600, dtype=np.uint64)
    sets = [np.unique(np.concatenate((shared, r.integers(0, (1 << 64) - 1, int(r.integers(300, 500)), dtype=np.uint64)))) for _ in range(60)]
    near = [np.unique(np.concatenate((s[int(r.integers(0, 30)):], r.integers(0, (1 << 64) - 1, 20, dtype=np.uint64)))) for s in sets[:20]]
    small = [np.unique(r.integers(0, (1 << 64) - 1, n, dtype=np.uint64)) for n in (1, 30, 33, 64, 66)]
    every = sets + near + small + [np.append(s, np.uint64((1 << 63) + 5)) for s in small]
    expected = {(i, j) for i in range(len(every)) for j in range(i + 1, len(every)) if linked(every[i], every[j], 90)}
    got = set(blocks_of(every, 90))
    assert len(expected) >= 24 and expected <= got and len(got) <= len(expected) + 3
    assert blocks_of(every, 90, tiles=(9, 4, 7)) == sorted(got)  # a pair leaves one tile
    joined = [0] * len(every)
    assert blocks_of(every, 90, joined) == []


def test_documents_that_share_most_slices(spark):
    """Edited copies of one text meet in many tiles of the same members, of
    which one is compared."""
    r = random.Random(4)
    base = [f"w{i}" for i in range(700)]
    made = []
    for i in range(8):
        w = list(base)
        for at in r.sample(range(700), 12):
            w[at] = f"e{i}-{at}"
        made.append((i, " ".join(w)))
    docs = spark.createDataFrame(made, "doc_id long, text string")
    got = {x["doc_id"]: x["component_id"] for x in J.near_duplicates(docs).collect()}
    sets = [J.shingles(t) for _, t in made]
    label = list(range(8))
    for _ in range(8):
        for i in range(8):
            for j in range(8):
                if linked(sets[i], sets[j], 90):
                    label[i] = label[j] = min(label[i], label[j])
    assert got == dict(enumerate(label))
    with pytest.raises(ValueError):
        J.links(docs, percent=40)


def test_a_dense_block_sends_a_forest_first(spark, monkeypatch):
    """Of a block of near copies fewer pairs than members leave, and its tile;
    in the join, links that no forest held are found in the second comparison."""
    r = np.random.default_rng(5)
    shared = r.integers(0, (1 << 64) - 1, 1000, dtype=np.uint64)
    sets = [np.unique(np.concatenate((shared, r.integers(0, (1 << 64) - 1, 20, dtype=np.uint64)))) for _ in range(40)]
    rows = [(4, 0, 0, i, len(s), i, 0, J.bitmap(s), []) for i, s in enumerate(sets)]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                       names=["slice", "i", "j", "doc_id", "n", "comp", "block", "bits", "listed"])
    found = [p for b in J._tile_pairs(90, J.DENSE)(iter([batch])) for p in zip(*(c.to_pylist() for c in b.columns))]
    assert len(found) == 40 and found[-1] == (None, None, 4)
    assert len({x for a, b, _ in found[:-1] for x in (a, b)}) == 40
    whole = [p for b in J._tile_pairs(90)(iter([batch])) for p in zip(*(c.to_pylist() for c in b.columns))]
    assert len(whole) == 40 * 39 // 2 and {(a, b) for a, b, _ in found[:-1]} <= set(whole)

    pick = random.Random(6)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for i in range(120):
        words = list(base)
        for _ in range(pick.randint(0, 4)):
            words[pick.randrange(60)] = f"x{pick.randrange(30)}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    own = [J.shingles(t) for t in texts]
    part = list(range(120))
    for i in range(120):
        for j in range(i):
            if linked(own[i], own[j], 80) and part[i] != part[j]:
                lo, hi = sorted((part[i], part[j]))
                part = [lo if p == hi else p for p in part]
    monkeypatch.setattr(J, "DENSE", 0.1)
    # a forest of the least alike, so that most of its pairs are no links
    monkeypatch.setattr(J, "_forest", lambda a, b, differ, x, y: [int(np.argmax(differ))])
    got = {r.doc_id: r.component_id for r in J.near_duplicates(docs, 3, 80).collect()}
    assert got == dict(enumerate(part)) and len(set(part)) > 1
