"""Vector codes, spelling variants and source mixing against brute force, and
their edge cases: nulls, empty and long values, ties, repeated rows, empty
tables and extra columns with clashing names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwheel.llm import mixing, spelling, vector_codes

SMALL = "/root/testdata/sf0.001"


# --- vector codes ---------------------------------------------------------

def brute_codes(rows, parts=8, entries=16, rounds=6):
    """The same codes entry after entry, in Python integers."""
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(kept[0][1]) // parts
    cut = [(i, [tuple(math.floor(Fraction(x) * 4096) for x in v[p * size:(p + 1) * size]) for p in range(parts)], lab) for i, v, lab in kept]
    books = [[r[1][p] for r in cut[:entries]] for p in range(parts)]

    def best(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        members = [defaultdict(list) for _ in range(parts)]
        for _, v, _ in cut:
            for p in range(parts):
                members[p][best(p, v[p])[1]].append(v[p])
        books = [[tuple(sum(c) // len(c) for c in zip(*members[p][k])) if members[p][k] else e for k, e in enumerate(book)] for p, book in enumerate(books)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, by_label = [], Counter()
    for i, v, lab in cut:
        found = [best(p, v[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        by_label[lab] += error
        out.append((i, lab, "".join("%02x" % k for _, k in found), error))
    return Counter((*r, by_label[r[1]], digest) for r in out)


def codes(df, **kw):
    return Counter((r["vec_id"], r["label"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"])
                   for r in vector_codes.compress(df, **kw).collect())


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


def test_codes_of_the_small_table(spark):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    assert codes(df) == brute_codes([(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()])


def test_codes_edges(spark):
    r = random.Random(3)
    rows = [(i, [r.choice([-0.5, 0.0, 0.25, 0.25, 1 / 4096]) for _ in range(16)], i % 3 or None) for i in range(60)]
    rows += [(7, rows[7][1], 1), (7, [0.5] * 16, 1), (None, [0.1] * 16, 2), (70, None, 1), (71, [None] * 16, 1), (72, [float("nan")] * 16, 1),
             (73, [float("inf")] + [0.0] * 15, 1), (74, [-0.0] * 16, None)]
    df = vectors(spark, rows).withColumns({c: F.lit("clash") for c in ("vec", "code", "error", "l", "part", "entry", "s")}).repartition(3)
    assert codes(df) == brute_codes(rows)
    assert vector_codes.compress(df.filter("vec_id = 70")).count() == 0
    # fewer vectors than entries, and none but equal ones
    assert codes(df.filter("vec_id < 5")) == brute_codes([x for x in rows if x[0] is not None and x[0] < 5])
    same = [(i, [0.5] * 8, 0) for i in range(20)]
    assert codes(vectors(spark, same)) == brute_codes(same)
    # vectors of another length than the first one's take no part
    assert codes(vectors(spark, same + [(99, [0.5] * 16, 0)])) == brute_codes(same)


def test_codes_of_huge_components_are_exact(spark):
    r = random.Random(4)
    rows = [(i, [r.choice([1e3, -3e7, 1e12, 0.5]) * r.random() for _ in range(8)], 0) for i in range(40)]
    got = codes(vectors(spark, rows))
    expected = brute_codes(rows)
    wide = lambda e: e if e < 1 << 63 else None
    assert {(k[0], k[2], k[3], k[5]) for k in got} == {(k[0], k[2], wide(k[3]), k[5]) for k in expected}


def test_tree_finds_what_a_scan_finds():
    r = np.random.default_rng(5)
    for n, dim, top in ((16, 8, 50), (200, 4, 4), (64, 2, 1000), (5, 3, 2)):
        entries = r.integers(-top, top + 1, (n, dim))
        x = r.integers(-top, top + 1, (3000, dim))
        code, square = vector_codes.nearest(x, entries, vector_codes.Gnat(entries))
        every = ((x[:, None, :] - entries[None]) ** 2).sum(2)
        assert (code == every.argmin(1)).all() and (square == every.min(1)).all()
    clustered = np.repeat(r.integers(-9000, 9000, (16, 8)), 16, axis=0) + r.integers(-20, 20, (256, 8))
    x = clustered[r.integers(0, 256, 2000)] + r.integers(-5, 5, (2000, 8))
    best, code = np.full(len(x), np.iinfo(np.int64).max), np.full(len(x), 256)
    assert vector_codes.Gnat(clustered).search(x, np.arange(len(x)), best, code) < 0.4 * len(x) * 256


def test_decoded_vectors_are_near(spark):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    books = vector_codes.learn(df)
    coded = vector_codes.encode(df, books)
    back = {r["vec_id"]: r["vec"] for r in vector_codes.decode(coded, books).collect()}
    error = {r["vec_id"]: r["error"] for r in coded.collect()}
    for r in df.collect():
        ints = [math.floor(4096 * x) for x in r["embedding"]]
        assert error[r["vec_id"]] == sum((a - b * 4096) ** 2 for a, b in zip(ints, back[r["vec_id"]]))


# --- spelling variants ----------------------------------------------------

def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_counts(rows, misspelt=199):
    total = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % misspelt == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}


def brute_variants(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return out


def rows_of(df):
    return [(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()]


def test_variants_of_random_words(spark):
    r = random.Random(6)
    counts = {}
    for _ in range(900):  # few letters and short words: many neighbours, runs and ties
        counts["".join(r.choice("aabÀÿ") for _ in range(r.randint(1, 7)))] = r.choice([1, 2, 5, 5, 10, 25, 125, 700])
    counts["aaaaaaaa"] = 7
    df = spark.createDataFrame(list(counts.items()), "word string, n long").withColumns({c: F.lit("x") for c in ("id", "near", "best", "form", "root")})
    got = rows_of(spelling.group_variants(df.union(df.limit(1).withColumn("word", F.lit(None).cast("string")))))
    assert len(got) == len(counts) and set(got) == brute_variants(counts)
    assert spelling.group_variants(df.limit(0)).count() == 0


def test_variants_of_documents(spark):
    r = random.Random(7)
    base = ["weather", "strasse", "Étranger", "Kilometre", "abcdefg"]
    rows = [(i, " ".join(r.choice(base) + r.choice(["", "", "", "s", "-"]) for _ in range(300))) for i in range(40)]
    rows += [(1, None), (None, "weather " * 9), (2, ""), (3, rows[3][1]), (3, rows[3][1]), (50, ("z" * 3000 + " ") * 6), (51, ("z" * 2999 + " ") * 31), (52, "x" * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("word", "n", "id", "member")}).repartition(3)
    got = rows_of(spelling.spelling_variants(df, misspelt=19))
    assert len({g[0] for g in got}) == len(got) and set(got) == brute_variants(brute_counts(rows, 19))
    assert any(g[1] for g in got)
    assert spelling.spelling_variants(df.filter("doc_id = -1")).count() == 0


def test_a_chain_of_forms_ends_at_its_root(spark):
    word, counts = "letterings", {}
    for k in range(10):
        counts[word + "x" * k] = 5 ** (k + 1)
    got = {g[0]: g for g in rows_of(spelling.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long")))}
    assert {g[2] for g in got.values()} == {word + "x" * 9} and got[word][1] == word + "x"


def test_equal_numbers_are_only_equal_nodes():
    r = random.Random(8)
    words = list({"".join(r.choice("ab") for _ in range(r.randint(1, 9))) for _ in range(300)})
    numbers = spelling.number_nodes([np.frombuffer(w.encode("utf-32-le"), dtype=np.uint32) for w in words], 0)
    names = {}
    for w, n in zip(words, numbers):
        assert len(n) == len(w) + 1
        for k, x in enumerate(n):
            assert names.setdefault(int(x), w[:k]) == w[:k]
    assert len(set(names.values())) == len(names)


def test_small_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    counts = brute_counts([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert set(rows_of(spelling.spelling_variants(docs))) == brute_variants(counts)


# --- source mixing --------------------------------------------------------

def brute_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    whole, full = sum(sizes.values()), set()
    while True:
        rest = whole - sum(most * sizes[s] for s in full)
        open_weight = sum(w[s] for s in names if s not in full)
        level = Fraction(rest, open_weight) if open_weight else Fraction(0)
        above = {s for s in names if s not in full and w[s] * level > most * sizes[s]}
        if not above:
            return {s: float(most * sizes[s] if s in full else w[s] * level) for s in names}
        full |= above


def mixing_rows():
    r = random.Random(9)
    rows = [(i, " ".join(["w"] * r.randint(0, 400)), r.choice(["b", "b", "b", "b", "a", "c", "é", "z", None, "hot", "hot", "hot", "hot"])) for i in range(600)]
    rows += [(1000, "one two", "tiny"), (1001, None, "void"), (1002, "", "void"), (None, "x " * 50, "a"), (None, None, None)]
    rows += [(2000, "same text again", "copies")] * 40 + [(2001, "k " * 30_000, "c")]
    return rows


def test_mix(spark):
    rows = mixing_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns(
        {c: F.lit("x") for c in ("s", "size", "hash", "cut", "left", "target", "rank", "part", "at", "cell")}).repartition(4)
    got = mixing.mix(df).collect()
    again = mixing.mix(df.repartition(2)).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["source"] or "", r["taken"])
    assert sorted(got, key=key) == sorted(again, key=key) and len(got) == len(rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").encode().split())
    targets = brute_targets(sizes)
    taken, copies = Counter(), Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and math.isclose(r["target"], targets[r["source"]], rel_tol=1e-12)
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["size"] * r["whole"] + r["part"]
        taken[r["source"]] += r["taken"]
        copies[r["source"]] += r["part"] not in (0, r["size"])
    assert sum(targets.values()) == pytest.approx(sum(sizes.values()))
    for s in sizes:  # to the word, but for what copies at the cut can't share evenly
        assert abs(taken[s] - targets[s]) <= (1 if s != "copies" else 40)
        assert copies[s] <= 1 or s == "copies"
    assert targets["tiny"] == 6 and targets["void"] == 0
    other = mixing.mix(df, seed=14).collect()
    assert sorted(got, key=key) != sorted(other, key=key)
    assert mixing.mix(df.limit(0)).count() == 0


def test_shares_with_many_sources(spark):
    r = random.Random(10)
    sizes = {f"s{i:04d}": r.choice([0, 1, 5, 10 ** r.randint(0, 9)]) for i in range(2000)} | {None: 12}
    got = mixing.fill_shares(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
    expected = brute_targets(sizes)
    rows = got.collect()
    assert len(rows) == len(sizes) and all(math.isclose(x["target"], expected[x["source"]], rel_tol=1e-12, abs_tol=1e-9) for x in rows)


def test_rendered_mix_holds_the_words_taken(spark):
    docs = spark.createDataFrame([x for x in mixing_rows() if x[0] is not None and x[0] < 1002], "doc_id long, text string, source string")
    mixed = mixing.mix(docs)
    words = Counter()
    for r in mixing.render(docs, mixed).collect():
        words[r["doc_id"]] += len(r["text"].split())
    assert {k: v for k, v in words.items() if v} == {r["doc_id"]: r["taken"] for r in mixed.collect() if r["taken"]}
