"""Each stage against a brute-force version on the stage's own input."""

import re

from collections import Counter

import corpus_pipeline as P
import pytest
from pyspark.sql import functions as F

from cartwheel.llm import bpe, decontamination, pii, toxicity
from cartwheel.llm.common import table

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    import numpy as np
    import tiktoken
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = docs.columns
    assert [n for n, _ in P.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "byte_bpe"]
    inputs = [docs]
    for name, stage in P.STAGES:
        inputs.append(table(stage(spark, inputs[-1], SMALL), f"test-{name}"))
    assert all(d.columns == names for d in inputs[:5])
    start, clean, single, pure, masked = ({r["doc_id"]: r for r in d.collect()} for d in inputs[:5])

    model = toxicity.fit(docs.select("doc_id", "text"), spark.read.parquet(f"{SMALL}/labels.parquet"))
    score = model.scorer()
    assert set(clean) == {i for i, r in start.items() if score(r["text"] or "") < 0.5}

    def shingle(t):
        w = (t or "").encode().lower().split()
        return frozenset(zip(*(w[k:] for k in range(5)))) if len(w) > 4 else frozenset([tuple(w)] if w else [])

    sets = {i: shingle(r["text"]) for i, r in clean.items()}
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for i in sets:
            for j in sets:
                if label[i] != label[j] and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    assert set(single) == {i for i in sets if label[i] == i}

    items = [decontamination.words_of(r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    kept = set()
    for i, r in single.items():
        w = decontamination.words_of(r["text"] or "")
        best = max((int(decontamination.align(t, [w])[0][0]) / (2 * len(t)) for t in items if len(t) >= 4), default=0) if w else 0
        if best < decontamination.SIMILARITY:
            kept.add(i)
    assert set(pure) == kept

    assert {i: r["text"] for i, r in masked.items()} == {
        i: pii.redact_text(r["text"], pii.find_spans(r["text"])) if r["text"] else r["text"] for i, r in pure.items()}
    assert all(r["n_chars"] == len(r["text"]) and not re.search(r"\d+@mail", r["text"]) for r in masked.values())

    path, pattern = bpe.public_vocabulary()
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    assert {r["doc_id"]: bytes(r["ids"]) for r in inputs[5].collect()} == {
        i: np.array(own.encode_ordinary(r["text"] or ""), dtype="<u4").tobytes() for i, r in masked.items()}


WORDS = "river stone cloud walks quietly seven green boats under old bridges while nobody watches them go home again".split()


def odd_rows():
    import random
    r = random.Random(11)

    def text(n):
        return " ".join(r.choice(WORDS) + str(r.randint(0, 99)) for _ in range(n))
    base = text(100)
    return [(1, None), (2, text(60)), (2, text(60)), (2, text(60)), (3, base), (4, base + " " + text(3)), (4, text(50)), (5, ""), (5, ""), (None, base),
            (None, text(40)), (None, None), (6, "mail me at someone@mail.org today " + text(30)), (6, base), (7, text(5000)), (8, "z" * 50_000)]


CLASH = ("goes", "group_id", "node", "marked_node", "component", "rows", "first", "pii_spans", "toxicity", "bad_id", "bad_key", "key", "ids", "codes",
         "block", "n_shingles", "size", "unnamed", "other_column_2", "label", "score", "lang")


@pytest.mark.parametrize("at", range(5))
def test_stage_edges(spark, at):
    """Nulls, repeated ids with other texts, empty tables and clashing names."""
    rows = odd_rows()
    plain = spark.createDataFrame(rows, "doc_id long, text string")
    clashing = plain.repartition(3).withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in CLASH})
    name, stage = P.STAGES[at]
    stored = table(clashing, "odd-docs")
    out = stage(spark, stored, SMALL)
    got = out.collect()
    assert stage(spark, stored.filter("doc_id = 99"), SMALL).count() == 0
    if name == "byte_bpe":
        assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in rows)
        return
    assert out.columns == clashing.columns
    assert all(r[c] == (c + str(r["doc_id"]) if r["doc_id"] is not None else None) for r in got for c in CLASH)
    kept = Counter((r["doc_id"], r["text"]) for r in got)
    if name == "near_duplicates":  # the copies of the text of document 3 go, whatever else their ids hold
        base = rows[4][1]
        assert kept == Counter(x for x in rows if x not in ((4, rows[5][1]), (None, base), (6, base)))
    elif name == "personal_data":
        assert sum("[EMAIL]" in (t or "") for _, t in kept.elements()) == 1 and len(got) == len(rows)
    else:
        assert kept == Counter(rows)


def test_of_equal_rows_one_stays(spark):
    docs = table(spark.createDataFrame([(1, "one two three four five six"), (1, "one two three four five six"), (2, "other words entirely"), (2, "")],
                                       "doc_id long, text string"), "equal-docs")
    got = P.drop_near_duplicates(spark, docs, SMALL)
    assert sorted(map(tuple, got.collect())) == [(1, "one two three four five six"), (2, ""), (2, "other words entirely")]
