from cartwheel.operators import dedup as dd
from tests.micro import SCHEMA, ev


def _rows():
    a = ev(1, 1, "view", 1, 5)
    rows = [a, (2,) + a[1:], (3,) + a[1:], ev(4, 1, "view", 1, 6)]
    nb1 = ev(5, 2, "view", 2, 1, brand=None)
    rows += [nb1, (6,) + nb1[1:]]
    return rows


def test_dedup_keeps_first(spark):
    df = spark.createDataFrame(_rows(), SCHEMA)
    got = sorted(r.seq for r in dd.dedup_exact(df).collect())
    assert got == [1, 4, 5]


def test_profile_and_histogram(spark):
    df = spark.createDataFrame(_rows(), SCHEMA)
    p = dd.duplicate_profile(df).collect()[0]
    assert (p.rows_involved, p.excess_rows, p.repeated_keys) == (5, 3, 2)
    h = {r.copies: r.keys for r in dd.repetition_histogram(df).collect()}
    assert h == {3: 1, 1: 1, 2: 1}


def test_mark_duplicates(spark):
    df = spark.createDataFrame(_rows(), SCHEMA)
    first = {r.seq: r.is_duplicate for r in dd.mark_duplicates(df, keep="first").collect()}
    assert first == {1: False, 2: True, 3: True, 4: False, 5: False, 6: True}
    allx = {r.seq: r.is_duplicate for r in dd.mark_duplicates(df, keep=False).collect()}
    assert allx == {1: True, 2: True, 3: True, 4: False, 5: True, 6: True}


def test_dedup_idempotent(spark):
    df = spark.createDataFrame(_rows(), SCHEMA)
    once = dd.dedup_exact(df)
    assert sorted(once.collect()) == sorted(dd.dedup_exact(once).collect())


def test_fingerprint_keeps_markers_and_delimiters_apart(spark):
    from cartwheel.operators.dedup import fingerprint
    rows = [("a|b", "c"), ("a", "b|c"), (None, "z"), ("∅", "z"), ("N", "z"), ("", "z"), ("1:N", None), ("1", ":N"), ("1:a", "b"), ("1", ":ab")]
    df = spark.createDataFrame(rows, "x string, y string")
    assert fingerprint(df, ["x", "y"]).select("fingerprint").distinct().count() == len(rows)


def test_incremental_dedup_keeps_new_rows_with_markers(spark):
    from cartwheel.operators.dedup import fingerprint
    seen = fingerprint(spark.createDataFrame([("a|b", "c"), (None, "z")], "x string, y string"), ["x", "y"]).select("fingerprint")
    assert fingerprint(spark.createDataFrame([("a", "b|c"), ("∅", "z")], "x string, y string"), ["x", "y"]).join(seen, "fingerprint", "left_anti").count() == 2
