"""Split index: the sequence follows file order at any split size, a prefix
opens only its files, and a changed export is noticed."""

import pytest
from pyspark.sql import functions as F

from cartwheel.session import scratch_path
from cartwheel.sources.events import read_events
from cartwheel.sources.split_index import build_split_index, read_indexed


@pytest.fixture(scope="module")
def export(spark, sf_dir):
    from cartwheel.plans.catalog import _csv_export
    return _csv_export(spark, sf_dir)


@pytest.mark.parametrize("split_bytes", [4096, 128 << 20])
def test_sequence_follows_file_order(spark, export, split_bytes):
    path = scratch_path(spark, "index")
    index = build_split_index(spark, export, path, split_bytes)
    files = index.select("path").distinct().count()
    assert index.count() > files if split_bytes == 4096 else index.count() == files
    want = sorted(read_events(spark, export).collect(), key=lambda r: r.seq)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")  # another plan of the caller's
    try:
        got = read_indexed(spark, path)
        assert sorted(got.collect(), key=lambda r: r.seq) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.seq for r in want] == list(range(len(want)))


def test_prefix_opens_only_its_files(spark, export):
    path, parts = scratch_path(spark, "index"), scratch_path(spark, "parts")
    rows = read_events(spark, export)
    rows.repartitionByRange(5, "seq").sortWithinPartitions("seq").drop("seq").write.option("header", True).csv(parts)
    index = build_split_index(spark, parts, path)
    bases = sorted(r.base for r in index.collect())
    n = bases[1] + 1
    got = read_indexed(spark, path, n)
    texts = [f for f in got.inputFiles() if f.endswith(".csv")]
    assert len(texts) == 2 and len(bases) == 5
    assert sorted(r.seq for r in got.collect()) == list(range(n))
    assert "Broadcast" in got._jdf.queryExecution().toString()
    assert read_indexed(spark, path, 0).count() == 0
    assert read_indexed(spark, path, 10**9).count() == index.agg(F.sum("rows")).first()[0]


def test_changed_export_is_an_error(spark, tmp_path):
    head = ",".join(["event_time", "event_type", "product_id", "category_id", "category_code", "brand", "price", "user_id", "user_session"])
    folder = tmp_path / "with space"
    folder.mkdir()
    row = "2019-10-01 00:00:00 UTC,view,1,1,a,b,1.0,{},s\n"
    (folder / "a[1].csv").write_text(head + "\n" + row.format(1) + row.format(2))
    (folder / "b.csv").write_text(head + "\n")
    path = str(tmp_path / "index")
    build_split_index(spark, str(folder), path)
    assert sorted((r.user_id, r.seq) for r in read_indexed(spark, path).collect()) == [("1", 0), ("2", 1)]
    with open(folder / "a[1].csv", "a") as f:
        f.write(row.format(3))
    with pytest.raises(Exception, match="not in the split index"):
        read_indexed(spark, path).collect()
