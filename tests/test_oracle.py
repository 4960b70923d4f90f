"""Every catalog query against its DuckDB oracle on the smallest tables."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E

SF_SMALL = os.environ.get("CARTWHEEL_ORACLE_SF", "/root/testdata/sf0.001")


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return int(v) if v.is_integer() else round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    return v


def _rows(df):
    cols = sorted(df.columns)
    return sorted(repr(tuple(_norm(r[c]) for c in cols)) for r in df.to_dict("records"))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["events", "part"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    exp = con.execute(E.oracle_sql()[name]).fetchdf()
    assert sorted(got.columns) == sorted(exp.columns)
    assert len(got) == len(exp)
    assert _rows(got) == _rows(exp)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "category_code"
