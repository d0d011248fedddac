"""Every catalogue query with an oracle: Spark result == DuckDB SQL at sf0.001."""

import math
import os

import pandas as pd
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if math.isinf(v) else round(v, 6)
    return v


def _rows(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def con():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    got = entry.queries()[name](spark, SF).toPandas()
    want = con.execute(entry.oracle_sql()[name]).fetchdf()
    assert _rows(got) == _rows(want)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and df.columns == ["items", "size", "freq", "support"]


def test_every_query_registered():
    q, s = entry.queries(), entry.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 60
