"""Every registered query against its DuckDB oracle (exact doubles)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_ORACLE

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_ORACLE}/{t}.parquet')")
    return c


def _norm(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else v


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_ORACLE)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(x) for x in r) for r in df.select(*cols).collect()), key=repr)
    o = con.execute(ORACLE[name])
    ocols = [x[0] for x in o.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in o.fetchall()), key=repr)
    assert len(got) == len(want)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_oracle_runs(spark, name):
    df = QUERIES[name](spark, SF_ORACLE)
    assert df.count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "ma1000" in df.columns
