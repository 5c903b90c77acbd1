"""Every registered analytic against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

from eventflow.plans import ORACLE, QUERIES
from eventflow.sources.tables import TABLES

from base_rows import SF_SMALL


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    assert name in ORACLE, f"{name} has no oracle"
    rel = duck.sql(ORACLE[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert len(got) == len(want)
    assert got == want


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns == ["window_end", "rank", "item_id", "count"]
    assert df.count() >= 0
    assert set(e.oracle_sql()) <= set(e.queries())
