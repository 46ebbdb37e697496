"""Every registered query against its DuckDB oracle at sf0.001 (the
correctness gate's comparison, at the smallest scale)."""

import datetime as dt
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "document_text" in df.columns


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rows, cols = df.collect(), df.columns
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    a = Counter(tuple(_norm(r[c]) for c in sorted(cols)) for r in rows)
    idx = {c: i for i, c in enumerate(ocols)}
    b = Counter(tuple(_norm(r[idx[c]]) for c in sorted(cols)) for r in orows)
    assert a == b


def test_every_query_has_an_oracle():
    from cvelake import oracle
    from cvelake.queries import QUERIES

    assert set(QUERIES) == set(oracle.sql())
