"""The driver contract on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
LISTING = [k for k in entry.oracle_sql() if not k.startswith("op") and k != "pipeline"]


def cell(v):
    if v is None or v != v:
        return None
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10]
    return f"{float(v):.9g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", LISTING)
def test_query_gives_what_sql_gives(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = db.sql(entry.oracle_sql()[name])
    columns = sorted(want.columns)
    got = entry.queries()[name](spark, SF)
    assert sorted(got.columns) == columns
    key = lambda row: tuple((x is not None, x or "") for x in row)
    ours = sorted((tuple(map(cell, r)) for r in got.select(columns).collect()), key=key)
    theirs = sorted((tuple(map(cell, r)) for r in want.select(*[f'"{c}"' for c in columns]).fetchall()), key=key)
    assert ours == theirs


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_flagship(spark):
    assert entry.entry(spark).count() > 0
