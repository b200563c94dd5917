"""Registered queries against their SQL on the smallest tables."""

import os

import pytest

pytest.importorskip("lindero.llm")
duckdb = pytest.importorskip("duckdb")

from lindero.llm import queries  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_gives_what_sql_gives(spark, name):
    db = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "labels"):
        db.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = db.sql(queries.ORACLES[name])
    columns = sorted(want.columns)
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == columns
    assert sorted((tuple(r) for r in got.select(columns).collect()), key=str) == sorted(want.select(*columns).fetchall(), key=str)
