from __future__ import annotations

import collections

import duckdb
import pytest

from tidemart.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    result = QUERIES[name](spark, FOLDER)
    assert sorted(result.columns) == sorted(columns)
    assert collections.Counter(tuple(r) for r in result.select(*columns).collect()) == collections.Counter(cursor.fetchall())
