"""Every registered query against its SQL oracle on the smallest test tables."""

import collections

import duckdb
import pytest

import __spark_entry__ as entry
from tidemart.plans import oracles, registry

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def counted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return collections.Counter(
        tuple(float(r[i]) if isinstance(r[i], (int, float)) else r[i] for i in order) for r in rows)


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(oracles.ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    result = entry.entry(spark)
    assert result.columns == ["category", "year", "month", "order_count", "category_revenue",
                              "avg_order_value", "revenue_pct"]
    assert result.count() > 0


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_matches_oracle(spark, con, name):
    result = entry.queries()[name](spark, FOLDER)
    cursor = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(result.columns) == sorted(columns)
    assert counted(result.columns, [tuple(r) for r in result.collect()]) == counted(columns, cursor.fetchall())
