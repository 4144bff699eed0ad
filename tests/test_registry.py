"""Every registered query against DuckDB on the smallest data set."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

DATA = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    return con


def table(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, oracle, name):
    df = queries()[name](spark, DATA)
    rows = df.collect()
    assert rows
    cursor = oracle.execute(oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert table(df.columns, rows) == table(names, cursor.fetchall())


def test_entry(spark):
    assert entry(spark).count() > 0
