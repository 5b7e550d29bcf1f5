"""Every registered query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from millrace import plans

SF = "/root/testdata/sf0.001"
QUERIES, SQL = plans.QUERIES, plans.SQL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canon(columns, found):
    """Rows with columns by name, nulls and NaN alike, in a fixed order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if value is None or value != value:
            return None
        if isinstance(value, float) and value == int(value):
            return int(value)
        return value

    return sorted((tuple(cell(row[i]) for i in order) for row in found), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, small_chunks, name):
    df = QUERIES[name](spark, SF)
    found = canon(df.columns, [tuple(r) for r in df.collect()])
    if name not in SQL:
        assert len(found) > 0
        return
    relation = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(relation.columns)
    assert found == canon(relation.columns, relation.fetchall())


def test_sql_is_for_registered_queries():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
