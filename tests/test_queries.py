"""Every registered query against its SQL statement in DuckDB, on the smallest supplied tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = entry.SMOKE_DIR
LLM_QUERIES, LLM_STATEMENTS = entry._training_data()
QUERIES = {k: v for k, v in entry.queries().items() if k not in LLM_QUERIES}
STATEMENTS = {k: v for k, v in entry.oracle_sql().items() if k not in LLM_STATEMENTS}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="supplied tables are absent")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in ("region", "nation", "customer", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    yield con
    con.close()


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return repr(v)
    return repr(float(v)) if isinstance(v, int | float) else repr(v)


def sorted_rows(names, rows):
    order = [names.index(c) for c in sorted(names)]
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(STATEMENTS)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    relation = duck.sql(STATEMENTS[name])
    assert sorted(df.columns) == sorted(relation.columns)
    expected = sorted_rows(relation.columns, relation.fetchall())
    assert sorted_rows(df.columns, [tuple(r) for r in df.collect()]) == expected


def test_entry(spark):
    assert entry.entry(spark).columns == ["SECTOR", "MULTIPLIER"]
