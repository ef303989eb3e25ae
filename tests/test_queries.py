"""Every registered query against its SQL counterpart in DuckDB."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
import workload

SF_DIR = "/root/testdata/sf0.001"
ORACLES = contract.oracle_sql()
QUERIES = {name: f for name, f in contract.queries().items() if name in ORACLES}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _sorted_rows(rows, columns):
    places = [columns.index(c) for c in sorted(columns)]
    return sorted(tuple(repr(row[p]) for p in places) for row in rows)


def test_every_query_has_sql():
    assert set(workload.QUERIES) == set(workload.ORACLES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    expected = _sorted_rows(result.fetchall(), columns)
    assert expected
    assert _sorted_rows([tuple(r) for r in df.collect()], df.columns) == expected


def test_entry(spark):
    assert contract.entry(spark).count() > 0
