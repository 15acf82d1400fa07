"""Every registered query against its SQL, values compared exactly."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from trafficlake.plans.oracles import ORACLES
from trafficlake.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in os.listdir(SF_DIR):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF_DIR}/{file}'")
    return con


def _sorted(rows):
    return sorted(rows, key=lambda row: [(v is not None, str(v)) for v in row])


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= contract.queries().items()
    assert ORACLES.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, name):
    result = contract.queries()[name](spark, SF_DIR)
    expected = duck.execute(contract.oracle_sql()[name])
    columns = sorted(result.columns)
    expected_columns = [d[0] for d in expected.description]
    assert columns == sorted(expected_columns)
    order = [expected_columns.index(c) for c in columns]
    expected_rows = [tuple(row[i] for i in order) for row in expected.fetchall()]
    rows = [tuple(row) for row in result.select(*columns).collect()]
    assert rows
    assert _sorted(rows) == _sorted(expected_rows)
    types = dict(zip(expected_columns, (str(d[1]) for d in expected.description)))
    spark_types = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}
    spark_types |= {"boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
    assert {c: spark_types[t] for c, t in result.dtypes} == types


def test_entry(spark):
    assert contract.entry(spark).count() == 4
