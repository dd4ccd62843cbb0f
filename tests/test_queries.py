"""Each registered query against its SQL in DuckDB, on the driver's tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from curbline.oracle import ORACLE
from curbline.registry import QUERIES


@pytest.fixture(scope="module")
def database(testdata):
    connection = duckdb.connect()
    connection.execute(f"create view events as select * from '{testdata}/events.parquet'")
    return connection


def normal(rows):
    return sorted(tuple(map(repr, row)) for row in rows)


def test_every_query_has_a_check():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, testdata, database, name):
    frame = QUERIES[name](spark, testdata)
    expected = database.sql(ORACLE[name])
    columns = sorted(frame.columns)
    assert columns == sorted(expected.columns)
    types = dict(zip(expected.columns, map(str, expected.types)))
    same = {
        "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
        "boolean": "BOOLEAN", "date": "DATE",
    }
    assert {c: same[t] for c, t in frame.dtypes} == types
    got = frame.select(*[f"`{c}`" for c in columns]).collect()
    wanted = expected.select(*[f'"{c}"' for c in columns]).fetchall() if columns else []
    assert normal(got) == normal(wanted)


def test_entry_has_rows(spark, testdata):
    assert contract.entry(spark).count() > 0
