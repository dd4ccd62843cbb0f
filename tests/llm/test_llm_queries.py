"""Each registered query that SQL can express against its SQL in DuckDB."""

import duckdb
import pytest

from curbline.llm.registry import ORACLE, QUERIES

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def database(testdata):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{testdata}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_its_sql(spark, testdata, database, name):
    frame = QUERIES[name](spark, testdata)
    wanted = database.sql(ORACLE[name])
    columns = sorted(frame.columns)
    assert columns == sorted(wanted.columns)
    got = sorted((tuple(row) for row in frame.select(*[f"`{c}`" for c in columns]).collect()), key=repr)
    assert got == sorted(wanted.select(*[f'"{c}"' for c in columns]).fetchall(), key=repr)
