"""Every registered query against its SQL over the same tables."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from tests.conftest import SF_DIR

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield connection
    connection.close()


def ordered(rows, columns, target):
    places = [columns.index(name) for name in target]
    return sorted((tuple(row[place] for place in places) for row in rows), key=repr)


SPARK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


@pytest.mark.parametrize("name", list(entry_points.QUERIES))
def test_query_equals_sql(name, spark, oracle):
    frame = entry_points.queries()[name](spark, SF_DIR)
    expected = oracle.sql(entry_points.oracle_sql()[name])
    target = sorted(frame.columns)
    assert target == sorted(expected.columns)
    types = dict(zip(expected.columns, map(str, expected.types)))
    for column, kind in frame.dtypes:
        sql_type = SPARK_TYPES.get(kind, kind.upper())
        assert sql_type.replace(" ", "") == types[column].replace(" ", ""), column
    ours = ordered(frame.collect(), frame.columns, target)
    theirs = ordered(expected.fetchall(), expected.columns, target)
    assert len(ours) == len(theirs)
    assert len(ours) > 0
    assert ours == theirs


def test_every_query_has_sql():
    """Those on training text are tested in a folder of their own."""
    assert set(entry_points.QUERIES) == set(entry_points.ORACLE_SQL)


def test_entry(spark):
    frame = entry_points.entry(spark)
    assert frame.columns[:2] == ["datum", "drzava"]
    assert frame.count() > 0
