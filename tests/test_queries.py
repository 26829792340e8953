"""Every registered query against its SQL on the small tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_module

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    yield connection
    connection.close()


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def ordered(rows):
    return sorted((tuple(normal(v) for v in row) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    frame = entry_module.queries()[name](spark, FOLDER)
    relation = duck.sql(entry_module.oracle_sql()[name])
    assert sorted(frame.columns) == sorted(relation.columns)
    columns = sorted(frame.columns)
    actual = ordered(tuple(row) for row in frame.select(*columns).collect())
    wanted = ordered(relation.select(*[f'"{c}"' for c in columns]).fetchall())
    assert len(actual) == len(wanted) > 0
    for mine, theirs in zip(actual, wanted):
        assert mine == theirs


def test_entry(spark):
    frame = entry_module.entry(spark)
    assert {row.op for row in frame.collect()} == {"insert", "update", "unchanged", "delete"}
