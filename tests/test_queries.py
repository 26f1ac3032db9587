"""Every registered query against its SQL, run by DuckDB on the same files."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_points

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        path = f"{FOLDER}/{name}.parquet"
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    frame = entry_points.queries()[name](spark, FOLDER)
    relation = duck.sql(entry_points.oracle_sql()[name])
    assert sorted(frame.columns) == sorted(relation.columns)
    got = _rows(frame.columns, [tuple(row) for row in frame.collect()])
    expected = _rows(relation.columns, relation.fetchall())
    assert sum(got.values()) == sum(expected.values())
    assert got == expected


def test_every_query_of_the_jobs_has_sql():
    without = set(entry_points.queries()) - set(entry_points.oracle_sql())
    assert not {name for name in without if name.startswith("q_")}


def test_entry(spark):
    frame = entry_points.entry(spark)
    assert frame.columns[-2:] == ["avg_weight", "avg_height"]
    assert not frame.isEmpty()
