"""Every query against its SQL counterpart on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from tidewatch.plans.oracles import ORACLES
from tidewatch.plans.queries import all_queries


@pytest.fixture(scope="module")
def duck(folder):
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_every_query_has_a_counterpart():
    assert set(all_queries()) == set(ORACLES)
    assert set(all_queries()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(name, spark, folder, duck):
    frame = entry_points.queries()[name](spark, folder)
    relation = duck.sql(entry_points.oracle_sql()[name])
    expected = _plain(relation.columns, relation.fetchall())
    assert _plain(frame.columns, [tuple(r) for r in frame.collect()]) == expected
    assert expected[1]


def test_entry(spark):
    assert entry_points.entry(spark).limit(1).count() == 1
