"""Every registered query against its SQL on the smallest data set."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_points
from tidemark.plans import registered

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
QUERIES, ORACLES = registered.QUERIES, registered.ORACLES


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def _sorted_rows(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    plain = lambda v: "nan" if isinstance(v, float) and math.isnan(v) else v
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=str)


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    # fitted trees have no SQL; each of these has a companion that checks its rows, counts and ranges
    assert set(QUERIES) - set(ORACLES) == {"churn_model_scores", "model_comparison", "permutation_importance"}
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_sql(spark, duck, key):
    got = QUERIES[key](spark, FOLDER)
    expected = duck.execute(ORACLES[key])
    names = [c[0] for c in expected.description]
    assert sorted(got.columns) == sorted(names)
    assert _sorted_rows(got.collect(), got.columns) == _sorted_rows(expected.fetchall(), names)


def test_model_scores(spark):
    rows = QUERIES["churn_model_scores"](spark, FOLDER).collect()
    assert rows and all(0 <= r.score <= 1 for r in rows)


def test_entry(spark):
    assert entry_points.entry(spark).count() == 150
