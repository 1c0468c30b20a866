"""Queries with SQL against that SQL, on the smallest tables and on odd rows."""

import random
from collections import Counter

import duckdb
import pytest

from tidemark.llm import licenses, queries, secret_scan

FOLDER = "/root/testdata/sf0.001"
OPERATORS = {"op1_license_scan": licenses.scan, "op7_secret_scan": secret_scan.scan}


def _by_sql(key, documents):
    connection = duckdb.connect()
    connection.register("documents", documents)
    found = connection.execute(queries.ORACLES[key])
    names = [c[0] for c in found.description]
    return names, Counter(tuple(r[names.index(c)] for c in sorted(names)) for r in found.fetchall())


def _same(df, key, documents):
    names, want = _by_sql(key, documents)
    assert sorted(df.columns) == sorted(names)
    assert Counter(tuple(r[c] for c in sorted(names)) for r in df.collect()) == want


@pytest.mark.parametrize("key", sorted(OPERATORS))
def test_query_equals_sql(spark, key):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").toArrow()
    _same(queries.QUERIES[key](spark, FOLDER), key, documents)


def _made_up(rng):
    """Texts of phrases, notices, keys and examples in between."""
    key = lambda: "".join(rng.choice("aZ3kP9xQ7vLm2RtY8sWd4BnC+/") for _ in range(rng.randint(15, 45)))
    notice = lambda: " ".join(w if rng.random() > 0.08 else "thing" for w in rng.choice(licenses.TEMPLATES)[1].split())
    made = [
        lambda: rng.choice(licenses.PHRASES)[0], notice, key, lambda: f"EXAMPLE_KEY={key()}", lambda: f"2024-01-01-{key()}", lambda: f"2024-01-01example{key()}",
        lambda: f"{key()}/xxxx/{key()}", lambda: f"password: \"{key()}\"", lambda: f"AKIA{key().upper()}", lambda: "0a1b" * rng.randint(4, 9), lambda: "é Größe, word",
        lambda: " ".join(["the of license"] * rng.randint(1, 60)), lambda: "123e4567-e89b-12d3-a456-426614174000",
    ]
    return " ".join(rng.choice(made)() for _ in range(rng.randint(0, 12)))


@pytest.mark.parametrize("key", sorted(OPERATORS))
def test_operator_equals_sql_on_odd_rows(spark, make_docs, odd_docs, key):
    rng = random.Random(8)
    docs = odd_docs.unionByName(make_docs([(1000 + k // 2, _made_up(rng)) for k in range(300)]))
    _same(OPERATORS[key](docs), key, docs.select("doc_id", "text").toArrow())


def test_templates_longer_than_a_block(make_docs):
    long = " ".join(f"clause{k}" for k in range(200))
    texts = [f"{'x ' * k}{long} tail" for k in (0, 50, 130, 333)] + [long.replace("clause7", "other"), " ".join(long.split()[:150])]
    found = licenses.scan(make_docs(list(enumerate(texts))), templates=(("own", long),)).collect()
    assert {r.doc_id: r.labels for r in found} == {0: "own", 1: "own", 2: "own", 3: "own", 4: "own", 5: ""}
