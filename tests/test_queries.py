"""Every registered query beside its SQL on the smallest data."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from webtext.plans import registry

# The library's own queries as the entry registers them; those of the llm subpackage have tests of their own.
QUERIES = {name: query for name, query in contract.queries().items() if name in registry.QUERIES}
SQL = {name: statement for name, statement in contract.oracle_sql().items() if name in registry.SQL}
ROWS_ONLY = {"word2vec_vectors", "logreg_predictions", "tfidf_logreg_predictions"}


@pytest.fixture(scope="module")
def db(data):
    connection = duckdb.connect()
    for file in Path(data).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def ordered(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([repr(row[i]) for i in order] for row in rows)


def test_all_but_the_trained_models_have_sql():
    assert set(QUERIES) - set(SQL) == ROWS_ONLY and set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, db, data, name):
    frame = QUERIES[name](spark, data)
    expected = db.sql(SQL[name])
    assert sorted(frame.columns) == sorted(expected.columns)
    ours = ordered(frame.columns, [tuple(r) for r in frame.collect()])
    assert ours == ordered(expected.columns, expected.fetchall())


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_trained_models_give_rows(spark, data, name):
    assert QUERIES[name](spark, data).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() == 50
