"""Every named query on the smallest tables against its SQL twin (the models have none)."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, canonical
from stayloom.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"
SLOW = {"model_comparison", "fact_prediction"}


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return connection


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query(spark, db, name):
    df = queries()[name](spark, FOLDER)
    cursor = db.execute(oracle_sql()[name])
    want = canonical(cursor.fetchall(), [d[0] for d in cursor.description])
    assert canonical([tuple(r) for r in df.collect()], df.columns) == want


def test_entry(spark):
    assert entry(spark).count() > 0


def test_only_models_lack_a_twin():
    assert set(QUERIES) - set(oracle_sql()) == SLOW
