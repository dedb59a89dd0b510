"""The registered queries on the smallest tables: against their SQL twins, or for their shape where there is none."""

import zlib

import duckdb
import pytest

from check import TABLES, canonical
from stayloom.llm.oracle import ORACLES
from stayloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    "op3_secrets": {"doc_id", "path", "start", "length", "value_sha256", "kind", "score"},
    "op4_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op7_packing": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "queue"},
    "op9_pii": {"doc_id", "text", "n_replaced", "kinds"},
    "op10_language_id": {"doc_id", "held_out", "lang_pred", "score", "shares"},
    "op11_golay": {"doc_id", "fingerprint", "component_id"},
    "op13_whitening": {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"},
}


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return connection


def test_one_query_for_each_operator():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))
    assert set(ORACLES) | set(COLUMNS) == set(QUERIES) and not set(ORACLES) & set(COLUMNS)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    cursor = db.execute(ORACLES[name])
    want = canonical(cursor.fetchall(), [d[0] for d in cursor.description])
    assert canonical([tuple(r) for r in df.collect()], df.columns) == want


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_shape(spark, name):
    rows = QUERIES[name](spark, FOLDER).collect()
    assert rows == [] and name == "op3_secrets" or set(rows[0].asDict()) == COLUMNS[name]
    if name in ("op4_toxicity", "op9_pii", "op10_language_id"):
        ids = [r[0] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").collect()]
        assert sorted(r.doc_id for r in rows) == sorted(ids)
    if name in ("op4_toxicity", "op10_language_id"):
        n, rest = (5, 0) if name == "op4_toxicity" else (3, 1)
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % n == rest) and 0 <= r.score <= 1 for r in rows)
