"""The registered queries: columns, whole tables, and SQL where there is some."""
import math

import duckdb
import pytest

import __spark_entry__ as E
from clipstar.llm import queries

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op2": ["doc_id", "quality_score", "toxic_score", "kept"],
    "op3": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op4": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op5": ["doc_id", "fingerprint", "component_id"],
    "op6": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op7": ["page_id", "host", "path", "rule", "verdict"],
    "op8": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op9": ["doc_id", "held_out", "lang_pred", "score"],
    "op10": ["doc_id", "item_id", "containment"],
    "op11": ["lang", "rank", "phrase", "a", "l", "r", "n", "score"],
    "op12": ["vec_id", "n_links", "component_id", "kept"],
    "op13": ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"],
}


def by_number():
    return {name.split("_")[0]: name for name in queries.QUERIES}


def test_all_are_registered():
    assert by_number().keys() == COLUMNS.keys()
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries())


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(round(r[i], 6) if isinstance(r[i], float) and not math.isnan(r[i]) else r[i] for i in order)
                   for r in rows), key=repr)


@pytest.mark.parametrize("number", sorted(COLUMNS))
def test_query(spark, number):
    name = by_number()[number]
    df = queries.QUERIES[name](spark, SF)
    assert df.columns[:len(COLUMNS[number])] == COLUMNS[number] or set(COLUMNS[number]) <= set(df.columns)
    got = df.collect()
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    key = df.columns[0]
    table = {"page_id": "pages", "vec_id": "embeddings"}.get(key, "documents")
    if number not in ("op10", "op11", "op13"):
        ids = {r[0] for r in con.execute(f"SELECT {key} FROM {table}").fetchall()}
        assert {r[key] for r in got} == ids
        if number != "op6":
            assert len(got) == len(ids)
    if name in queries.ORACLE:
        res = con.execute(queries.ORACLE[name])
        cols = [d[0] for d in res.description]
        assert sorted(cols) == sorted(df.columns)
        assert canon(df.columns, [tuple(r) for r in got]) == canon(cols, res.fetchall())
