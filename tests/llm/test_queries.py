"""Registered queries against their SQL, or their contract, on the smallest test tables."""

import hashlib
import re

import duckdb
import pytest

from lexiloom.llm.queries import ORACLE, QUERIES, RULES

SF_DIR = "/root/testdata/sf0.001"
#: Columns that the query's result must have, in types that SQL also names.
COLUMNS = {
    "op2_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op3_secrets": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
    "op4_decontamination": {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean"},
    "op5_url_filter": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op6_embedding_dedup": {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op7_warc": {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"},
    "op8_substring_dedup": {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
    "op1_line_dedup": {"doc_id": "bigint", "line_nr": "int", "keeper_id": "bigint", "keeper_line_nr": "int", "kept": "boolean"},
    "op11_hard_negatives": {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"},
    "op12_personal_data": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string"},
    "op13_ranked_search": {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"},
    "op10_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
}


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    return con


def rows(found):
    return sorted(map(str, found))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, con, name):
    result = QUERIES[name](spark, SF_DIR)
    names = ", ".join(f'"{x}"' for x in result.columns)
    theirs = con.execute(f"SELECT {names} FROM ({ORACLE[name]})").fetchall()
    assert rows(tuple(r) for r in result.collect()) == rows(theirs)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    types = dict(QUERIES[name](spark, SF_DIR).dtypes)
    assert {k: types.get(k) for k in COLUMNS[name]} == COLUMNS[name]


def test_secret_spans(spark):
    # The smallest tables hold no secret.
    larger = "/root/testdata/sf0.01"
    texts = dict(duckdb.connect().execute(f"SELECT doc_id, text FROM read_parquet('{larger}/documents.parquet')").fetchall())
    found = QUERIES["op3_secrets"](spark, larger).collect()
    assert len(found) == len(texts) and any(r.spans for r in found)
    for r in found:
        spans = [s.split(":") for s in r.spans.split(",")] if r.spans else []
        base = ",".join(":".join(s) for s in spans if s[0] != "random")
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        for kind, start, end in spans:
            part = texts[r.doc_id][int(start) : int(end)]
            assert kind != "hex" or re.fullmatch("[0-9a-f]{32,}", part)
            assert kind != "access" or re.fullmatch("AKIA[A-Z0-9]{12,}", part)


def test_url_rules(spark, con):
    found = QUERIES["op5_url_filter"](spark, SF_DIR).collect()
    assert len(found) == con.execute("SELECT count(*) FROM pages").fetchall()[0][0]
    verdicts = {h + p: v for v, h, p in RULES}
    assert all(r.verdict == verdicts[r.rule] if r.rule else r.verdict in ("allow", "block") for r in found)
