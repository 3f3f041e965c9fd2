"""The registered queries: columns, whole tables, and SQL where there is any."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registered
from shelfmatch.llm.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
#: What each query must return, and the table it returns a row of each for (None: another number of rows).
CONTRACT = {
    "op1_language": ("documents", {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"}),
    "op2_url_filter": ("pages", {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"}),
    "op3_decontaminate": (None, {"doc_id": "bigint", "item_id": "bigint", "start": "bigint", "stop": "bigint", "edits": "bigint"}),
    "op4_license_scan": ("documents", {"doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint",
                                       "base_labels": "string", "labels": "string", "score": "double"}),
    "op5_toxicity": ("documents", {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}),
    "op6_packing": (None, {"doc_id": "bigint", "sequence": "string", "capacity": "bigint", "n_tokens": "bigint"}),
    "op7_digest": ("documents", {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string",
                                 "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"}),
    "op8_token_count": ("documents", {"doc_id": "bigint", "n_tokens": "bigint"}),
    "op9_suffix_dedup": ("documents", {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"}),
    "op10_simhash": ("documents", {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"}),
    "op11_periodic_runs": ("documents", {"doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint",
                                         "exponent_milli": "bigint", "runs_sha256": "string", "collapsed_sha256": "string"}),
    "op12_merkle": ("documents", {"doc_id": "bigint", "leaf": "string", "subroot": "string", "root": "string", "proof_sha256": "string",
                                  "folded_root": "string", "verified": "boolean"}),
    "op13_exact_dedup": ("documents", {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"}),
    "pipeline": (None, {"doc_id": "bigint", "sequence": "string"}),
}


def test_all_and_the_pipeline_are_registered():
    assert set(CONTRACT) == set(QUERIES) | {"pipeline"} <= set(registered.queries())
    assert set(ORACLES) <= set(registered.oracle_sql())


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_columns_and_rows(llm, name):
    table, columns = CONTRACT[name]
    out = registered.queries()[name](llm, DATA)
    assert {c: k for c, k in out.dtypes if c in columns} == columns
    rows = out.collect()
    assert rows
    if table:
        key = "page_id" if table == "pages" else "doc_id"
        given = llm.read.parquet(f"{DATA}/{table}.parquet").select(key).collect()
        assert sorted(r[key] for r in rows) == sorted(r[key] for r in given)
    for r in rows:
        assert all(0 <= r[c] <= 1 and not math.isnan(r[c]) for c, k in columns.items() if k == "double")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(llm, name):
    duck = duckdb.connect()
    for file in Path(DATA).glob("*.parquet"):
        duck.execute(f"create view {file.stem} as select * from '{file}'")
    cursor = duck.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(map(tuple, QUERIES[name](llm, DATA).select(*columns).collect()), key=str) == sorted(cursor.fetchall(), key=str)
