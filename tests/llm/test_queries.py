"""The registered queries on the small tables: DuckDB statements, columns, whole results."""

import duckdb
import pytest

from dosewise.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": ["doc_id", "fingerprint", "component_id"],
    "op2": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op3": ["query_id", "rank", "vec_id", "score"],
    "op4": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_markov"],
    "op5": ["doc_id", "item_id", "start", "end", "edits"],
    "op6": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op7": ["doc_id", "text"],
    "op8": ["doc_id", "expected_grade", "tail_probability", "selected"],
    "op9": ["page_id", "host", "path", "rule", "verdict"],
    "op10": ["doc_id", "held_out", "score", "predicted"],
    "op11": ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"],
    "op12": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op13": ["doc_id", "n_features", "weight", "score", "rank"],
}
EVERY_DOCUMENT = ("op1", "op4", "op6", "op8", "op10", "op11", "op12", "op13")


def test_one_query_for_each_operator():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_and_rows(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    number = name.split("_")[0]
    assert df.columns == COLUMNS[number]
    rows = [tuple(r) for r in df.collect()]
    documents = {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    if number in EVERY_DOCUMENT:
        assert len(rows) == len(documents) and {r[0] for r in rows} == documents
    elif number == "op2":
        assert {r[0] for r in rows} == documents
    if name in ORACLES:
        duck = duckdb.connect()
        for table in ("documents", "pages", "benchmark"):
            duck.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
        found = duck.execute(ORACLES[name])
        names = [c[0] for c in found.description]
        assert sorted(names) == sorted(df.columns)
        expected = [tuple(r[names.index(c)] for c in df.columns) for r in found.fetchall()]
        assert sorted(map(str, rows)) == sorted(map(str, expected))
