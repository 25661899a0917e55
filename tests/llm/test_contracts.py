"""Every registered query of the package gives the columns of its contract, and what has SQL equals it."""

import duckdb
import pytest

from corpusengine.llm.workload import ORACLES, QUERIES

COLUMNS = {
    1: "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    2: "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    3: "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    4: "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    6: "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    7: "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    8: "page_id bigint, url string, text string, n_chars bigint",
    9: "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    10: "doc_id bigint, held_out boolean, score double, predicted int",
    11: "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint",
    12: "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint",
    13: "doc_id bigint, held_out boolean, score double, predicted int",
}
ROWS = {1: "documents", 2: "documents", 3: "documents", 6: "embeddings", 7: "documents", 8: "pages", 9: "documents", 10: "documents", 13: "documents"}


@pytest.mark.parametrize("n", [*COLUMNS])
def test_query_keeps_its_contract(spark, sf, n):
    name = next(q for q in QUERIES if q.startswith(f"op{n}_"))
    result = QUERIES[name](spark, sf)
    kinds = dict(result.dtypes)
    wanted = dict(c.split() for c in COLUMNS[n].split(", "))
    assert {c: kinds.get(c) for c in wanted} == wanted
    rows = result.collect()
    if n in ROWS:
        assert len(rows) == spark.read.parquet(f"{sf}/{ROWS[n]}.parquet").count()
    if name in ORACLES:
        con = duckdb.connect()
        for table in ("documents", "labels"):
            con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
        names = ", ".join(f'"{c}"' for c in result.columns)
        assert sorted(map(tuple, rows)) == sorted(con.sql(f"SELECT {names} FROM ({ORACLES[name]})").fetchall())
