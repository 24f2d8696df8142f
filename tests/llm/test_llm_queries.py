"""The registered queries on the smallest tables, against their SQL where there is one."""

from pathlib import Path

import pytest

from checks.compare import normalised, spark_rows, sql_rows
from delayworks.llm.oracles import ORACLE_SQL
from delayworks.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_projection_forest": ["vec_id", "n_links", "component_id", "kept"],
    "op2_line_frequency": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op3_surrogates": ["doc_id", "text", "n_entities"],
    "op4_main_text": ["page_id", "url", "text", "n_chars"],
    "op5_simhash": ["doc_id", "fingerprint", "component_id"],
    "op6_bloom_cascade": ["page_id", "host", "path", "rule", "verdict"],
    "op7_subword_quality": ["doc_id", "held_out", "score", "predicted"],
    "op8_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op9_weak_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op10_water_filling": ["doc_id", "size", "source_size", "target", "taken"],
    "op11_periodic_runs": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
    "op12_signature_search": ["item_id", "rank", "doc_id", "score"],
    "op13_exact_stream": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "pipeline": ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"],
}

pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables")


def test_all_are_registered():
    assert QUERIES.keys() == COLUMNS.keys() and ORACLE_SQL.keys() < QUERIES.keys()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL) - {"pipeline"}))
def test_rows_and_columns(spark, name):
    rows = QUERIES[name](spark, SMALL)
    key, table = ("vec_id", "embeddings") if name.startswith("op1_") else ("page_id", "pages") if name.startswith("op4_") else ("doc_id", "documents")
    assert set(COLUMNS[name]) <= set(rows.columns)
    ids = sorted(r[0] for r in spark.read.parquet(f"{SMALL}/{table}.parquet").select(key).collect())
    assert sorted(r[0] for r in rows.select(key).collect()) == ids


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    columns, rows = spark_rows(QUERIES[name](spark, SMALL))
    sql_columns, expected = sql_rows(SMALL, ORACLE_SQL[name])
    assert set(COLUMNS[name]) <= set(columns) and sorted(columns) == sorted(sql_columns)
    assert normalised(columns, rows) == normalised(sql_columns, expected)
