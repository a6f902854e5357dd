"""Queries on tables in which one key, text, page or vector holds a third of the rows."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.compare import TABLES, difference

SOURCE = "/root/testdata/sf0.001"

# What is put in place of the columns in every third row.
HOT = {
    "orders": {"o_orderkey": "7", "o_custkey": "42", "o_orderpriority": "'5-LOW'"},
    "lineitem": {"l_orderkey": "7", "l_partkey": "11", "l_quantity": "3.0"},
    "events": {"user_id": "5", "event_type": "'error'"},
    "documents": {"text": "(SELECT text FROM t ORDER BY n_chars DESC, doc_id LIMIT 1)", "source": "'src0'"},
    "pages": {"html": "(SELECT html FROM t ORDER BY length(html) DESC, page_id LIMIT 1)"},
    "embeddings": {"embedding": "(SELECT embedding FROM t WHERE vec_id = 1)"},
}

QUERIES = """
join_inner join_self filter_in_set group_count group_avg sum_by_key regex_grep_count subtract_rows
set_difference orphan_tables latest_version vector_top_k stem_vocab text_stages vocabulary count_vectors
topic_hits staged_topic_run isotonic naive_bayes als kmeans glm_gaussian ks_test
""".split()


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    out = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE OR REPLACE TABLE t AS SELECT *, row_number() OVER () AS place FROM '{SOURCE}/{name}.parquet'")
        hot = ", ".join(f"CASE WHEN place % 3 = 0 THEN {v} ELSE {c} END AS {c}" for c, v in HOT.get(name, {}).items())
        replaced = f" REPLACE ({hot})" if hot else ""
        con.execute(f"COPY (SELECT * EXCLUDE (place){replaced} FROM t) TO '{out}/{name}.parquet' (FORMAT parquet)")
    return str(out)


@pytest.mark.parametrize("name", QUERIES)
def test_skewed(spark, folder, name):
    assert difference(entry.queries()[name](spark, folder), folder, entry.oracle_sql()[name]) is None
