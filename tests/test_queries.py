"""A cross-section of the registered queries against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as driver

FOLDER = "/root/testdata/sf0.001"
NAMES = [
    "q_build_sessions", "q_split_sessions", "q_item_features", "q_user_features",
    "q_ranking_features_test", "q_cooc_recs", "q_compare_systems", "q_slice_systems",
    "q_error_summary", "q_embedding_recs", "q_build_sessions_sparse_sliced", "q_cooc_recs_sparse_heads",
    "q_embedding_recs_blocks", "q_stages_reloaded", "q_evaluate_retrieval",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no benchmark tables")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for name in ("events", "orders", "lineitem", "part", "embeddings", "customer"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, tables, name):
    got = driver.queries()[name](spark, FOLDER)
    expected = tables.sql(driver.oracle_sql()[name])
    columns = sorted(got.columns)
    assert columns == sorted(expected.columns)
    quoted = ", ".join(f'"{c}"' for c in columns)
    theirs = tables.sql(f"SELECT {quoted} FROM ({expected.sql_query()})").fetchall()
    ours = [tuple(row[c] for c in columns) for row in got.collect()]
    assert sorted(ours, key=str) == sorted(theirs, key=str)


def test_every_oracle_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
