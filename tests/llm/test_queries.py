"""The registered queries against DuckDB, and as the driver's contract wants them."""

from collections import Counter

import duckdb
import pyarrow.dataset as ds
import pytest

import __spark_entry__ as driver
from sessionrank.llm.oracles import ORACLES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        connection.register(table, ds.dataset(f"{FOLDER}/{table}.parquet").to_table())
    got = driver.queries()[name](spark, FOLDER)
    expected = connection.sql(driver.oracle_sql()[name])
    columns = sorted(got.columns)
    assert columns == sorted(expected.columns)
    theirs = connection.sql(f"SELECT {', '.join(columns)} FROM ({expected.sql_query()})").fetchall()
    assert Counter(tuple(r[c] for c in columns) for r in got.collect()) == Counter(theirs)


def test_all_operators_and_the_pipeline_are_registered():
    names = [n for n in driver.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in driver.queries()
