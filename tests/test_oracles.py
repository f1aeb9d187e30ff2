"""Every registered query against its SQL on the given tables."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry
from shardstream.plans import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in sorted(Path(SF_DIR).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, tables, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = tables.execute(ORACLES[name])
    expected_columns = [column[0] for column in expected.description]
    assert result.columns == expected_columns
    rows = Counter(map(tuple, result.collect()))
    assert rows == Counter(expected.fetchall())
    assert rows


def test_entry_has_a_stable_schema(spark):
    assert entry(spark).schema.simpleString() == "struct<value:string>"
