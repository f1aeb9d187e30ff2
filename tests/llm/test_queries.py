"""Every registered query of the subpackage and the pipeline, over whole small tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from shardstream.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "labels", "conversations")


def plain(rows):
    return sorted(str(sorted(row.items())) for row in rows)


def by_sql(sql):
    tables = duckdb.connect()
    for name in TABLES:
        tables.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return tables.sql(sql).to_arrow_table().to_pylist()


@pytest.mark.parametrize("name", [*QUERIES, "pipeline"])
def test_query(spark, name):
    found = [row.asDict(recursive=True) for row in entry.queries()[name](spark, SF_DIR).collect()]
    assert found
    if name in ORACLES:
        assert plain(found) == plain(by_sql(entry.oracle_sql()[name]))
