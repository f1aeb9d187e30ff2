"""Columns of a user's table that are named like an operator's own, or have dots."""

from __future__ import annotations

import pytest

import corpus_pipeline
from shardstream.llm import minhash, pii

ODD = ("__key", "__id", "__keep", "__new", "__names", "__entities", "a.b", "c`d", "__KEY_")


@pytest.fixture(scope="module")
def table(spark):
    words = " ".join(f"word{i}" for i in range(60))
    texts = [f"{words} ann@b.com", f"{words} ann@b.com", "Mr Bo Li, and Li.", "nothing here", "", None]
    rows = [(i, text, "en", "s", len(text or ""), *(f"{name}{i}" for name in ODD)) for i, text in enumerate(texts)]
    names = ", ".join(f"`{name.replace('`', '``')}` string" for name in ODD)
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {names}")


def kept_as_given(row):
    return all(row[name] == f"{name}{row['doc_id']}" for name in ODD)


def test_surrogates(table):
    found = pii.replace_entities(table)
    assert found.columns == [*table.columns, "__entities_"]
    rows = {row["doc_id"]: row for row in found.collect()}
    assert all(map(kept_as_given, rows.values()))
    assert [rows[i]["__entities_"] for i in range(6)] == [1, 1, 2, 0, 0, 0]
    assert "ann@" not in rows[0]["text"] and rows[3]["text"] == "nothing here" and rows[5]["text"] is None


def test_near_duplicates(table):
    found = minhash.without_duplicates(table)
    assert found.columns == table.columns
    rows = found.collect()
    assert all(map(kept_as_given, rows)) and sorted(row["doc_id"] for row in rows) == [0, 2, 3, 4, 5]


def test_stages_of_the_pipeline(spark, table, folder):
    spark.createDataFrame([(0, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs = table
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == table.columns, name
    rows = docs.collect()
    assert [row["doc_id"] for row in rows] == [0] and kept_as_given(rows[0])
