"""The pipeline's stages, each judged on its own input."""

from __future__ import annotations

import corpus_pipeline


def test_stages(spark, docs, labels, folder):
    sf_dir = f"{folder}/tables"
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{sf_dir}/documents.parquet")
    labels.write.parquet(f"{sf_dir}/labels.parquet")
    given, sizes = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, given, sf_dir).write.parquet(f"{folder}/{name}")
        made = spark.read.parquet(f"{folder}/{name}")
        assert made.columns == given.columns
        given = made
        sizes.append(made.count())
    rows = {r.doc_id: r.text for r in given.collect()}
    assert sizes[0] > sizes[1] == sizes[2] == sizes[3] == len(rows)
    assert not any("###" in text for text in rows.values())
    assert 45 in rows and not {46, 47, 48, 49, 50} & rows.keys()  # one of the near copies
    pieces = corpus_pipeline.run(spark, sf_dir).collect()
    assert {p.doc_id for p in pieces} == rows.keys()
    assert all(sum(q.length for q in pieces if q.doc_id == p.doc_id) == p.doc_tokens for p in pieces[:20])


def test_quality_rules_judge_each_row(spark, docs, labels, texts, folder):
    labels.write.parquet(f"{folder}/labels.parquet")
    clean, other = texts[1][0], texts[2][0]
    more = [(None, clean, "en", "new", 1), (7, other, "en", "new", 1), (7, "too short", "en", "new", 1), (None, None, None, "new", 0)]
    given = docs.select("doc_id", "text", "lang", "source", "n_chars")
    given = given.unionByName(spark.createDataFrame(more, given.schema))
    kept = corpus_pipeline.quality_rules(spark, given, folder).where("doc_id IS NULL OR doc_id = 7").collect()
    assert {(r.doc_id, r.text) for r in kept} == {(None, clean), (7, other), (7, texts[7][0])} and len(kept) == 3


def test_stages_take_empty_tables(spark, empty, labels, folder):
    empty.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
