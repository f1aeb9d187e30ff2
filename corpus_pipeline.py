"""The corpus pipeline: quality rules, near-dedup, passage dedup, surrogates, packing.

Each stage takes ``(spark, docs, sf_dir)`` and gives a DataFrame that is written as
Parquet and read again as the next stage's ``docs``. All but the last keep the columns of
``documents``; rows without an id go through like others where a stage does not say so.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardstream.llm import minhash, packing, pii, rules, substrings
from shardstream.llm.columns import own, unused
from shardstream.shared import pin


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep. A verdict depends on the text alone and is joined by
    it, so each row gets its own, also without an id or with one that others share."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    key = unused(docs, "__key")
    rows = docs.withColumn(key, F.unhex(F.md5("text")))
    kept = rules.judge(rows, labels, more=(key,)).where("kept").select(key).distinct()
    return rows.join(pin(kept, "kept"), key, "left_semi").select(*map(own, docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return minhash.without_duplicates(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that repeat; what is left is joined by single spaces.

    Documents in which nothing repeats stay as they are. One of which nothing is left
    stays, with an empty text.
    """
    return substrings.cut_repeats(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data."""
    replaced = pii.replace_entities(docs).select(*map(own, docs.columns))
    return replaced.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of 4096 tokens."""
    pieces = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("surrogates", surrogates),
    ("packing", packed),
]

#: Learned rules, near-duplicate classes and keyed surrogates have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
