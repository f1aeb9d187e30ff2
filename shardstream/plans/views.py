"""Record views of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardstream import read_log, route_records
from shardstream.model import RECORD

#: Shards of every stream in the views.
SHARDS = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as records: a stream per event type, keyed by user."""
    events = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("stream"),
        F.col("event_id").alias("sequence_number"),
        "user_id",
        F.col("ts").alias("arrival_ts"),
        F.col("props").cast("binary").alias("data"),
    )
    return route_records(events, "user_id", SHARDS).select(RECORD.fieldNames())


def conversation_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` as records: a stream per role, keyed by conversation."""
    turns = table(spark, sf_dir, "conversations").select(
        F.col("role").alias("stream"),
        "conv_id",
        "turn",
        F.lit("2024-01-01").cast("timestamp_ntz").alias("arrival_ts"),
        F.col("text").cast("binary").alias("data"),
    )
    return route_records(turns, "conv_id", SHARDS)


def lineitem_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as records with six keys in all, so that few shards hold everything."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("stream"),
        "l_linestatus",
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        F.col("l_shipdate").alias("arrival_ts"),
        F.concat_ws("|", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
        .cast("binary")
        .alias("data"),
    )
    return route_records(lines, "l_linestatus", SHARDS)


def log_values(spark: SparkSession, log_dir: str) -> DataFrame:
    """Records of a log with the payload as text, in the columns the SQL side has."""
    names = [name for name in RECORD.fieldNames() if name != "data"]
    return read_log(spark, log_dir).select(*names, F.col("data").cast("string").alias("value"))
