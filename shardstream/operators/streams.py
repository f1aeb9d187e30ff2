"""Operators on a stream or on one of its batches."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardstream.functions import decode


def union_streams(streams: Iterable[DataFrame]) -> DataFrame:
    """All records of several streams, copies kept, in no order across streams."""
    streams = list(streams)
    if not streams:
        raise ValueError("nothing to union")
    return reduce(DataFrame.unionByName, streams)


def decode_records(records: DataFrame, on_error: str = "replace") -> DataFrame:
    """Replace the payload ``data`` by its text ``value``."""
    return records.withColumn("data", decode(F.col("data"), on_error)).withColumnRenamed(
        "data", "value"
    )


def preview(records: DataFrame, n: int, order_by: list[str] | None = None) -> DataFrame:
    """The first ``n`` records.

    Without ``order_by`` these are the first in partition order, and Spark reads
    only as many partitions as it needs. With it the answer is fixed, as a top-n
    that keeps n rows per task and sorts nothing else.
    """
    return (records.orderBy(*order_by) if order_by else records).limit(n)


def batch_stats(records: DataFrame) -> DataFrame:
    """One row: the number of ``records`` and of ``partitions``, empty ones included.

    How many partitions there are shows only once the shuffles before them have run:
    persist records that come out of one.
    """
    partitions = records.rdd.getNumPartitions()
    return records.agg(F.count("*").alias("records")).withColumn("partitions", F.lit(partitions))


def microbatch_counts(records: DataFrame, interval: str) -> DataFrame:
    """Records per batch interval of a landed log; intervals without records are absent."""
    return (
        records.groupBy(F.window("arrival_ts", interval).alias("batch"))
        .agg(F.count("*").alias("records"))
        .select(F.col("batch.start").alias("batch_start"), "records")
    )
