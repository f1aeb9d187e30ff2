"""Small hand-made records, and the brute-force answers to compare with."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from datetime import datetime, timedelta

from pyspark.sql import types as T

from shardstream import POSITIONS, RECORD

EPOCH = datetime(2024, 1, 1)


def records(spark, rows):
    """Records from ``(stream, shard_id, sequence_number)`` or full tuples."""
    full = [
        row if len(row) == 6 else (*row, f"k{row[1]}", EPOCH + timedelta(seconds=row[2] % 86400), b"x")
        for row in rows
    ]
    return spark.createDataFrame(full, RECORD)


def positions(spark, rows):
    return spark.createDataFrame(rows, POSITIONS)


UNROUTED = T.StructType(
    [field for field in RECORD if field.name not in ("shard_id", "sequence_number")]
)


def unrouted(spark, rows):
    """Records to put, from ``(stream, partition_key, seconds, payload)``."""
    return spark.createDataFrame(
        [(s, key, EPOCH + timedelta(seconds=t), data) for s, key, t, data in rows], UNROUTED
    )


def shard(key, shards):
    return int(hashlib.md5(key.encode()).hexdigest()[:8], 16) % shards


def numbered(rows, shards, base=0):
    """What a put has to number: ``(stream, shard_id, sequence_number, key, payload)``."""
    groups = defaultdict(list)
    for s, key, t, data in rows:
        groups[s, shard(key, shards)].append((t, key, hashlib.md5(data).hexdigest(), data))
    return sorted(
        (s, shard_id, base + place, key, data)
        for (s, shard_id), group in groups.items()
        for place, (_, key, _, data) in enumerate(sorted(group))
    )


def landed(log):
    rows = log.select("stream", "shard_id", "sequence_number", "partition_key", "data").collect()
    return sorted((*row[:4], bytes(row[4])) for row in rows)


def page(rows, start, limit):
    """The keys a read has to return, out of ``(stream, shard_id, sequence_number)`` rows."""
    result = []
    for (s, shard_id), first in start.items():
        unread = sorted(n for a, b, n in rows if (a, b) == (s, shard_id) and n >= first)
        result += [(s, shard_id, n) for n in unread[:limit]]
    return sorted(result)


def keys(df):
    return sorted(map(tuple, df.select("stream", "shard_id", "sequence_number").collect()))


def plan_of(df):
    """The physical plan with its pushed filters in full."""
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
