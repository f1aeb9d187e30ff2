"""The data model: records, read positions and batch handlers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: One record of a sharded stream. ``sequence_number`` is unique within
#: ``(stream, shard_id)`` and rises in arrival order.
RECORD = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("shard_id", T.IntegerType()),
        T.StructField("sequence_number", T.LongType()),
        T.StructField("partition_key", T.StringType()),
        T.StructField("arrival_ts", T.TimestampNTZType()),
        T.StructField("data", T.BinaryType()),
    ]
)

#: The first sequence number not yet read, per shard.
POSITIONS = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("shard_id", T.IntegerType()),
        T.StructField("next_sequence", T.LongType()),
    ]
)

#: What a commit says of a shard of its batch. Numbers within it have no gaps.
INDEX = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("stream", T.StringType()),
        T.StructField("shard_id", T.IntegerType()),
        T.StructField("records", T.LongType()),
        T.StructField("first_sequence", T.LongType()),
        T.StructField("last_sequence", T.LongType()),
        T.StructField("first_arrival", T.TimestampNTZType()),
        T.StructField("last_arrival", T.TimestampNTZType()),
        T.StructField("bytes", T.LongType()),
    ]
)

#: A shard is named by its stream and its id within the stream.
SHARD = ["stream", "shard_id"]

TRIM_HORIZON = "trim_horizon"
LATEST = "latest"

#: A batch handler: any function of ``(batch, batch_id)``; its result is ignored.
Handler = Callable[[DataFrame, int], None]


def check_position(position: str) -> None:
    """Refuse a start position other than the oldest or the newest record."""
    if position not in (TRIM_HORIZON, LATEST):
        raise ValueError(f"position must be {TRIM_HORIZON!r} or {LATEST!r}, not {position!r}")
