"""Operators on record DataFrames."""

from shardstream.operators.positions import (
    advance,
    list_streams,
    positions_with_new_shards,
    read_page,
    read_records,
    shard_inventory,
    shard_positions,
)
from shardstream.operators.puts import number_records, put_records, route_records
from shardstream.operators.streams import (
    batch_stats,
    decode_records,
    microbatch_counts,
    preview,
    union_streams,
)

__all__ = [
    "advance",
    "batch_stats",
    "decode_records",
    "list_streams",
    "microbatch_counts",
    "number_records",
    "positions_with_new_shards",
    "preview",
    "put_records",
    "read_page",
    "read_records",
    "route_records",
    "shard_inventory",
    "shard_positions",
    "union_streams",
]
