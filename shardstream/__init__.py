"""Sharded record streams on Spark: consume, query and append."""

from shardstream.model import INDEX, LATEST, POSITIONS, RECORD, TRIM_HORIZON, Handler
from shardstream.operators import (
    advance,
    batch_stats,
    decode_records,
    list_streams,
    microbatch_counts,
    number_records,
    positions_with_new_shards,
    preview,
    put_records,
    read_page,
    read_records,
    route_records,
    shard_inventory,
    shard_positions,
    union_streams,
)
from shardstream.sources import adopt_batches, compact_log, read_csv_with_header, read_index, read_log, record_stream
from shardstream.streaming import (
    await_consumers,
    compose,
    consume,
    dispatch,
    log_stats,
    print_preview,
    put_sink,
    stop_between_batches,
    text_sink,
)

__all__ = [
    "INDEX",
    "LATEST",
    "POSITIONS",
    "RECORD",
    "TRIM_HORIZON",
    "Handler",
    "adopt_batches",
    "advance",
    "await_consumers",
    "batch_stats",
    "compact_log",
    "compose",
    "consume",
    "decode_records",
    "dispatch",
    "list_streams",
    "log_stats",
    "microbatch_counts",
    "number_records",
    "positions_with_new_shards",
    "preview",
    "print_preview",
    "put_records",
    "put_sink",
    "read_csv_with_header",
    "read_index",
    "read_log",
    "read_page",
    "read_records",
    "record_stream",
    "route_records",
    "shard_inventory",
    "shard_positions",
    "stop_between_batches",
    "text_sink",
    "union_streams",
]
