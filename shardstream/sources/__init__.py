"""Where records and tables come from."""

from shardstream.sources.commits import adopt_batches, compact_log, read_index
from shardstream.sources.record_log import read_log, record_stream
from shardstream.sources.tables import read_csv_with_header

__all__ = ["adopt_batches", "compact_log", "read_csv_with_header", "read_index", "read_log", "record_stream"]
