"""Consuming a stream batch by batch."""

from shardstream.streaming.consume import await_consumers, consume, dispatch, stop_between_batches
from shardstream.streaming.handlers import compose, log_stats, print_preview
from shardstream.streaming.sinks import put_sink, text_sink

__all__ = [
    "await_consumers",
    "compose",
    "consume",
    "dispatch",
    "log_stats",
    "print_preview",
    "put_sink",
    "stop_between_batches",
    "text_sink",
]
