"""Column expressions on record fields; all run inside the JVM."""

from shardstream.functions.records import decode, required, shard_of

__all__ = ["decode", "required", "shard_of"]
