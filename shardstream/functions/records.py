from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decode(data: Column, on_error: str = "replace") -> Column:
    """Payload bytes as text, always read as UTF-8.

    ``replace`` puts U+FFFD in the place of bad bytes and never fails; ``fail``
    raises on the first bad record and so stops the query that runs it.
    """
    if on_error == "replace":
        return F.make_valid_utf8(data.cast("string"))
    if on_error == "fail":
        return F.decode(data, "UTF-8")
    raise ValueError(f"on_error must be 'replace' or 'fail', not {on_error!r}")


def shard_of(partition_key: Column, shards: int) -> Column:
    """Shard a key belongs to: the first 32 bits of its MD5, modulo the shard count."""
    if shards < 1:
        raise ValueError(f"a stream has at least one shard, not {shards}")
    hashed = F.conv(F.substring(F.md5(partition_key.cast("binary")), 1, 8), 16, 10)
    return F.pmod(hashed.cast("bigint"), F.lit(shards)).cast("int")


def required(value: Column, message: str) -> Column:
    """The value itself; a null one fails the job with ``message``."""
    return F.when(value.isNull(), F.raise_error(F.lit(message))).otherwise(value)
