"""Handlers that write a batch, each batch once however often it is replayed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardstream.functions import required
from shardstream.model import Handler
from shardstream.operators import put_records, route_records
from shardstream.operators.puts import ROWS_PER_TASK


def text_sink(directory: str, files: int | None = None, column: str = "value") -> Handler:
    """Write each batch as text, one line per record, to ``directory/batch_id=N``.

    A replay overwrites its own directory. ``files`` bounds the number of files by
    merging partitions without a shuffle; that many tasks then do the writing, so
    1 is for small batches only. By default every partition writes its own file.
    A null text fails the batch; a line break within a text makes two lines.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        lines = batch.select(required(F.col(column), "cannot write a null text").alias(column))
        if files is not None:
            lines = lines.coalesce(files)
        lines.write.mode("overwrite").text(f"{directory}/batch_id={batch_id}")

    return handle


def put_sink(
    log_dir: str,
    shards: int,
    key: Column | str = "partition_key",
    order_by: list[Column | str] | None = None,
    *,
    rows_per_task: int = ROWS_PER_TASK,
) -> Handler:
    """Route each batch to the shards of another log and land it there.

    The batches have to be raw (``decode_errors=None``) or carry ``value``, whose
    UTF-8 bytes then become the payload. Lower ``rows_per_task`` for large payloads.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        if "data" not in batch.columns:
            batch = batch.withColumn("data", F.col("value").cast("binary"))
        routed = route_records(batch, key, shards)
        put_records(routed, log_dir, batch_id, order_by, rows_per_task=rows_per_task)

    return handle
