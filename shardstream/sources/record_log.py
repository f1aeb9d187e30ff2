"""Reading a landed record log, as a table and as a stream.

A log is the directory ``put_records`` writes:
``batch_id=N/stream=S/shard_id=K/*.parquet``. Stream and shard are partition
columns, so a reader of one stream or shard never opens the files of another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardstream import shared
from shardstream.model import LATEST, RECORD, TRIM_HORIZON, check_position
from shardstream.sources.commits import LAYOUT, read_commits, visible

#: The column that says which batch of which log a streamed record comes from.
BATCH_OF = "_batch"

#: Longer than any log is kept.
_ANY_AGE = "36500d"


def _of_stream(layout: DataFrame, stream: str | None) -> DataFrame:
    return layout if stream is None else layout.where(F.col("stream") == stream)


def read_log(spark: SparkSession, log_dir: str, stream: str | None = None) -> DataFrame:
    """The records committed so far, of one stream or of all, and the ``batch_id`` of each.

    The batch is a directory like stream and shard: pages prune by it. Of a batch without a
    commit, half in its place or not, nothing is read.
    """
    layout = spark.read.schema(LAYOUT).parquet(log_dir).where(visible(spark, log_dir))
    return _of_stream(layout, stream).select(*RECORD.fieldNames(), "batch_id")


def require_records(spark: SparkSession, log_dir: str, stream: str | None = None) -> None:
    """Refuse a log that is missing or holds no record; stops at the first record found."""
    if not shared.exists(spark, log_dir) or read_log(spark, log_dir, stream).isEmpty():
        raise ValueError(f"no records to consume in {log_dir} (stream: {stream or 'any'})")


def frozen_start(spark: SparkSession, log_dir: str, start: str) -> int:
    """The newest batch landed when the query first started, written down once."""
    if not shared.is_complete(spark, start):
        newest = spark.createDataFrame([(read_commits(spark, log_dir).newest,)], "after_batch bigint")
        newest.write.mode("overwrite").parquet(start)
    return spark.read.parquet(start).first()["after_batch"]


def record_stream(
    spark: SparkSession,
    log_dir: str,
    stream: str | None = None,
    *,
    position: str = TRIM_HORIZON,
    start: str | None = None,
    max_files: int | None = None,
    max_bytes: int | None = None,
    require_data: bool = True,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """A streaming DataFrame of records over all shards, also those that appear later.

    ``position="trim_horizon"`` starts at the oldest record kept. ``"latest"``
    starts behind the newest one: the batches landed by then are written to
    ``start``, which a restart reads back. Sequence numbers of a later batch lie
    above those of an earlier one, so skipping batches skips exactly the records
    below each shard's newest position, and as a partition filter it opens none
    of the backlog's files.

    Files count whatever their age, so the driver remembers the path of every file of the
    log; ``options={"maxFileAge": "30d"}`` bounds that where no older file can appear.
    Batches that ``compact_log`` expired are skipped, and their files listed no more once
    they are deleted.

    The column ``_batch`` names each record's log and batch. ``dispatch`` takes it off, and
    holds a micro-batch back until all its batches have a commit.

    ``max_files`` or ``max_bytes`` bounds a micro-batch; ``options`` go to Spark's
    file source as they are. With ``require_data=False`` an empty log is allowed
    and made where missing.
    """
    check_position(position)
    if require_data:
        require_records(spark, log_dir, stream)
    else:
        shared.make_directory(spark, log_dir)

    after_batch = read_commits(spark, log_dir).first_kept - 1
    if position == LATEST:
        if start is None:
            raise ValueError("position 'latest' needs a start path to remember its start in")
        after_batch = max(after_batch, frozen_start(spark, log_dir, start))

    # The file source skips files much older than the newest one it has seen; a copied or
    # restored log has such files.
    reader = spark.readStream.schema(LAYOUT).option("maxFileAge", _ANY_AGE).options(**(options or {}))
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    layout = _of_stream(reader.parquet(log_dir), stream)
    if after_batch >= 0:
        layout = layout.where(F.col("batch_id") > after_batch)
    return layout.select(*RECORD.fieldNames(), F.struct(F.lit(log_dir).alias("log"), "batch_id").alias(BATCH_OF))
