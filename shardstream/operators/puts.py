"""Appending records to a log: shard routing, numbering, landing."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardstream import shared
from shardstream.functions import required, shard_of
from shardstream.model import RECORD, SHARD
from shardstream.sources import commits

#: Sequence numbers set aside for one batch in every shard.
BATCH_SPAN = 1 << 32

#: The rows one task is to number at most; lower it for large payloads.
ROWS_PER_TASK = 1_000_000

#: The most ranges cut for that. Beyond it they grow in rows, since the blocks of a
#: shuffle grow with the square of its tasks; a shuffle set to more tasks has more.
MOST_RANGES = 20_000


def arrival_order() -> list[Column]:
    """The default order of the records of a batch within their shard.

    Total but for copies of a record. The payload counts by its digest, because
    cutting ranges takes a sample of the order columns to the driver.
    """
    return [F.col("arrival_ts"), F.col("partition_key"), F.md5("data")]


def route_records(records: DataFrame, key: Column | str, shards: int) -> DataFrame:
    """Add ``partition_key`` and the ``shard_id`` it hashes to; a null key fails the job."""
    key = F.col(key) if isinstance(key, str) else key
    checked = required(key.cast("string"), "a record needs a partition key")
    return records.withColumn("partition_key", checked).withColumn(
        "shard_id", shard_of(F.col("partition_key"), shards)
    )


def number_records(
    routed: DataFrame,
    order_by: list[Column | str] | None = None,
    base: int = 0,
    *,
    rows_per_task: int = ROWS_PER_TASK,
    staging: str | None = None,
) -> DataFrame:
    """Number the records of each shard ``base, base + 1, …`` in the given order.

    The order is made of short columns. Ties go by ``arrival_order``, which is total but for
    copies of a record.

    A count per shard comes first. While every shard fits one task, a window per
    shard does the rest. Otherwise the records are range-partitioned on shard and
    order, however few shards there are, and written below ``staging`` (by default a
    new path in the shared folder) with their place; a second pass adds up the
    sizes of the ranges before each. Both ways give the same numbers.
    """
    order_by = [*(order_by or []), *arrival_order()]
    spark = routed.sparkSession
    sizes = (
        routed.groupBy(*SHARD)
        .agg(F.count("*").alias("records"))
        .agg(F.max("records").alias("largest"), F.sum("records").alias("total"))
        .first()
    )
    largest, total = sizes["largest"] or 0, sizes["total"] or 0
    if largest > BATCH_SPAN:
        raise ValueError(f"one batch holds at most {BATCH_SPAN} records of a shard, not {largest}")

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if largest <= rows_per_task and total <= rows_per_task * tasks:
        in_shard = Window.partitionBy(*SHARD).orderBy(*order_by)
        place = F.row_number().over(in_shard).cast("bigint")
        # Brought together first, so that the order's digests are made behind the shuffle.
        return routed.repartition(*SHARD).withColumn("sequence_number", place + F.lit(base - 1))

    ranges = max(tasks, min(ceil(total / rows_per_task), MOST_RANGES))
    staging = staging or shared.scratch_path(spark, "numbering")
    return _number_by_range(routed, order_by, base, ranges, staging)


def _columns(names: list[Column | str]) -> list[Column]:
    return [F.col(name) if isinstance(name, str) else name for name in names]


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _number_by_range(
    routed: DataFrame, order_by: list[Column | str], base: int, ranges: int, staging: str
) -> DataFrame:
    # The ranges may cut through a run of equal records, which only their position
    # tells apart. Positions, and ranges once cut, have to be the same for whoever
    # reads them and after a task is lost, so both are written before they are used.
    order = {f"order_{at}": by for at, by in enumerate(_columns(order_by))}
    given = _written(routed, f"{staging}/given")
    # The shuffle cuts by the order's expressions and takes along no columns for them; those
    # are made behind it, once a record, for the sort.
    placed = _written(
        given.withColumn("position", F.monotonically_increasing_id())
        .repartitionByRange(ranges, *SHARD, *order.values(), "position")
        .drop("position")
        .withColumns(order)
        .sortWithinPartitions(*SHARD, *order)
        .drop(*order, "sequence_number")  # one it came with may be in the order
        # (range << 33) + row in the range
        .withColumn("place", F.monotonically_increasing_id())
        .withColumn("range", F.shiftright("place", 33)),
        f"{staging}/placed",
    )

    # At most one row per range and one per shard.
    runs = placed.groupBy(*SHARD, "range").agg(
        F.min("place").alias("first_place"), F.count("*").alias("records")
    )
    earlier = (
        Window.partitionBy(*SHARD).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = runs.select(
        *SHARD,
        "range",
        (F.coalesce(F.sum("records").over(earlier), F.lit(0)) - F.col("first_place")).alias("shift"),
    )
    return (
        placed.join(shared.pin(offsets, "offsets"), [*SHARD, "range"])
        .withColumn("sequence_number", F.col("place") + F.col("shift") + F.lit(base))
        .select(*dict.fromkeys([*given.columns, "sequence_number"]))
    )


def _needed(routed: DataFrame, order_by: list[Column | str] | None) -> DataFrame:
    """The columns that numbering and landing use; all of them where the order has expressions."""
    if not all(isinstance(by, str) for by in order_by or []):
        return routed
    names = [field.name for field in RECORD if field.name != "sequence_number"]
    return routed.select(*dict.fromkeys([*names, *(order_by or [])]))


def put_records(
    routed: DataFrame,
    log_dir: str,
    batch_id: int,
    order_by: list[Column | str] | None = None,
    *,
    rows_per_task: int = ROWS_PER_TASK,
) -> bool:
    """Land one batch of routed records in a log, once.

    The batch takes the sequence numbers from ``batch_id * 2**32`` on. It is
    written out of sight of readers, described in a list of its files, moved to
    ``batch_id=N`` and committed, which readers go by: they see all of it or nothing,
    also where a move copies. Putting a batch that is committed changes nothing and
    returns ``False``, which makes a replayed micro-batch harmless; one that was broken
    off after its list was written is completed from it, file by file, by the next put of
    that batch or of a later one. A log has one writer, with rising batch ids. What was put is in ``read_index``.
    """
    spark = routed.sparkSession
    log_dir = log_dir.rstrip("/")
    landed = f"{log_dir}/batch_id={batch_id}"
    landing = f"{log_dir}/_landing/batch_id={batch_id}"
    listed = f"{log_dir}/_landing/{batch_id}.json"
    if commits.is_committed(spark, log_dir, batch_id):
        return False
    for earlier in shared.numbers(spark, f"{log_dir}/_landing", "", ".json"):
        if earlier < batch_id:  # readers that saw this batch first would pass that one
            _complete(spark, log_dir, earlier)
    if not shared.exists(spark, listed):
        if shared.exists(spark, landed):
            raise OSError(f"{landed} was not put here; adopt_batches commits what other writers made")
        staging = shared.scratch_path(spark, "numbering")
        named = routed.withColumn(
            "stream", required(F.nullif("stream", F.lit("")), "a record needs a stream")
        )
        try:
            numbered = number_records(
                _needed(named, order_by), order_by, batch_id * BATCH_SPAN, rows_per_task=rows_per_task, staging=staging
            )
            (
                numbered.select([F.col(f.name).cast(f.dataType) for f in RECORD])
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "static")
                .partitionBy(*SHARD)
                .parquet(landing)
            )
        finally:
            shared.remove(spark, staging)
        if not shared.is_complete(spark, landing):
            raise OSError(f"no _SUCCESS file in {landing}; a put needs them switched on")
        written = spark.read.schema(commits.LAYOUT).parquet(landing).withColumn("batch_id", F.lit(batch_id))
        root = f"_landing/batch_id={batch_id}"
        lines = commits.describe(spark, root, written).get(batch_id, [])
        shared.write_once(spark, listed, commits.to_text(lines))
    _complete(spark, log_dir, batch_id)
    return True


def _complete(spark, log_dir: str, batch_id: int) -> None:
    landing, listed = f"{log_dir}/_landing/batch_id={batch_id}", f"{log_dir}/_landing/{batch_id}.json"
    _place(spark, commits.files_of(shared.read_text(spark, listed)), landing, f"{log_dir}/batch_id={batch_id}")
    shared.rename(spark, listed, commits.commit_path(log_dir, batch_id))
    shared.remove(spark, landing)


def _place(spark, files: list[tuple[str, int]], landing: str, landed: str) -> None:
    """Move the files of a batch into their place; some may have been moved before."""
    if files and not shared.exists(spark, landed):
        shared.rename(spark, landing, landed)
        return
    for path, size in files:
        source, target = f"{landing}/{path}", f"{landed}/{path}"
        there = shared.length(spark, target)
        if there == size:
            continue
        if there is not None:
            shared.remove(spark, target)  # a copy that was broken off; its source is still there
        shared.rename(spark, source, target)
