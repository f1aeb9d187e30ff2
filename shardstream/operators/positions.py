"""Streams, shards and read positions of a record log, and reads from a position.

What asks for streams, shards or positions takes a log's records or its index
(``read_index``), which has the same answers in a row per shard and batch.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from shardstream.model import RECORD, SHARD, TRIM_HORIZON, check_position
from shardstream.operators.puts import BATCH_SPAN
from shardstream.shared import pin
from shardstream.sources import read_index, read_log


def _is_index(log: DataFrame) -> bool:
    return "last_sequence" in log.columns


def _ends(log: DataFrame) -> tuple[Column, Column]:
    """The columns of the lowest and of the highest number of a row."""
    names = ("first_sequence", "last_sequence") if _is_index(log) else ("sequence_number",) * 2
    return F.col(names[0]), F.col(names[1])


def _oldest(log: DataFrame) -> Column:
    """The aggregate of a shard's lowest number. Of an index, rows without records (what is
    left of expired batches) count only where a shard has no other."""
    first, _ = _ends(log)
    return F.coalesce(F.min(F.when(F.col("records") > 0, first)), F.min(first)) if _is_index(log) else F.min(first)


def list_streams(log: DataFrame) -> DataFrame:
    """The names of all streams, in order."""
    return log.select("stream").distinct().orderBy("stream")


def shard_inventory(log: DataFrame, stream: str | None = None) -> DataFrame:
    """Every shard, with its record count and its first and last record."""
    _, last = _ends(log)
    arrivals = ("first_arrival", "last_arrival") if _is_index(log) else ("arrival_ts",) * 2
    return (
        _of_stream(log, stream)
        .groupBy(*SHARD)
        .agg(
            (F.sum("records") if _is_index(log) else F.count("*")).alias("records"),
            _oldest(log).alias("first_sequence"),
            F.max(last).alias("last_sequence"),
            F.min(arrivals[0]).alias("first_arrival"),
            F.max(arrivals[1]).alias("last_arrival"),
        )
    )


def shard_positions(
    log: DataFrame,
    stream: str | None = None,
    position: str = TRIM_HORIZON,
    shard_id: int | None = None,
) -> DataFrame:
    """The position of the oldest record of each shard (or of one), or that behind the newest."""
    check_position(position)
    if shard_id is not None:
        log = log.where(F.col("shard_id") == shard_id)
    _, last = _ends(log)
    sequence = _oldest(log) if position == TRIM_HORIZON else F.max(last) + 1
    return _of_stream(log, stream).groupBy(*SHARD).agg(sequence.alias("next_sequence"))


def positions_with_new_shards(log: DataFrame, positions: DataFrame) -> DataFrame:
    """The positions, and the oldest record's for shards of the log that have none yet."""
    new = shard_positions(log).join(positions, list(SHARD), "left_anti")
    return positions.select(*SHARD, "next_sequence").unionByName(new)


def read_page(
    spark: SparkSession, log_dir: str, positions: DataFrame, limit_per_shard: int, stream: str | None = None
) -> DataFrame:
    """The next ``limit_per_shard`` records of each shard of a landed log, by its index.

    The index says how many records each batch has of a shard, and their numbers have no
    gaps within it. So where a page ends is a sum over the index from the lowest position's
    batch on, whether the page crosses batches or the shard is caught up. No key is looked
    at; the records are read from the page's batches alone.
    """
    if limit_per_shard < 0:
        raise ValueError(f"limit_per_shard must not be negative, but is {limit_per_shard}")
    lowest = positions.agg(F.min("next_sequence")).first()[0]
    from_batch = max(lowest or 0, 0) // BATCH_SPAN
    return _page_of(read_log(spark, log_dir, stream), read_index(spark, log_dir, stream, from_batch=from_batch), positions, limit_per_shard)


def _page_of(log: DataFrame, index: DataFrame, positions: DataFrame, limit: int) -> DataFrame:
    in_order = Window.partitionBy(*SHARD).orderBy("batch_id").rowsBetween(Window.unboundedPreceding, -1)
    unread = index.join(positions, SHARD).where("last_sequence >= next_sequence")
    begin = F.greatest("first_sequence", "next_sequence")
    parts = (
        unread.select("batch_id", *SHARD, begin.alias("first_sequence"), (F.col("last_sequence") - begin + 1).alias("records"))
        .withColumn("before", F.coalesce(F.sum("records").over(in_order), F.lit(0)))
        .where(F.col("before") < limit)
        .select(
            "batch_id",
            *SHARD,
            "first_sequence",
            (F.col("first_sequence") + F.least("records", limit - F.col("before")) - 1).alias("last_sequence"),
        )
    )
    return _within(log, _settle(parts, "page"), ["batch_id", *SHARD]).select(RECORD.fieldNames())


def read_records(log: DataFrame, positions: DataFrame, limit_per_shard: int) -> DataFrame:
    """The next ``limit_per_shard`` records of each shard, from its position on.

    Which sequence numbers these are is settled first and right away, on the key
    columns alone. A log numbered without gaps has them right behind the position,
    so that stretch is counted, and nothing else is looked at for the shards where
    it is full. For the rest, one scan counts the unread records by their distance
    from the position, and a second one ranks those near enough to matter. None of
    it sorts or shuffles the backlog. The payloads are then read by a scan and a
    join with one row per shard. A landed log is better read by ``read_page``, which
    needs none of these scans.
    """
    if limit_per_shard < 0:
        raise ValueError(f"limit_per_shard must not be negative, but is {limit_per_shard}")
    keys = log.select(*SHARD, "sequence_number", *(_BATCH & set(log.columns)))
    first = F.col("next_sequence").alias("first_sequence")
    behind = (F.col("next_sequence") + F.lit(limit_per_shard - 1)).alias("last_sequence")
    stretch = _settle(positions.select(*SHARD, first, behind), "stretch")
    found = _within(keys, stretch).groupBy(*SHARD).agg(F.count("*").alias("found"))
    is_full = F.col("found") == limit_per_shard
    gaps = Observation()
    counted = pin(
        stretch.table.join(found, SHARD, "left")
        .fillna(0, "found")
        .observe(gaps, F.min(F.when(~is_full, F.col("first_sequence"))).alias("low")),
        "counted",
    )

    page = counted.where(is_full).drop("found")
    if (lowest := gaps.get["low"]) is not None:
        gappy = counted.where(~is_full).drop("found")
        open_end = gappy.withColumn("last_sequence", F.lit(_OPEN_END))
        unread = _within(keys, _Ranges(open_end, lowest, _OPEN_END))
        near = _settle(_near_ranges(unread, limit_per_shard), "near")
        page = page.unionByName(_page_ranges(_within(keys, near), limit_per_shard))
    return _within(log, _settle(page, "page")).select(
        [name for name in log.columns if name in RECORD.fieldNames()]
    )


_OPEN_END = 2**63 - 1

# The batch directory of a log that ``put_records`` numbered.
_BATCH = {"batch_id"}

# Each part hands on up to a page of keys, so this bounds what meets in one task.
_MOST_PARTS = 1000


class _Ranges(NamedTuple):
    """Per shard a range of sequence numbers, from its first to its last."""

    table: DataFrame
    low: int | None  # the lowest of all
    high: int | None


def _settle(ranges: DataFrame, purpose: str) -> _Ranges:
    """Write ranges to the shared folder, taking note of the overall range on the way."""
    overall = Observation()
    low, high = F.min("first_sequence").alias("low"), F.max("last_sequence").alias("high")
    table = pin(ranges.observe(overall, low, high), purpose)
    return _Ranges(table, overall.get["low"], overall.get["high"])


def _within(log: DataFrame, ranges: _Ranges, keys: list[str] = SHARD) -> DataFrame:
    """The records inside the range of their shard.

    The overall range goes into the scan as a filter, and as a range of batches where
    the log names them: the directories of other batches are skipped, and the row
    groups outside the range. The comparison in the join's small side marks
    it as selective: Spark then also skips the directories of shards not in it.
    """
    if _BATCH <= set(log.columns) and ranges.low is not None:
        batches = ranges.low // BATCH_SPAN, ranges.high // BATCH_SPAN
        log = log.where(F.col("batch_id").between(*batches))
    return (
        log.where(F.col("sequence_number").between(ranges.low, ranges.high))
        .join(ranges.table.where("first_sequence <= last_sequence"), keys)
        .where("sequence_number between first_sequence and last_sequence")
    )


def _near_ranges(unread: DataFrame, limit: int) -> DataFrame:
    """Per shard a range that holds its next ``limit`` records, and seldom many more.

    Records fall into zones that double in width with the distance from the position,
    and anew from the first number of each batch, so a shard has at most some thirty for
    a batch. Zones count until the ones before them hold the limit.
    """
    distance = F.col("sequence_number") - F.greatest("first_sequence", F.col("batch") * BATCH_SPAN)
    zones = (
        unread.withColumn("batch", F.shiftright("sequence_number", 32))
        .withColumn("zone", F.floor(F.log2(distance / max(limit, 1) + 1)))
        .groupBy(*SHARD, "first_sequence", "batch", "zone")
        .agg(F.count("*").alias("records"), F.max("sequence_number").alias("last_sequence"))
    )
    by_distance = Window.partitionBy(*SHARD).orderBy("batch", "zone")
    nearer = by_distance.rowsBetween(Window.unboundedPreceding, -1)
    return (
        zones.withColumn("before", F.coalesce(F.sum("records").over(nearer), F.lit(0)))
        .where(F.col("before") < limit)
        .groupBy(*SHARD)
        .agg(
            F.first("first_sequence").alias("first_sequence"),
            F.max("last_sequence").alias("last_sequence"),
        )
    )


def _page_ranges(near: DataFrame, limit: int) -> DataFrame:
    """Per shard the exact range of its next ``limit`` records.

    The keys of a shard are ranked in as many parts as a shuffle has, and only the
    first of each part together, so that no task ranks all keys of a large shard.
    """
    parts = min(int(near.sparkSession.conf.get("spark.sql.shuffle.partitions")), _MOST_PARTS)
    keys = near.select(
        *SHARD,
        "sequence_number",
        F.pmod(F.xxhash64("sequence_number"), F.lit(parts)).alias("part"),
    )
    kept = _first_by_sequence(keys, [*SHARD, "part"], limit)
    return (
        _first_by_sequence(kept, SHARD, limit)
        .groupBy(*SHARD)
        .agg(
            F.min("sequence_number").alias("first_sequence"),
            F.max("sequence_number").alias("last_sequence"),
        )
    )


def _first_by_sequence(records: DataFrame, group: list[str], n: int) -> DataFrame:
    in_group = Window.partitionBy(*group).orderBy("sequence_number")
    return records.withColumn("at", F.row_number().over(in_group)).where(F.col("at") <= n).drop("at")


def advance(positions: DataFrame, batch: DataFrame) -> DataFrame:
    """The positions after ``batch`` was read; a shard without records keeps its own.

    The result is written to the shared folder, so that reading page after page
    does not pile up the plans of all earlier pages.
    """
    read = batch.groupBy(*SHARD).agg((F.max("sequence_number") + 1).alias("after"))
    return pin(
        positions.join(read, SHARD, "left").select(
            *SHARD, F.coalesce("after", "next_sequence").alias("next_sequence")
        ),
        "positions",
    )


def _of_stream(log: DataFrame, stream: str | None) -> DataFrame:
    return log if stream is None else log.where(F.col("stream") == stream)
