"""One query per operator, each over whole tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shardstream import (
    LATEST,
    adopt_batches,
    advance,
    batch_stats,
    compact_log,
    compose,
    consume,
    decode_records,
    dispatch,
    list_streams,
    log_stats,
    microbatch_counts,
    number_records,
    positions_with_new_shards,
    preview,
    put_records,
    put_sink,
    read_csv_with_header,
    read_index,
    read_log,
    read_page,
    read_records,
    record_stream,
    shard_inventory,
    shard_positions,
    shared,
    text_sink,
    union_streams,
)
from shardstream.model import SHARD
from shardstream.operators.puts import BATCH_SPAN
from shardstream.plans.views import (
    SHARDS,
    conversation_records,
    event_records,
    lineitem_records,
    log_values,
    table,
)
from shardstream.shared import scratch_path
from shardstream.sources.commits import commit_path, files_of

PAGE = 10


def _landed_events(spark: SparkSession, sf_dir: str) -> str:
    log_dir = scratch_path(spark, "log")
    put_records(event_records(spark, sf_dir), log_dir, 0, ["sequence_number"])
    return log_dir


def _consume_all(spark: SparkSession, log_dir: str, handler, **options) -> None:
    query = consume(
        spark, log_dir, handler, scratch_path(spark, "progress"), available_now=True, **options
    )
    query.awaitTermination()


def stream_consume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land ``events`` as a log, stream it through the consumer to text, read the text."""
    out = scratch_path(spark, "text")
    _consume_all(spark, _landed_events(spark, sf_dir), text_sink(out), columns=["data"])
    return spark.read.text(out).select("value")


def stream_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the batches spread before decoding and few files after it."""
    out = scratch_path(spark, "text")
    cores = spark.sparkContext.defaultParallelism
    _consume_all(
        spark,
        _landed_events(spark, sf_dir),
        text_sink(out, files=cores),
        columns=["data"],
        parallelism=2 * cores,
    )
    return spark.read.text(out).select("value")


def stream_handlers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several handlers on one batch: log its size, write it as text, put it elsewhere."""
    out, copy = scratch_path(spark, "text"), scratch_path(spark, "log")
    handlers = compose(log_stats(PAGE), text_sink(out), put_sink(copy, SHARDS))
    _consume_all(spark, _landed_events(spark, sf_dir), handlers)
    texts = spark.read.text(out).select("value", F.lit("text").alias("sink"))
    return texts.unionByName(log_values(spark, copy).select("value", F.lit("log").alias("sink")))


def stream_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two logs consumed as one stream."""
    lines, out = scratch_path(spark, "log"), scratch_path(spark, "text")
    put_records(lineitem_records(spark, sf_dir), lines, 0)
    logs = [_landed_events(spark, sf_dir), lines]
    records = union_streams([record_stream(spark, log).select("data") for log in logs])
    progress = scratch_path(spark, "progress")
    dispatch(records, text_sink(out), progress, available_now=True).awaitTermination()
    return spark.read.text(out).select("value")


def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A consumer that starts at the newest record sees only what lands afterwards."""
    log_dir, out = _landed_events(spark, sf_dir), scratch_path(spark, "log")
    progress = scratch_path(spark, "progress")
    options = {"position": LATEST, "max_files": 1, "decode_errors": None, "available_now": True}
    copy = put_sink(out, SHARDS, order_by=["sequence_number"])
    consume(spark, log_dir, copy, progress, **options).awaitTermination()
    put_records(event_records(spark, sf_dir), log_dir, 1, ["sequence_number"])
    consume(spark, log_dir, copy, progress, **options).awaitTermination()
    return log_values(spark, out).select("stream", "shard_id", "partition_key", "arrival_ts", "value")


def stream_put(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream a log into another one with twice the shards."""
    out = scratch_path(spark, "log")
    sink = put_sink(out, 2 * SHARDS, order_by=["arrival_ts"])
    _consume_all(spark, _landed_events(spark, sf_dir), sink, decode_errors=None)
    return log_values(spark, out)


def _landed_in_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``events`` as a log of three batches, by the day of the month."""
    return read_log(spark, _land_in_batches(spark, sf_dir))


def _land_in_batches(spark: SparkSession, sf_dir: str) -> str:
    log_dir = scratch_path(spark, "log")
    third = F.least(F.floor((F.dayofmonth("arrival_ts") - 1) / 10), F.lit(2))
    for batch_id in range(3):
        records = event_records(spark, sf_dir).where(third == batch_id)
        put_records(records, log_dir, batch_id, ["sequence_number"])
    return log_dir


def _land_by_the_day(spark: SparkSession, sf_dir: str) -> str:
    """All ``events`` as a log of a batch a day, written by one job and adopted."""
    log_dir = scratch_path(spark, "log")
    day = F.datediff(F.col("arrival_ts").cast("date"), F.lit("2024-01-01")).cast("bigint")
    in_day = Window.partitionBy("batch_id", *SHARD).orderBy("sequence_number")
    records = event_records(spark, sf_dir).withColumn("batch_id", day)
    number = F.col("batch_id") * BATCH_SPAN + F.row_number().over(in_day) - 1
    records = records.withColumn("sequence_number", number).repartition("batch_id")
    records.write.partitionBy("batch_id", *SHARD).parquet(log_dir)
    adopt_batches(spark, log_dir)
    return log_dir


def log_page_by_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page across some of the batches of a log, from a day in its middle on."""
    log_dir = _land_by_the_day(spark, sf_dir)
    start = shard_positions(read_index(spark, log_dir, to_batch=15), position=LATEST)
    return _page(read_page(spark, log_dir, start, PAGE))


def log_positions_after_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions after two pages by the index."""
    log_dir = _land_in_batches(spark, sf_dir)
    at = shard_positions(read_index(spark, log_dir))
    for _ in range(2):
        at = advance(at, read_page(spark, log_dir, at, 50 * PAGE))
    return at


def log_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_streams(read_index(spark, _land_by_the_day(spark, sf_dir)))


def log_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_inventory(read_index(spark, _land_in_batches(spark, sf_dir)))


def log_positions_oldest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_positions(read_index(spark, _land_in_batches(spark, sf_dir)))


def log_positions_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_positions(read_index(spark, _land_in_batches(spark, sf_dir)), position=LATEST)


def _expired_log(spark: SparkSession, sf_dir: str) -> str:
    """The log of a batch a day without its first ten, which are deleted, and with its commits merged."""
    log_dir = _land_by_the_day(spark, sf_dir)
    compact_log(spark, log_dir, keep_from=10)
    compact_log(spark, log_dir)
    return log_dir


def log_page_after_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page from positions at the begin of a log whose oldest batches have expired."""
    log_dir = _expired_log(spark, sf_dir)
    start = shard_positions(read_index(spark, log_dir)).withColumn("next_sequence", F.lit(0).cast("bigint"))
    return _page(read_page(spark, log_dir, start, PAGE))


def log_inventory_after_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_inventory(read_index(spark, _expired_log(spark, sf_dir)))


def stream_after_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A consumer that starts at the oldest record kept, and one more batch."""
    log_dir, out = _expired_log(spark, sf_dir), scratch_path(spark, "text")
    put_records(event_records(spark, sf_dir), log_dir, 1000, ["sequence_number"])
    _consume_all(spark, log_dir, text_sink(out), columns=["data"])
    return spark.read.text(out).select("value")


def log_after_broken_move(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of a log whose last put broke off, and which of them were seen before it was completed."""
    log_dir = _land_in_batches(spark, sf_dir)
    # Back to where a put is that dies while files move: its list is there, no commit.
    shared.rename(spark, commit_path(log_dir, 2), f"{log_dir}/_landing/2.json")
    first_file = files_of(shared.read_text(spark, f"{log_dir}/_landing/2.json"))[0][0]
    shared.rename(spark, f"{log_dir}/batch_id=2/{first_file}", f"{log_dir}/_landing/batch_id=2/{first_file}")
    before = shared.pin(log_values(spark, log_dir).select(*SHARD, "sequence_number", F.lit(True).alias("seen")), "seen")
    put_records(event_records(spark, sf_dir).limit(0), log_dir, 2)
    seen = log_values(spark, log_dir).join(before, [*SHARD, "sequence_number"], "left")
    return seen.withColumn("seen", F.coalesce("seen", F.lit(False)))


def _near_the_end_of_the_first_batch(log: DataFrame) -> DataFrame:
    ends = shard_positions(log.where("batch_id = 0"), position=LATEST)
    return ends.withColumn("next_sequence", F.greatest(F.col("next_sequence") - PAGE // 2, F.lit(0)))


def log_first_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _landed_in_batches(spark, sf_dir)
    return _page(read_records(log, shard_positions(log), PAGE))


def log_page_across_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page that begins shortly before the end of a batch."""
    log = _landed_in_batches(spark, sf_dir)
    return _page(read_records(log, _near_the_end_of_the_first_batch(log), PAGE))


def log_next_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _landed_in_batches(spark, sf_dir)
    start = _near_the_end_of_the_first_batch(log)
    return advance(start, read_records(log, start, PAGE))


def decode_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_records(event_records(spark, sf_dir)).select("sequence_number", "value")


def decode_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return decode_records(documents.select("doc_id", F.col("text").cast("binary").alias("data")))


def shard_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shards of a landed log, each read from its own directories, as one."""
    log = read_log(spark, _landed_events(spark, sf_dir))
    shards = [log.where(F.col("shard_id") == shard) for shard in range(SHARDS)]
    return decode_records(union_streams(shards)).select("shard_id", "sequence_number", "value")


def repartition_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = event_records(spark, sf_dir).repartition(2 * spark.sparkContext.defaultParallelism)
    return decode_records(records).select("sequence_number", "value")


def batch_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = preview(event_records(spark, sf_dir), PAGE, ["sequence_number"])
    return decode_records(records).select("sequence_number", "value")


def batch_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_stats(event_records(spark, sf_dir)).select("records")


def batch_stats_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records and partitions of a batch that was spread."""
    return batch_stats(event_records(spark, sf_dir).repartition(6))


def microbatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return microbatch_counts(event_records(spark, sf_dir), "1 hour")


def put_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_values(spark, _landed_events(spark, sf_dir))


def put_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch put a second time leaves the log as it is."""
    log_dir = _landed_events(spark, sf_dir)
    put_records(event_records(spark, sf_dir), log_dir, 0, ["sequence_number"])
    return log_values(spark, log_dir)


def put_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts, line breaks and all, through a log."""
    log_dir = scratch_path(spark, "log")
    put_records(conversation_records(spark, sf_dir), log_dir, 3, ["conv_id", "turn"])
    return log_values(spark, log_dir)


def number_hot_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number shards that are each too large for a task, by ranges."""
    records = lineitem_records(spark, sf_dir)
    tasks = 4 * spark.sparkContext.defaultParallelism
    numbered = number_records(
        records,
        ["arrival_ts", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
        rows_per_task=max(1, records.count() // tasks),
    )
    return decode_records(numbered).select("stream", "shard_id", "sequence_number", "value")


def streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_streams(event_records(spark, sf_dir))


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_inventory(event_records(spark, sf_dir))


def positions_oldest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_positions(event_records(spark, sf_dir))


def position_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The position behind the newest record of one shard."""
    return shard_positions(event_records(spark, sf_dir), "click", LATEST, shard_id=1)


def with_new_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions at the end of one stream, and the start of all others."""
    log = event_records(spark, sf_dir)
    return positions_with_new_shards(log, shard_positions(log, "click", LATEST))


def positions_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_positions(event_records(spark, sf_dir), position=LATEST)


def _page(records: DataFrame) -> DataFrame:
    return decode_records(records).select(
        "stream", "shard_id", "sequence_number", "partition_key", "arrival_ts", "value"
    )


def first_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = event_records(spark, sf_dir)
    return _page(read_records(log, shard_positions(log), PAGE))


def next_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = event_records(spark, sf_dir)
    start = shard_positions(log)
    return advance(start, read_records(log, start, PAGE))


def second_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = event_records(spark, sf_dir)
    return _page(read_records(log, next_positions(spark, sf_dir), PAGE))


def csv_header_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    orders = table(spark, sf_dir, "orders")
    texts = orders.select([F.col(name).cast("string") for name in orders.columns])
    texts.write.option("header", True).csv(path)
    return read_csv_with_header(spark, path)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stream_consume": stream_consume,
    "stream_spread": stream_spread,
    "stream_handlers": stream_handlers,
    "stream_union": stream_union,
    "stream_latest": stream_latest,
    "stream_put": stream_put,
    "decode_records": decode_events,
    "decode_documents": decode_documents,
    "shard_union": shard_union,
    "repartition_records": repartition_records,
    "batch_preview": batch_preview,
    "batch_count": batch_count,
    "batch_stats_spread": batch_stats_spread,
    "microbatch_counts": microbatches,
    "put_records": put_events,
    "put_replay": put_replay,
    "put_conversations": put_conversations,
    "number_hot_shards": number_hot_shards,
    "list_streams": streams,
    "shard_inventory": inventory,
    "shard_positions_oldest": positions_oldest,
    "shard_positions_latest": positions_latest,
    "shard_position_one": position_one,
    "positions_with_new_shards": with_new_shards,
    "read_records": first_page,
    "next_positions": next_positions,
    "read_records_second_page": second_page,
    "read_log_first_page": log_first_page,
    "read_log_page_across_batches": log_page_across_batches,
    "read_log_next_positions": log_next_positions,
    "log_page_by_index": log_page_by_index,
    "log_positions_after_pages": log_positions_after_pages,
    "log_streams": log_streams,
    "log_inventory": log_inventory,
    "log_positions_oldest": log_positions_oldest,
    "log_positions_latest": log_positions_latest,
    "log_after_broken_move": log_after_broken_move,
    "log_page_after_expiry": log_page_after_expiry,
    "log_inventory_after_expiry": log_inventory_after_expiry,
    "stream_after_expiry": stream_after_expiry,
    "csv_header_scan": csv_header_scan,
}
