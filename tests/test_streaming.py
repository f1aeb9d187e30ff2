from __future__ import annotations

import logging
import os
from pathlib import Path

import pytest
from helpers import landed, numbered, unrouted
from pyspark.errors import AnalysisException, StreamingQueryException

from shardstream import (
    LATEST,
    app,
    compose,
    consume,
    dispatch,
    log_stats,
    print_preview,
    put_records,
    put_sink,
    read_log,
    record_stream,
    route_records,
    text_sink,
    union_streams,
)
from shardstream.operators.puts import BATCH_SPAN

ROWS = [("s", f"k{n % 7}", n, b"text %d" % n) for n in range(40)]
TEXTS = sorted(data.decode() for *_, data in ROWS)


@pytest.fixture
def log(folder):
    return f"{folder}/log"


def _put(spark, rows, log_dir, batch_id=0, shards=1):
    put_records(route_records(unrouted(spark, rows), "partition_key", shards), log_dir, batch_id)


def _put_in_parts(spark, log_dir, parts=3):
    for part in range(parts):
        _put(spark, ROWS[part::parts], log_dir, part)


def _run(spark, log_dir, handler, checkpoint, **options):
    query = consume(spark, log_dir, handler, checkpoint, available_now=True, **options)
    query.awaitTermination()
    return query


def _lines(spark, out):
    return sorted(row.value for row in spark.read.text(out).select("value").collect())


def _rows_read(query):
    return sum(progress["numInputRows"] for progress in query.recentProgress)


class Seen:
    """A handler that remembers the texts of each batch."""

    def __init__(self):
        self.batches = {}

    def __call__(self, batch, batch_id):
        self.batches[batch_id] = sorted(row.value for row in batch.select("value").collect())

    @property
    def texts(self):
        return sorted(text for batch in self.batches.values() for text in batch)


def test_one_batch_per_file_and_no_record_lost(spark, folder, log):
    _put_in_parts(spark, log)
    seen = Seen()
    _run(spark, log, seen, f"{folder}/progress", max_files=1)
    assert sorted(seen.batches) == [0, 1, 2]
    assert seen.texts == TEXTS


def test_a_batch_with_old_files_is_streamed(spark, folder, log):
    """A copy that keeps times may bring files in that are days older than those seen."""
    _put(spark, ROWS[:20], log, 0)
    out, progress = f"{folder}/out", f"{folder}/progress"
    consume(spark, log, text_sink(out), progress, available_now=True).awaitTermination()
    _put(spark, ROWS[20:], log, 1)
    for path in Path(f"{log}/batch_id=1").rglob("*.parquet"):
        os.utime(path, (1_500_000_000, 1_500_000_000))
    consume(spark, log, text_sink(out), progress, available_now=True).awaitTermination()
    assert _lines(spark, out) == TEXTS


def test_a_byte_bound_cuts_batches_too(spark, folder, log):
    _put_in_parts(spark, log)
    seen = Seen()
    _run(spark, log, seen, f"{folder}/progress", max_bytes=1)
    assert len(seen.batches) == 3
    assert seen.texts == TEXTS


def test_a_restart_goes_on_where_it_stopped(spark, folder, log):
    _put(spark, ROWS[:10], log, 0)
    first, second, third = Seen(), Seen(), Seen()
    _run(spark, log, first, f"{folder}/progress")
    _run(spark, log, second, f"{folder}/progress")
    assert second.batches == {}
    _put(spark, ROWS[10:], log, 1)
    _run(spark, log, third, f"{folder}/progress")
    assert list(third.batches) == [1]
    assert sorted(first.texts + third.texts) == TEXTS


def test_a_failed_batch_is_replayed_and_written_once(spark, folder, log):
    _put_in_parts(spark, log)
    out, failures = f"{folder}/out", []

    def fail_once(batch, batch_id):
        if batch_id == 1 and not failures:
            failures.append(batch_id)
            raise RuntimeError("broken after the write")

    handler = compose(text_sink(out), fail_once)
    with pytest.raises(StreamingQueryException, match="broken after the write"):
        _run(spark, log, handler, f"{folder}/progress", max_files=1)
    assert len(_lines(spark, out)) < len(ROWS)
    _run(spark, log, handler, f"{folder}/progress", max_files=1)
    assert _lines(spark, out) == TEXTS
    assert sorted(os.listdir(out)) == ["batch_id=0", "batch_id=1", "batch_id=2"]


def test_a_replayed_put_reaches_a_reader_once(spark, folder, log):
    _put_in_parts(spark, log)
    copy, failures, seen = f"{folder}/copy", [], Seen()

    def fail_once(batch, batch_id):
        if not failures:
            failures.append(batch_id)
            raise RuntimeError("broken after the put")

    handler = compose(put_sink(copy, 3), fail_once)
    with pytest.raises(StreamingQueryException):
        _run(spark, log, handler, f"{folder}/progress", decode_errors=None)
    _run(spark, copy, seen, f"{folder}/downstream")
    _run(spark, log, handler, f"{folder}/progress", decode_errors=None)
    _run(spark, copy, seen, f"{folder}/downstream")
    assert seen.texts == TEXTS
    assert landed(read_log(spark, copy)) == numbered(ROWS, 3)


def test_decoded_batches_can_be_put(spark, folder, log):
    _put(spark, ROWS, log)
    _run(spark, log, put_sink(f"{folder}/copy", 2), f"{folder}/progress")
    assert landed(read_log(spark, f"{folder}/copy")) == numbered(ROWS, 2)


def test_an_empty_batch_skips_the_handler(spark, folder, log):
    _put(spark, ROWS, log)
    empty = Path(log) / "batch_id=0" / "stream=s" / "shard_id=0"
    table = read_log(spark, log).drop("stream", "shard_id", "batch_id").limit(0).coalesce(1)
    table.write.parquet(f"{folder}/empty")
    _run(spark, log, Seen(), f"{folder}/progress")
    (part,) = Path(f"{folder}/empty").glob("*.parquet")
    part.rename(empty / part.name)
    handler, every = Seen(), Seen()
    _run(spark, log, handler, f"{folder}/progress", every_batch=every)
    assert handler.batches == {}
    assert every.batches == {1: []}


def test_the_newest_position_is_frozen_at_the_first_start(spark, folder, log):
    _put(spark, ROWS[:10], log, 0)
    seen = Seen()
    query = _run(spark, log, seen, f"{folder}/progress", position=LATEST)
    assert seen.batches == {}
    assert _rows_read(query) == 0, "the backlog was read"
    _put(spark, ROWS[10:20], log, 1)
    _put(spark, ROWS[20:], log, 2, shards=5)
    _run(spark, log, seen, f"{folder}/progress", position=LATEST)
    assert seen.texts == sorted(data.decode() for *_, data in ROWS[10:])
    _run(spark, log, seen, f"{folder}/other", position=LATEST)
    assert len(seen.texts) == 30


def test_a_bounded_consumer_passes_the_backlog_at_once(spark, folder, log):
    _put_in_parts(spark, log, 12)
    options = {"position": LATEST, "max_files": 1}
    seen = Seen()
    query = _run(spark, log, seen, f"{folder}/progress", **options)
    assert seen.batches == {}
    assert _rows_read(query) == 0, "the backlog was read"
    # A restart between passing the backlog and the first batch with bounds.
    for batch_id in (12, 13):
        _put(spark, ROWS[:2], log, batch_id)
    _run(spark, log, seen, f"{folder}/progress", **options)
    assert {batch_id: len(rows) for batch_id, rows in seen.batches.items()} == {1: 2, 2: 2}
    # Once it has commits it keeps to its bounds.
    for batch_id in (14, 15):
        _put(spark, ROWS[:2], log, batch_id)
    _run(spark, log, seen, f"{folder}/progress", **options)
    assert sorted(seen.batches) == [1, 2, 3, 4]


def test_positions_are_checked(spark, folder, log):
    _put(spark, ROWS, log)
    with pytest.raises(ValueError):
        record_stream(spark, log, position="at_timestamp")
    with pytest.raises(ValueError, match="start path"):
        record_stream(spark, log, position=LATEST)


def test_a_log_without_records_is_refused(spark, folder, log):
    for make in (lambda: None, lambda: os.makedirs(log), lambda: _put(spark, [], log)):
        make()
        with pytest.raises(ValueError, match="no records"):
            consume(spark, log, Seen(), f"{folder}/progress")
    _put(spark, ROWS, log, 1)
    with pytest.raises(ValueError, match="no records"):
        consume(spark, log, Seen(), f"{folder}/progress", stream="missing")


@pytest.mark.parametrize("position", ["trim_horizon", LATEST])
def test_a_log_may_start_empty(spark, folder, log, position):
    """Its partition columns then show up only while the query runs."""
    seen = []

    def remember(batch, batch_id):
        seen.extend(batch.collect())

    query = consume(
        spark,
        log,
        remember,
        f"{folder}/progress",
        position=position,
        require_data=False,
        decode_errors=None,
        interval="0 seconds",
    )
    try:
        _put(spark, ROWS, log, 0, shards=3)
        query.processAllAvailable()
        _put(spark, ROWS, log, 1, shards=3)
        query.processAllAvailable()
    finally:
        query.stop()
    result = sorted((r.stream, r.shard_id, r.sequence_number, r.partition_key, bytes(r.data)) for r in seen)
    assert result == sorted(numbered(ROWS, 3) + numbered(ROWS, 3, BATCH_SPAN))


def test_one_stream_of_many(spark, folder, log):
    _put(spark, ROWS + [("other", "k", 0, b"not this")], log)
    seen = Seen()
    _run(spark, log, seen, f"{folder}/progress", stream="s")
    assert seen.texts == TEXTS


def test_parallelism_spreads_a_batch(spark, folder, log):
    _put(spark, ROWS, log)
    sizes = []

    def note(batch, batch_id):
        sizes.append(batch.rdd.getNumPartitions())

    _run(spark, log, note, f"{folder}/progress", parallelism=6)
    _run(spark, log, note, f"{folder}/plain")
    assert sizes == [6, 1]


def test_bad_bytes_can_stop_the_query(spark, folder, log):
    _put(spark, [("s", "k", 0, b"a\xffb")], log)
    seen = Seen()
    _run(spark, log, seen, f"{folder}/progress")
    assert seen.texts == ["a�b"]
    with pytest.raises(StreamingQueryException, match="MALFORMED_CHARACTER_CODING"):
        _run(spark, log, seen, f"{folder}/strict", decode_errors="fail")


def test_only_the_columns_asked_for_are_read(spark, folder, log):
    _put(spark, ROWS, log)
    columns = []

    def note(batch, batch_id):
        columns.append(batch.columns)

    query = _run(spark, log, note, f"{folder}/progress", columns=["stream", "data"])
    assert columns == [["stream", "value"]]
    plan = query._jsq.explainInternal(True)
    assert "ReadSchema: struct<data:binary>" in plan


def test_options_that_cannot_work_are_refused_at_the_start(spark, folder, log):
    _put(spark, ROWS, log)
    with pytest.raises(ValueError):
        consume(spark, log, Seen(), f"{folder}/progress", decode_errors="ignore")
    with pytest.raises(AnalysisException):
        consume(spark, log, Seen(), f"{folder}/progress", columns=["stream"])


def test_any_stream_of_records_can_be_dispatched(spark, folder, log):
    _put(spark, ROWS, log)
    stream = record_stream(spark, log).where("sequence_number < 5")
    seen = Seen()
    query = dispatch(stream, seen, f"{folder}/progress", available_now=True, query_name="five")
    assert query.name == "five"
    query.awaitTermination()
    assert len(seen.texts) == 5


def test_streams_are_unioned_before_the_handler(spark, folder, log):
    _put(spark, ROWS[:15], log)
    _put(spark, ROWS[15:], f"{folder}/second")
    seen = Seen()
    records = union_streams([record_stream(spark, log), record_stream(spark, f"{folder}/second")])
    dispatch(records, seen, f"{folder}/progress", available_now=True).awaitTermination()
    assert seen.texts == TEXTS


def test_handlers_share_one_read_and_stop_at_the_first_error(spark):
    batch = spark.range(10)
    calls = []

    def first(df, batch_id):
        assert df.is_cached
        calls.append(batch_id)

    def broken(df, batch_id):
        raise RuntimeError("broken")

    with pytest.raises(RuntimeError, match="broken"):
        compose(first, broken, first)(batch, 4)
    assert calls == [4]
    assert not batch.is_cached


def test_text_is_written_per_batch_and_overwritten_on_replay(spark, folder):
    batch = spark.createDataFrame([(str(n),) for n in range(20)], "value string").repartition(5)
    sink = text_sink(folder, files=2)
    sink(batch, 0)
    sink(batch, 1)
    sink(batch.limit(3), 1)
    assert len(_lines(spark, folder)) == 23
    assert len(list(Path(folder, "batch_id=0").glob("*.txt"))) == 2
    with pytest.raises(Exception, match="null text"):
        sink(spark.createDataFrame([(None,)], "value string"), 2)


def test_printing_and_logging(spark, capsys, caplog):
    batch = spark.createDataFrame([(n, f"text {n}") for n in range(9)], "n int, value string")
    print_preview(2, header=True)(batch.coalesce(1), 3)
    header, *lines = capsys.readouterr().out.splitlines()
    assert header.startswith("--- batch 3 at ")
    assert lines == ["text 0", "text 1"]
    with caplog.at_level(logging.INFO, "shardstream"):
        log_stats(1)(batch.repartition(4).coalesce(3), 3)
    messages = [record.getMessage() for record in caplog.records]
    assert messages[:2] == ["batch 3 holds 9 records", "batch 3 lies in 3 partitions"]
    assert len(messages) == 3 and messages[2].startswith("batch 3: text ")


def test_the_stock_job(spark, folder, log, capsys):
    _put(spark, ROWS, log)
    arguments = [log, f"{folder}/out", f"{folder}/progress", "--once", "--take", "2", "--files", "1"]
    app.main(arguments)
    assert _lines(spark, f"{folder}/out") == TEXTS
    printed = capsys.readouterr().out
    assert printed.count("--- batch 0 at ") == 1
    assert printed.count("text ") == 4
