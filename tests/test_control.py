"""Commits seen by streams, handlers side by side, and orderly stops."""

from __future__ import annotations

import os
import threading
import time
from pathlib import Path

import pytest
from helpers import unrouted
from pyspark.errors import StreamingQueryException

from shardstream import (
    await_consumers,
    compose,
    consume,
    put_records,
    route_records,
    shared,
    stop_between_batches,
    text_sink,
)

ROWS = [("s", f"k{n}", n, b"text %d" % n) for n in range(30)]
TEXTS = sorted(data.decode() for *_, data in ROWS)


def _put(spark, rows, log, batch_id):
    return put_records(route_records(unrouted(spark, rows), "partition_key", 2), log, batch_id)


class Seen:
    def __init__(self, seconds=0.0):
        self.batches, self.seconds = [], seconds

    def __call__(self, batch, batch_id):
        texts = [row.value for row in batch.collect()]
        time.sleep(self.seconds)
        self.batches.append((batch_id, texts))

    @property
    def texts(self):
        return sorted(text for _, texts in self.batches for text in texts)


def test_a_stream_hands_on_no_record_before_its_commit(spark, folder, monkeypatch):
    log, seen = f"{folder}/log", Seen()
    options = {"columns": ["data"], "available_now": True}
    _put(spark, ROWS[:10], log, 0)
    _put(spark, ROWS[10:], log, 1)
    # A put that died among its moves: one file is there, the others and the commit are not.
    os.rename(f"{log}/_commits/1.json", f"{log}/_landing/1.json")
    for path in sorted(Path(f"{log}/batch_id=1").rglob("*.parquet"))[1:]:
        back = Path(str(path).replace("batch_id=1", "_landing/batch_id=1"))
        back.parent.mkdir(parents=True, exist_ok=True)
        path.rename(back)
    monkeypatch.setitem(consume.__globals__, "COMMIT_WAIT", 0.5)
    with pytest.raises(StreamingQueryException, match="no commit yet"):
        consume(spark, log, seen, f"{folder}/progress", **options).awaitTermination()
    assert seen.batches == []
    assert _put(spark, [], log, 1)
    consume(spark, log, seen, f"{folder}/progress", **options).awaitTermination()
    consume(spark, log, seen, f"{folder}/progress", **options).awaitTermination()
    assert seen.texts == TEXTS


def test_a_stream_waits_for_a_commit_under_way(spark, folder):
    log, seen = f"{folder}/log", Seen()
    _put(spark, ROWS, log, 0)
    _put(spark, ROWS[:1], log, 1)
    os.rename(f"{log}/_commits/1.json", f"{folder}/held.json")
    threading.Timer(4, lambda: os.rename(f"{folder}/held.json", f"{log}/_commits/1.json")).start()
    consume(spark, log, seen, f"{folder}/progress", columns=["data"], available_now=True).awaitTermination()
    assert seen.texts == sorted([*TEXTS, TEXTS[0]])


def test_concurrent_handlers_overlap_and_share_one_read(spark):
    batch, both, pools = spark.range(10), threading.Barrier(2, timeout=30), []

    def meet(df, batch_id):
        assert df.is_cached and df.count() == 10
        pools.append(spark.sparkContext.getLocalProperty("spark.scheduler.pool"))
        both.wait()  # passes only while the other one runs

    spark.sparkContext.setLocalProperty("spark.scheduler.pool", "mine")
    try:
        compose(meet, meet, concurrent=True)(batch, 1)
    finally:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
    assert pools == ["mine", "mine"] and not batch.is_cached


def test_a_failing_handler_cancels_the_others(spark):
    batch = spark.range(0, 8, 1, 4)

    def slow(df, batch_id):
        df.rdd.foreach(lambda _: time.sleep(60))

    def broken(df, batch_id):
        time.sleep(2)
        raise RuntimeError("broken")

    begin = time.monotonic()
    with pytest.raises(RuntimeError, match="broken"):
        compose(slow, broken, concurrent=True)(batch, 1)
    assert time.monotonic() - begin < 50
    assert batch.count() == 8


def test_a_failed_batch_of_concurrent_handlers_is_replayed(spark, folder):
    log, out, failures = f"{folder}/log", f"{folder}/out", []
    _put(spark, ROWS, log, 0)

    def fail_once(batch, batch_id):
        if not failures:
            failures.append(batch_id)
            raise RuntimeError("broken")

    handler = compose(text_sink(out), fail_once, concurrent=True)
    with pytest.raises(StreamingQueryException, match="broken"):
        consume(spark, log, handler, f"{folder}/progress", columns=["data"], available_now=True).awaitTermination()
    consume(spark, log, handler, f"{folder}/progress", columns=["data"], available_now=True).awaitTermination()
    assert sorted(row.value for row in spark.read.text(out).select("value").collect()) == TEXTS


def test_orderly_stops_lose_and_repeat_nothing(spark, folder):
    log, seen = f"{folder}/log", Seen(0.4)
    for batch_id in range(6):
        _put(spark, ROWS[5 * batch_id : 5 * batch_id + 5], log, batch_id)
    options = {"columns": ["data"], "max_files": 2, "interval": "0 seconds"}
    while len(seen.texts) < len(ROWS):
        before = len(seen.batches)
        query = consume(spark, log, seen, f"{folder}/progress", **options)
        while len(seen.batches) == before:
            time.sleep(0.05)
        stop_between_batches(query)
        assert not query.isActive
    assert seen.texts == TEXTS
    ids = [batch_id for batch_id, _ in seen.batches]
    assert ids == sorted(set(ids))


def test_one_wait_over_several_consumers(spark, folder):
    logs, marker = [f"{folder}/one", f"{folder}/two"], f"{folder}/stop"
    all_seen = [Seen(), Seen()]
    for log in logs:
        _put(spark, ROWS, log, 0)

    def start(log, handler, name):
        return consume(spark, log, handler, f"{folder}/{name}", columns=["data"], interval="0 seconds")

    queries = [start(log, seen, f"progress-{log[-3:]}") for log, seen in zip(logs, all_seen, strict=True)]
    threading.Timer(15, lambda: shared.write_once(spark, marker, "")).start()
    await_consumers(queries, marker, poll_seconds=0.2)
    assert not any(query.isActive for query in queries)
    assert [seen.texts for seen in all_seen] == [TEXTS, TEXTS]

    def broken(batch, batch_id):
        raise RuntimeError("broken")

    queries = [start(logs[0], Seen(), "third"), start(logs[1], broken, "fourth")]
    with pytest.raises(StreamingQueryException, match="broken"):
        await_consumers(queries, poll_seconds=0.2)
    assert not any(query.isActive for query in queries)
