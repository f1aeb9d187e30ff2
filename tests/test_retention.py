"""Merging a log's commits and expiring its oldest batches."""

from __future__ import annotations

from datetime import timedelta
from pathlib import Path

import pytest
from helpers import EPOCH, keys, positions, records, unrouted

from shardstream import (
    LATEST,
    advance,
    compact_log,
    consume,
    list_streams,
    put_records,
    read_index,
    read_log,
    read_page,
    route_records,
    shard_inventory,
    shard_positions,
    shared,
    text_sink,
)
from shardstream.operators.puts import BATCH_SPAN
from shardstream.sources import commits


def put(spark, log, batch_id, stream="s", n=3):
    rows = [(stream, "k", 100 * batch_id + i, f"{stream}{batch_id}-{i}".encode()) for i in range(n)]
    return put_records(route_records(unrouted(spark, rows), "partition_key", 1), log, batch_id)


def texts(spark, log):
    return sorted(bytes(row.data).decode() for row in read_log(spark, log).select("data").collect())


def named(batches, stream="s", n=3):
    return sorted(f"{stream}{b}-{i}" for b in batches for i in range(n))


def index(spark, log):
    return sorted(map(tuple, read_index(spark, log).collect()), key=str)


def names(folder):
    return sorted(path.name for path in Path(folder).glob("*") if not path.name.startswith("."))


def streamed(spark, log, out, progress, **options):
    consume(spark, log, text_sink(out), progress, columns=["data"], available_now=True, **options).awaitTermination()
    return sorted(row.value for row in spark.read.text(out).collect())


def test_merged_commits_say_what_single_ones_did(spark, folder):
    log = f"{folder}/log"
    for batch_id in (0, 1, 2, 5):
        put(spark, log, batch_id)
    before, rows = index(spark, log), texts(spark, log)
    assert compact_log(spark, log) == 0
    assert index(spark, log) == before and texts(spark, log) == rows
    assert commits.read_commits(spark, log).ranges == [(0, 2), (5, 5)]
    assert names(f"{log}/_commits") == ["0.json", "1.json", "2.json", "5.json"]  # for reads under way
    put(spark, log, 6)
    more = index(spark, log)
    compact_log(spark, log)
    assert names(f"{log}/_commits") == ["6.json"] and index(spark, log) == more and len(more) == 5
    compact_log(spark, log)
    assert names(f"{log}/_commits") == [] and index(spark, log) == more and len(names(f"{log}/_index")) == 2
    assert compact_log(spark, log) == 0 and texts(spark, log) == named((0, 1, 2, 5, 6))


def test_puts_know_merged_and_expired_batches(spark, folder):
    log = f"{folder}/log"
    for batch_id in (0, 1, 4):
        put(spark, log, batch_id)
    put(spark, log, 6, n=0)
    for _ in range(3):
        compact_log(spark, log, keep_from=4)
    assert [put(spark, log, batch_id, "again") for batch_id in (0, 1, 4, 6)] == [False] * 4
    assert texts(spark, log) == named([4]) and put(spark, log, 7) and texts(spark, log) == named([4, 7])
    # A number that was passed over is no merged batch.
    assert put(spark, log, 5) and texts(spark, log) == named([4, 5, 7])


def test_expired_batches_are_hidden_at_once_and_deleted_by_the_next_run(spark, folder):
    log = f"{folder}/log"
    for batch_id in range(4):
        put(spark, log, batch_id)
    open_read = read_log(spark, log)
    assert compact_log(spark, log, keep_from=2) == 2
    assert texts(spark, log) == named([2, 3]) and open_read.count() == 12
    assert shared.exists(spark, f"{log}/batch_id=0")
    assert compact_log(spark, log, keep_from=1) == 2  # nothing comes back
    assert not shared.exists(spark, f"{log}/batch_id=0") and not shared.exists(spark, f"{log}/batch_id=1")
    assert compact_log(spark, log, keep_from=99) == 3  # the newest batch stays
    assert texts(spark, log) == named([3]) and len(index(spark, log)) == 1


def test_batches_expire_by_arrival(spark, folder):
    log = f"{folder}/log"
    for batch_id in range(4):
        put(spark, log, batch_id)
    assert compact_log(spark, log, keep_since=EPOCH + timedelta(seconds=102)) == 1  # its last record
    assert compact_log(spark, log, keep_since=EPOCH + timedelta(seconds=103)) == 2
    assert compact_log(spark, log, keep_since=EPOCH + timedelta(days=9)) == 3
    assert texts(spark, log) == named([3])


def test_pages_across_an_expiry_hold_each_record_kept_once(spark, folder):
    log = f"{folder}/log"
    for batch_id in range(6):
        put(spark, log, batch_id)
    at, seen = shard_positions(read_index(spark, log)), []
    for turn in range(7):
        page = shared.pin(read_page(spark, log, at, 2), "page")
        seen += sorted(bytes(row.data).decode() for row in page.collect())
        at = advance(at, page)
        if turn == 1:  # four records of six in batches 0 and 1 are read
            compact_log(spark, log, keep_from=3)
        if turn in (2, 4):
            compact_log(spark, log)
    assert seen == [*named([0]), "s1-0", *named([3, 4, 5])]


def test_a_shard_whose_records_all_expired_keeps_its_place(spark, folder):
    log = f"{folder}/log"
    put(spark, log, 0, "old")
    put(spark, log, 1)
    for _ in range(3):
        compact_log(spark, log, keep_from=1)
    found = read_index(spark, log)
    assert [row.stream for row in list_streams(found).collect()] == ["old", "s"]
    for position in ("trim_horizon", LATEST):
        at = {row.stream: row.next_sequence for row in shard_positions(found, position=position).collect()}
        assert at["old"] == 3
    rows = {row.stream: row for row in shard_inventory(found).collect()}
    assert rows["old"].records == 0 and rows["old"].first_arrival is None and rows["s"].records == 3
    assert read_page(spark, log, shard_positions(found), 10).count() == 3
    assert read_page(spark, log, positions(spark, [("old", 0, 0)]), 10).count() == 0
    put(spark, log, 2, "old")
    rows = {row.stream: row for row in shard_inventory(read_index(spark, log)).collect()}
    assert rows["old"].records == 3 and rows["old"].first_sequence == 2 * BATCH_SPAN
    assert len(keys(read_page(spark, log, positions(spark, [("old", 0, 0)]), 10))) == 3


def test_streams_across_an_expiry(spark, folder):
    """One that was ahead of it, one that had not come so far, one that starts behind it."""
    log = f"{folder}/log"
    for batch_id in range(3):
        put(spark, log, batch_id)
    ahead = streamed(spark, log, f"{folder}/ahead", f"{folder}/ahead-progress", max_files=1)
    assert ahead == named(range(3))
    compact_log(spark, log, keep_from=2)
    late = streamed(spark, log, f"{folder}/late", f"{folder}/late-progress")
    assert late == named([2])
    put(spark, log, 3)
    compact_log(spark, log, keep_from=2)
    assert streamed(spark, log, f"{folder}/ahead", f"{folder}/ahead-progress", max_files=1) == named(range(4))
    assert streamed(spark, log, f"{folder}/late", f"{folder}/late-progress") == named([2, 3])
    compact_log(spark, log, keep_from=3)
    compact_log(spark, log)
    put(spark, log, 4)
    assert streamed(spark, log, f"{folder}/late", f"{folder}/late-progress") == named([2, 3, 4])
    options = {"position": LATEST, "max_files": 1}
    assert streamed_latest(spark, log, folder, options) == named([5])


def streamed_latest(spark, log, folder, options):
    out, progress = f"{folder}/latest", f"{folder}/latest-progress"
    consume(spark, log, text_sink(out), progress, columns=["data"], available_now=True, **options).awaitTermination()
    put(spark, log, 5)
    return streamed(spark, log, out, progress, **options)


@pytest.mark.parametrize("dies_at", ["write_once", "remove"])
def test_a_run_that_died_is_done_again(spark, folder, monkeypatch, dies_at):
    log = f"{folder}/log"
    for batch_id in range(4):
        put(spark, log, batch_id)
    compact_log(spark, log, keep_from=1)
    before = index(spark, log)

    def dies(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(shared, dies_at, dies)
        with pytest.raises(OSError, match="lost"):
            compact_log(spark, log, keep_from=2)
    # The summary is there whole or not at all.
    kept = 1 if dies_at == "write_once" else 2
    assert texts(spark, log) == named(range(kept, 4))
    assert index(spark, log) == [row for row in before if row[0] >= kept]
    compact_log(spark, log, keep_from=2)
    compact_log(spark, log, keep_from=2)
    assert texts(spark, log) == named([2, 3]) and not shared.exists(spark, f"{log}/batch_id=1")


def test_a_broken_put_below_merged_batches_stays_hidden(spark, folder):
    log = f"{folder}/log"
    for batch_id in range(3):
        put(spark, log, batch_id)
    # Back to where a put is that died before its commit.
    shared.rename(spark, commits.commit_path(log, 1), f"{log}/_landing/1.json")
    compact_log(spark, log)
    compact_log(spark, log)
    assert texts(spark, log) == named([0, 2]) and commits.read_commits(spark, log).ranges == [(0, 0), (2, 2)]
    put(spark, log, 3)  # completes it
    assert texts(spark, log) == named(range(4))
    compact_log(spark, log)
    assert commits.read_commits(spark, log).ranges == [(0, 3)] and len(index(spark, log)) == 4


def test_an_empty_log(spark, folder):
    log = f"{folder}/log"
    shared.make_directory(spark, log)
    assert compact_log(spark, log, keep_from=5) == 0 and read_index(spark, log).isEmpty()
    put(spark, log, 0, n=0)
    assert compact_log(spark, log, keep_from=5) == 0 and read_index(spark, log).isEmpty()
    assert records(spark, []).isEmpty()
