from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from helpers import keys, page, plan_of, positions, records
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shardstream import (
    LATEST,
    adopt_batches,
    advance,
    list_streams,
    positions_with_new_shards,
    put_records,
    read_index,
    read_log,
    read_page,
    read_records,
    route_records,
    shard_inventory,
    shard_positions,
)
from shardstream.operators import positions as positions_module
from shardstream.operators.puts import BATCH_SPAN
from shardstream.plans.views import event_records

ROWS = [("a", 0, n) for n in range(5, 50, 3)] + [("a", 1, 7), ("b", 0, 0), ("b", 0, 2**40)]


def _as_dict(df):
    return {(row.stream, row.shard_id): row.next_sequence for row in df.collect()}


def test_streams_come_in_order(spark):
    assert list_streams(records(spark, ROWS)).collect() == [("a",), ("b",)]


def test_inventory(spark):
    rows = shard_inventory(records(spark, ROWS), "a").collect()
    assert sorted((r.shard_id, r.records, r.first_sequence, r.last_sequence) for r in rows) == [
        (0, 15, 5, 47),
        (1, 1, 7, 7),
    ]
    assert len(shard_inventory(records(spark, ROWS)).collect()) == 3


def test_positions(spark):
    log = records(spark, ROWS)
    assert _as_dict(shard_positions(log)) == {("a", 0): 5, ("a", 1): 7, ("b", 0): 0}
    assert _as_dict(shard_positions(log, "b", LATEST)) == {("b", 0): 2**40 + 1}
    with pytest.raises(ValueError):
        shard_positions(log, position="at_timestamp")


def test_the_newest_position_has_nothing_to_read(spark):
    log = records(spark, ROWS)
    newest = shard_positions(log, position=LATEST)
    batch = read_records(log, newest, 100)
    assert batch.isEmpty()
    assert batch.columns == log.columns
    assert _as_dict(advance(newest, batch)) == _as_dict(newest)


def test_only_shards_with_a_position_are_read(spark):
    log = records(spark, ROWS)
    start = positions(spark, [("a", 0, 20), ("gone", 3, 0)])
    assert keys(read_records(log, start, 2)) == [("a", 0, 20), ("a", 0, 23)]
    assert read_records(log, positions(spark, []), 2).isEmpty()
    assert read_records(log, shard_positions(log, "missing"), 2).isEmpty()
    nothing = read_records(log.where("stream = 'missing'"), start, 2)
    assert nothing.isEmpty()
    assert _as_dict(advance(start, nothing)) == _as_dict(start)


def test_limits(spark):
    log = records(spark, ROWS)
    start = shard_positions(log)
    assert read_records(log, start, 0).isEmpty()
    assert keys(read_records(log, start, 10**6)) == sorted(ROWS)
    with pytest.raises(ValueError):
        read_records(log, start, -1)


def test_a_hot_shard_and_a_large_limit(spark):
    rows = [("hot", 0, 3 * n) for n in range(9000)] + [("cold", 1, n) for n in range(10)]
    log = records(spark, rows).repartition(5)
    start = {("hot", 0): 4, ("cold", 1): 9}
    batch = read_records(log, positions(spark, [(*k, v) for k, v in start.items()]), 2500)
    assert keys(batch) == page(rows, start, 2500)


def test_paging_reads_every_record_once(spark):
    log = records(spark, ROWS)
    at, seen, pages = shard_positions(log), [], 0
    while read := keys(batch := read_records(log, at, 4)):
        seen += read
        pages += 1
        at = advance(at, batch)
    assert sorted(seen) == sorted(ROWS)
    assert pages == 4
    assert _as_dict(at) == _as_dict(shard_positions(log, position=LATEST))


def test_gaps_in_some_shards_only(spark):
    """Dense, gappy, short and exhausted shards, and copies of a sequence number."""
    rows = [("a", 0, n) for n in range(30)] + [("a", 1, n * n) for n in range(30)]
    rows += [("b", 0, n) for n in range(3)] + [("b", 1, 5)]
    start = {("a", 0): 2, ("a", 1): 3, ("b", 0): 0, ("b", 1): 6}
    at = positions(spark, [(*k, v) for k, v in start.items()])
    assert keys(read_records(records(spark, rows), at, 7)) == page(rows, start, 7)
    doubled = records(spark, [*rows, ("a", 0, 4)])
    read = [key for key in keys(read_records(doubled, at, 7)) if key[:2] == ("a", 0)]
    assert read == page([*rows, ("a", 0, 4)], {("a", 0): 2}, 7)


@settings(max_examples=5, deadline=None)
@given(
    numbers=st.sets(
        st.tuples(
            st.sampled_from("ab"),
            st.integers(0, 2),
            st.one_of(st.integers(0, 60), st.integers(0, 2**45)),
        ),
        max_size=120,
    ),
    first=st.one_of(st.integers(0, 50), st.integers(0, 2**45)),
    limit=st.integers(0, 40),
)
def test_reads_agree_with_brute_force(spark, numbers, first, limit):
    start = {(s, shard): first for s in "ab" for shard in range(3)}
    at = positions(spark, [(*k, v) for k, v in start.items()])
    batch = read_records(records(spark, sorted(numbers)), at, limit)
    assert keys(batch) == page(numbers, start, limit)


def test_a_page_of_a_log_is_read_by_a_pruned_scan_without_shuffle(spark, folder):
    events = event_records(spark, "/root/testdata/sf0.001")
    put_records(route_records(events, "partition_key", 4), folder, 0)
    log = read_log(spark, folder)
    plan = plan_of(read_records(log, shard_positions(log, "error"), 5))
    assert "GreaterThanOrEqual(sequence_number," in plan
    assert "LessThanOrEqual(sequence_number," in plan
    assert "dynamicpruningexpression(stream" in plan
    assert "BroadcastHashJoin" in plan
    assert "hashpartitioning" not in plan


def test_a_dense_log_is_not_searched(spark, folder, monkeypatch):
    events = event_records(spark, "/root/testdata/sf0.001")
    put_records(route_records(events, "partition_key", 2), folder, 0)
    log = read_log(spark, folder)
    monkeypatch.setattr("shardstream.operators.positions._near_ranges", None)
    batch = read_records(log, shard_positions(log), 5)
    assert sorted({key[2] for key in keys(batch)}) == [0, 1, 2, 3, 4]
    assert batch.count() == 5 * shard_inventory(log).count()


def test_a_page_across_batches_opens_two_of_them_and_ranks_few_keys(spark, folder, monkeypatch):
    events = event_records(spark, "/root/testdata/sf0.001")
    for batch_id in range(4):
        put_records(route_records(events, "partition_key", 2), folder, batch_id)
    log = read_log(spark, folder)
    ends = shard_positions(log.where("batch_id = 1"), position=LATEST)
    start = ends.withColumn("next_sequence", F.col("next_sequence") - 5)
    ranked = []
    rank = positions_module._page_ranges

    def ranked_keys(near, limit):
        ranked.append(near.count())
        return rank(near, limit)

    monkeypatch.setattr(positions_module, "_page_ranges", ranked_keys)
    batch = read_records(log, start, 10)
    shards = start.count()
    assert ranked == [15 * shards]
    assert batch.count() == 10 * shards
    plan = plan_of(batch)
    assert "batch_id" in plan.split("PartitionFilters: [")[1].split("ReadSchema")[0]
    assert {key[2] // BATCH_SPAN for key in keys(batch)} == {1, 2}


def test_metadata_reads_no_payload(spark, folder):
    events = event_records(spark, "/root/testdata/sf0.001")
    put_records(route_records(events, "partition_key", 4), folder, 0)
    log = read_log(spark, folder, "error")
    plan = plan_of(shard_positions(log))
    assert "ReadSchema: struct<sequence_number:bigint>" in plan
    assert "stream" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_large_positions_are_not_broadcast(spark):
    log = records(spark, ROWS)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 10)
    try:
        batch = read_records(log, shard_positions(log), 3)
        assert "Broadcast" not in plan_of(batch)
        assert keys(batch) == page(ROWS, {("a", 0): 0, ("a", 1): 0, ("b", 0): 0}, 3)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_pages_by_the_index_agree_with_brute_force(spark, folder):
    """Two hundred batches, some without records of a shard; laggards, caught-up shards, new ones."""
    rng, folder = random.Random(5), f"{folder}/log"
    rows = [("s", shard_id, batch * BATCH_SPAN + n) for shard_id in range(3) for batch in range(200) for n in range(rng.randint(0, 6))]
    rows += [("late", 0, 150 * BATCH_SPAN + n) for n in range(40)]
    table = records(spark, rows).withColumn("batch_id", F.shiftright("sequence_number", 32))
    table.coalesce(1).write.partitionBy("batch_id", "stream", "shard_id").parquet(folder)
    adopt_batches(spark, folder)
    last = max(n for s, shard_id, n in rows if (s, shard_id) == ("s", 2))
    start = {("s", 0): 17 * BATCH_SPAN + 3, ("s", 1): 120 * BATCH_SPAN, ("s", 2): last + 1, ("late", 0): 0, ("new", 9): 0}
    at = positions(spark, [(*shard, n) for shard, n in start.items()])
    for limit in (0, 1, 7, 50):
        assert keys(read_page(spark, folder, at, limit)) == page(rows, start, limit)
    only = {shard: n for shard, n in start.items() if shard[0] == "s"}
    assert keys(read_page(spark, folder, at, 7, stream="s")) == page(rows, only, 7)
    with pytest.raises(ValueError):
        read_page(spark, folder, at, -1)
    index = read_index(spark, folder)
    inventory = shard_inventory(read_log(spark, folder)).collect()
    assert Counter(shard_inventory(index).collect()) == Counter(inventory)
    for position in ("trim_horizon", "latest"):
        want = shard_positions(read_log(spark, folder), position=position).collect()
        assert Counter(shard_positions(index, position=position).collect()) == Counter(want)
    assert [r.stream for r in list_streams(index).collect()] == ["late", "s"]
    assert positions_with_new_shards(index, positions(spark, [("s", 0, 5)])).count() == 4


def test_a_page_by_the_index_opens_two_batches_and_no_key_beside(spark, folder, monkeypatch):
    folder = f"{folder}/log"
    rows = [("s", 0, batch * BATCH_SPAN + n) for batch in range(200) for n in range(10)]
    table = records(spark, rows).withColumn("batch_id", F.shiftright("sequence_number", 32))
    table.coalesce(1).write.partitionBy("batch_id", "stream", "shard_id").parquet(folder)
    adopt_batches(spark, folder)
    at = positions(spark, [("s", 0, 88 * BATCH_SPAN + 6)])
    opened = []
    monkeypatch.setattr("shardstream.operators.positions._near_ranges", lambda *_: opened.append("keys"))
    found = read_page(spark, folder, at, 10)
    assert keys(found) == page(rows, {("s", 0): 88 * BATCH_SPAN + 6}, 10)
    plan = plan_of(found)
    assert re.search(r"PartitionFilters: .*batch_id#\d+L >= 88\), \(batch_id#\d+L <= 89\)", plan) and not opened
    # Metadata comes from commits: no data file is scanned.
    for asked in (list_streams, shard_inventory, shard_positions):
        plan = plan_of(asked(read_index(spark, folder)))
        assert "Scan parquet" not in plan and "_commits" in plan
