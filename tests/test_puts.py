from __future__ import annotations

import os
import random
import re
from collections import Counter
from pathlib import Path

import pytest
from helpers import EPOCH, landed, numbered, plan_of, records, shard, unrouted
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from shardstream import (
    INDEX,
    adopt_batches,
    advance,
    number_records,
    put_records,
    read_index,
    read_log,
    read_records,
    route_records,
    shard_inventory,
    shard_positions,
    shared,
)
from shardstream.operators import puts
from shardstream.operators.puts import BATCH_SPAN
from shardstream.shared import scratch_path
from shardstream.sources import commits

ROWS = [("s", f"k{n % 7}", n // 3, b"%d" % n) for n in range(60)]


def _put(spark, rows, log_dir, batch_id=0, shards=4, **options):
    routed = route_records(unrouted(spark, rows), "partition_key", shards)
    return put_records(routed, log_dir, batch_id, **options)


def _files(log_dir):
    return sorted(str(path.relative_to(log_dir)) for path in Path(log_dir).rglob("*.parquet"))


def test_routing(spark):
    routed = route_records(unrouted(spark, ROWS), "partition_key", 5).collect()
    assert len(routed) == len(ROWS)
    assert all(row.shard_id == shard(row.partition_key, 5) for row in routed)


def test_put_and_read_back(spark, folder):
    assert _put(spark, ROWS, folder)
    assert landed(read_log(spark, folder)) == numbered(ROWS, 4)
    assert all(path.startswith("batch_id=0/stream=s/shard_id=") for path in _files(folder))


def test_later_batches_have_higher_numbers(spark, folder):
    _put(spark, ROWS[:30], folder, 0)
    _put(spark, ROWS[30:], folder, 7)
    expected = numbered(ROWS[:30], 4) + numbered(ROWS[30:], 4, 7 * BATCH_SPAN)
    assert landed(read_log(spark, folder)) == sorted(expected)


def test_putting_a_batch_again_changes_nothing(spark, folder):
    assert _put(spark, ROWS, folder)
    files = _files(folder)
    assert not _put(spark, ROWS[:5], folder)
    assert _files(folder) == files


def test_a_put_that_died_while_writing_is_done_again(spark, folder):
    half = f"{folder}/_landing/batch_id=0/stream=s/shard_id=0"
    os.makedirs(half)
    unrouted(spark, ROWS[:3]).drop("stream").write.parquet(f"{half}/part")
    assert _put(spark, ROWS, folder)
    assert landed(read_log(spark, folder)) == numbered(ROWS, 4)


def test_a_dynamic_overwrite_setting_leaves_no_half_written_files(spark, folder):
    half = f"{folder}/_landing/batch_id=0/stream=gone/shard_id=0"
    os.makedirs(half)
    unrouted(spark, ROWS[:3]).drop("stream").coalesce(1).write.mode("append").parquet(half)
    os.remove(f"{half}/_SUCCESS")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        assert _put(spark, ROWS, folder)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert landed(read_log(spark, folder)) == numbered(ROWS, 4)


def test_a_put_needs_success_files(spark, folder):
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    setting = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    hadoop.set(setting, "false")
    try:
        with pytest.raises(OSError, match="_SUCCESS"):
            _put(spark, ROWS, folder)
    finally:
        hadoop.unset(setting)
    assert not os.path.exists(f"{folder}/batch_id=0")


class Broken(Exception):
    pass


def _put_and_die(spark, monkeypatch, rows, folder, batch_id, moves):
    """A put that dies after so many renames, where directories move file by file."""
    left, rename = [moves], shared.rename

    def dying(spark, source, target):
        if "batch_id=" in target or "_commits" in target:
            if os.path.isdir(source):
                os.makedirs(target)
                for path, _, names in os.walk(source):
                    for name in sorted(names):
                        inner = os.path.relpath(os.path.join(path, name), source)
                        dying(spark, f"{source}/{inner}", f"{target}/{inner}")
                return
            if not left[0]:
                raise Broken
            left[0] -= 1
        rename(spark, source, target)

    with monkeypatch.context() as patch:
        patch.setattr(shared, "rename", dying)
        with pytest.raises(Broken):
            _put(spark, rows, folder, batch_id)


@pytest.mark.parametrize("moves", range(5))
def test_a_batch_is_seen_whole_or_not_at_all(spark, folder, monkeypatch, moves):
    """Every state in which a put can break off: readers of pages and streams lose nothing."""
    _put(spark, ROWS, folder, 0)
    first = numbered(ROWS, 4)
    start = shard_positions(read_log(spark, folder))
    _put_and_die(spark, monkeypatch, ROWS, folder, 1, moves)
    log = read_log(spark, folder)
    assert landed(log) == first
    assert read_index(spark, folder).agg({"records": "sum"}).first()[0] == len(first)
    page = read_records(log, start, 10_000)
    assert landed(page) == first
    after = advance(start, page)
    # The put is done again, or a later one finds it.
    assert _put(spark, ROWS, folder, 1 + moves % 2)
    second = [row for batch_id in range(1, 2 + moves % 2) for row in numbered(ROWS, 4, batch_id * BATCH_SPAN)]
    assert landed(read_log(spark, folder)) == sorted(first + second)
    assert landed(read_records(read_log(spark, folder), after, 10_000)) == sorted(second)
    assert not _put(spark, ROWS, folder, 1)
    assert not os.path.exists(f"{folder}/_landing/batch_id=1")


def test_a_copy_that_broke_off_is_made_again(spark, folder, monkeypatch):
    _put_and_die(spark, monkeypatch, ROWS, folder, 0, 0)
    (source, *_) = sorted(Path(f"{folder}/_landing/batch_id=0").rglob("*.parquet"))
    half = Path(str(source).replace("_landing/", ""))
    half.parent.mkdir(parents=True)
    half.write_bytes(source.read_bytes()[:10])
    assert landed(read_log(spark, folder)) == []
    assert _put(spark, ROWS, folder)
    assert landed(read_log(spark, folder)) == numbered(ROWS, 4)


def test_the_commit_lists_what_was_put(spark, folder):
    _put(spark, ROWS, folder, 3)
    index = read_index(spark, folder)
    assert index.schema == INDEX
    log = read_log(spark, folder)
    want = shard_inventory(log).collect()
    assert Counter(index.drop("batch_id", "bytes").collect()) == Counter(want)
    files = [path for path in _files(folder) if path.endswith(".parquet")]
    assert sorted(f"batch_id=3/{path}" for path, _ in commits.files_of(Path(f"{folder}/_commits/3.json").read_text())) == files
    assert sum(os.path.getsize(f"{folder}/{path}") for path in files) == index.agg({"bytes": "sum"}).first()[0]


def test_batches_of_other_writers_are_adopted(spark, folder):
    _put(spark, ROWS, folder, 0)
    other = f"{folder}/other"
    names = ["2024", "a/b", "a=b c%20", "é_ü"]
    rows = [(name, n, n * BATCH_SPAN, "k", EPOCH, b"x") for n, name in enumerate(names)]
    table = records(spark, rows).withColumn("batch_id", F.shiftright("sequence_number", 32))
    table.write.partitionBy("batch_id", "stream", "shard_id").parquet(other)
    assert landed(read_log(spark, other)) == []
    with pytest.raises(OSError, match="adopt_batches"):
        _put(spark, ROWS, other, 2)
    assert adopt_batches(spark, other) == [0, 1, 2, 3]
    assert landed(read_log(spark, other)) == sorted((*row[:4], row[5]) for row in rows)
    assert sorted(r.stream for r in read_index(spark, other, from_batch=1, to_batch=2).collect()) == sorted(names[1:3])
    assert adopt_batches(spark, other) == [] and not _put(spark, ROWS, other, 1)


def test_ties_in_the_callers_order_number_alike_on_both_ways(spark):
    tied = [("s", "k", n // 50, b"payload %d" % n) for n in range(200)]
    routed = route_records(unrouted(spark, tied), "partition_key", 1)
    one = number_records(routed, ["arrival_ts"])
    ranges = number_records(routed.repartition(5), ["arrival_ts"], rows_per_task=20)
    assert landed(one) == landed(ranges) == numbered(tied, 1)


def test_an_unfinished_put_is_out_of_sight(spark, folder):
    _put(spark, ROWS, folder, 0)
    os.makedirs(f"{folder}/_landing", exist_ok=True)
    _put(spark, ROWS, f"{folder}/_landing", 1)
    assert landed(read_log(spark, folder)) == numbered(ROWS, 4)


def test_stream_names_survive_the_directory_layout(spark, folder):
    names = ["2024", "007", "a/b", "a=b c%20", "é_ü", "_hidden", ".dot", "null"]
    rows = [(name, "k", n, b"x") for n, name in enumerate(names)]
    _put(spark, rows, folder)
    assert landed(read_log(spark, folder)) == numbered(rows, 4)
    assert landed(read_log(spark, folder, "007")) == numbered(rows[1:2], 4)


@pytest.mark.parametrize(
    ("row", "message"),
    [
        (("s", None, 0, b"x"), "partition key"),
        ((None, "k", 0, b"x"), "needs a stream"),
        (("", "k", 0, b"x"), "needs a stream"),
    ],
)
def test_records_without_key_or_stream_are_refused(spark, folder, row, message):
    with pytest.raises(Exception, match=message):
        _put(spark, [*ROWS, row], folder)
    assert not os.path.exists(f"{folder}/batch_id=0")


def test_an_empty_put(spark, folder):
    assert _put(spark, [], folder)
    assert not _put(spark, ROWS, folder)
    assert read_log(spark, folder).isEmpty()


def test_too_many_records_for_a_batch(spark, monkeypatch):
    monkeypatch.setattr("shardstream.operators.puts.BATCH_SPAN", 3)
    with pytest.raises(ValueError, match="at most 3"):
        number_records(route_records(unrouted(spark, ROWS), "partition_key", 1))


@settings(max_examples=5, deadline=None)
@given(
    rows=st.lists(
        st.tuples(
            st.sampled_from(["hot", "hot", "cold"]),
            st.sampled_from(["a", "b"]),
            st.integers(0, 3),
            st.binary(max_size=1),
        ),
        min_size=1,
        max_size=150,
    ),
    shards=st.integers(1, 3),
)
def test_windows_and_ranges_give_the_numbers_brute_force_gives(spark, rows, shards):
    routed = route_records(unrouted(spark, rows).repartition(3), "partition_key", shards)
    expected = numbered(rows, shards, 100)
    assert landed(number_records(routed, base=100)) == expected
    assert landed(number_records(routed, base=100, rows_per_task=10)) == expected


def test_ranges_split_a_hot_shard_and_a_run_of_copies(spark):
    """A third of the rows are copies of one record, two thirds are in one shard."""
    rows = [("s", "hot", 5, b"copy")] * 1000 + [("s", "hot", n, b"x") for n in range(1000)]
    rows += [("s", "other", n, b"y") for n in range(1000)]
    random.Random(1).shuffle(rows)
    routed = route_records(unrouted(spark, rows).repartition(4), "partition_key", 16)
    staging = scratch_path(spark, "staging")
    result = number_records(routed, rows_per_task=300, staging=staging)
    assert landed(result) == numbered(rows, 16)
    sizes = [row["count"] for row in spark.read.parquet(f"{staging}/placed").groupBy("range").count().collect()]
    assert sum(sizes) == len(rows)
    assert len(sizes) == 10
    assert max(sizes) < 600


def test_many_small_shards_beyond_what_the_shuffle_can_take_go_by_ranges(spark):
    rows = [("s", f"k{n}", n, b"x") for n in range(400)]
    routed = route_records(unrouted(spark, rows), "partition_key", 97)
    staging = scratch_path(spark, "staging")
    result = number_records(routed, rows_per_task=50, staging=staging)
    assert landed(result) == numbered(rows, 97)
    assert os.path.exists(staging)


def test_put_by_ranges_cleans_up_its_staging(spark, folder):
    root = spark.conf.get("spark.checkpoint.dir")
    before = Counter(name for name in os.listdir(root) if "numbering" in name)
    assert _put(spark, ROWS, folder, rows_per_task=10)
    assert Counter(name for name in os.listdir(root) if "numbering" in name) == before
    assert landed(read_log(spark, folder)) == numbered(ROWS, 4)


def test_sizes_are_counted_on_the_key_columns(spark, folder):
    _put(spark, ROWS, folder)
    counted = read_log(spark, folder).groupBy("stream", "shard_id").count()
    assert "ReadSchema: struct<>" in plan_of(counted)


def _shuffled(df):
    """The columns that each shuffle of a plan takes along."""
    return [
        {re.sub("#.*", "", name) for name in names.split(", ")}
        for names in re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", plan_of(df))
    ]


LANDED = {"stream", "shard_id", "partition_key", "arrival_ts", "data"}


def test_a_put_stages_and_shuffles_only_what_it_needs(spark, folder, monkeypatch):
    given, shuffled, written = [], [], puts._written

    def watched(df, path):
        if path.endswith("/given"):
            given.append(set(df.columns))
        else:
            shuffled.append(_shuffled(df))
        return written(df, path)

    monkeypatch.setattr(puts, "_written", watched)
    routed = route_records(unrouted(spark, ROWS), "partition_key", 4)
    routed = routed.withColumn("rank", F.xxhash64("data")).withColumn("wide", F.repeat(F.lit("x"), 100))
    put_records(routed, folder, 0, ["rank"], rows_per_task=10)
    assert given == [LANDED | {"rank"}]
    assert shuffled == [[LANDED | {"rank", "position"}]]
    assert _shuffled(number_records(routed.drop("rank", "wide"))) == [LANDED]


@pytest.mark.parametrize("rows_per_task", [10, 1000])
@pytest.mark.parametrize("by_name", [True, False])
def test_a_put_in_the_order_of_a_column_that_is_not_landed(spark, folder, rows_per_task, by_name):
    order_by = ["rank" if by_name else F.col("rank") * 2]
    routed = route_records(unrouted(spark, ROWS), "partition_key", 4)
    routed = routed.withColumn("rank", -F.col("data").cast("string").cast("int"))
    put_records(routed.withColumn("sequence_number", F.lit(7)), folder, 0, order_by, rows_per_task=rows_per_task)
    order = {}
    for stream, shard_id, number, _, data in landed(read_log(spark, folder)):
        order.setdefault((stream, shard_id), []).append((number, int(data)))
    for found in order.values():
        assert [number for number, _ in sorted(found)] == list(range(len(found)))
        ranks = [rank for _, rank in sorted(found)]
        assert ranks == sorted(ranks, reverse=True)
    assert sum(map(len, order.values())) == len(ROWS)
