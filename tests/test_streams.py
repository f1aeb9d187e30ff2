from __future__ import annotations

from collections import Counter
from datetime import datetime

import pytest
from helpers import keys, records

from shardstream import (
    batch_stats,
    decode_records,
    microbatch_counts,
    preview,
    read_csv_with_header,
    union_streams,
)

ROWS = [("s", shard, n) for shard in range(3) for n in range(20)]


def test_union_keeps_copies_and_matches_columns_by_name(spark):
    df = records(spark, ROWS)
    turned = df.select(*reversed(df.columns))
    assert Counter(keys(union_streams([df, turned, df]))) == Counter(ROWS * 3)
    with pytest.raises(ValueError):
        union_streams([])


def test_decoding_and_repartitioning_keep_all_records(spark):
    df = decode_records(records(spark, ROWS).repartition(7))
    assert keys(df) == sorted(ROWS)
    assert df.columns[-1] == "value"


def test_stats_count_empty_partitions(spark):
    df = records(spark, ROWS[:3]).repartition(9)
    assert batch_stats(df).collect() == [(3, 9)]
    assert batch_stats(records(spark, [])).first().records == 0


def test_preview(spark):
    df = records(spark, ROWS)
    assert preview(df, 5).count() == 5
    assert preview(df, 500).count() == len(ROWS)
    assert preview(df, 0).count() == 0
    assert keys(preview(df, 4, ["sequence_number", "shard_id"])) == [
        ("s", 0, 0),
        ("s", 0, 1),
        ("s", 1, 0),
        ("s", 2, 0),
    ]


def test_intervals_without_records_are_absent(spark):
    df = records(spark, [("s", 0, 0), ("s", 1, 9), ("s", 0, 10), ("s", 0, 45)])
    counts = {row.batch_start: row.records for row in microbatch_counts(df, "10 seconds").collect()}
    assert counts == {
        datetime(2024, 1, 1, 0, 0, 0): 2,
        datetime(2024, 1, 1, 0, 0, 10): 1,
        datetime(2024, 1, 1, 0, 0, 40): 1,
    }


def test_csv_columns_are_strings_named_by_the_header(spark, folder):
    path = f"{folder}/t.csv"
    with open(path, "w") as out:
        out.write('id,text,n\n1,"a, b",\n02,c,3.50\n')
    df = read_csv_with_header(spark, path)
    assert df.dtypes == [("id", "string"), ("text", "string"), ("n", "string")]
    assert sorted(map(tuple, df.collect())) == [("02", "c", "3.50"), ("1", "a, b", None)]
