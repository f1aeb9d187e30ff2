from __future__ import annotations

import pytest
from helpers import shard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shardstream import decode_records
from shardstream.functions import decode, required, shard_of


def _payloads(spark, payloads):
    return spark.createDataFrame([(i, data) for i, data in enumerate(payloads)], "i int, data binary")


def test_bad_utf8_becomes_the_replacement_character(spark):
    (row,) = decode_records(_payloads(spark, [b"a\xffb"])).collect()
    assert row.value == "a�b"


def test_bad_utf8_can_fail_instead(spark):
    with pytest.raises(Exception, match="MALFORMED_CHARACTER_CODING"):
        decode_records(_payloads(spark, [b"a\xffb"]), "fail").collect()
    assert decode_records(_payloads(spark, ["é".encode()]), "fail").first().value == "é"
    with pytest.raises(ValueError):
        decode(F.col("data"), "ignore")


@settings(max_examples=5, deadline=None)
@given(payloads=st.lists(st.binary(max_size=40), max_size=200))
def test_decoding_is_that_of_a_lenient_utf8_reader(spark, payloads):
    rows = decode_records(_payloads(spark, payloads)).collect()
    expected = dict(enumerate(data.decode("utf-8", "replace") for data in payloads))
    assert {row.i: row.value for row in rows} == expected


@settings(max_examples=5, deadline=None)
@given(texts=st.lists(st.text(max_size=20), min_size=1, max_size=100), shards=st.integers(1, 300))
def test_shard_is_a_hash_of_the_key(spark, texts, shards):
    keys = spark.createDataFrame([(text,) for text in texts], "key string")
    rows = keys.select("key", shard_of(F.col("key"), shards).alias("shard")).collect()
    assert [row.shard for row in rows] == [shard(row.key, shards) for row in rows]


def test_a_stream_has_a_shard():
    with pytest.raises(ValueError):
        shard_of(None, 0)


def test_required_lets_values_pass_and_fails_on_null(spark):
    texts = spark.createDataFrame([("a",), (None,)], "t string")
    checked = required(F.col("t"), "no text").alias("t")
    assert texts.where("t is not null").select(checked).collect() == [("a",)]
    with pytest.raises(Exception, match="no text"):
        texts.select(checked).collect()
