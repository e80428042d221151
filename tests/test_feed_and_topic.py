from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceworks.functions import decode_envelope, encode_envelope
from sluiceworks.sources import (
    ENVELOPE,
    accepted,
    append_stream,
    csv_feed,
    from_offsets,
    pinned_ends,
    rate_stream,
    rejected,
)
from sluiceworks.streaming import finish, start
from tests.conftest import plan_of

FEED = (
    T.StructType()
    .add("id", T.LongType(), False)
    .add("aggregated_id", T.StringType(), False)
    .add("source", T.StringType(), False)
    .add("version", T.IntegerType(), False)
    .add("type", T.StringType(), False)
    .add("createDate", T.TimestampType(), False)
)
GOOD = [
    f"{1000 + i},test_{1000 + i}_1,test,1,type{1 + i % 2},2023-01-21 12:10:10" for i in range(10)
]
BAD = [
    "1x,a,s,1,t,2023-01-21 12:10:10",
    "2000,a,s,one,t,2023-01-21 12:10:10",
    "2001,a,s,1,t",
    "2002,a,s,1,t,2023-01-21 12:10:10,more",
    "2003,a,s,1,t,yesterday",
]
NO_ID = ",a,s,1,t,2023-01-21 12:10:10"


@pytest.fixture
def feed_dir(tmp_path):
    (tmp_path / "feed").mkdir()
    (tmp_path / "feed" / "raw.csv").write_text("\n".join([*GOOD, *BAD, NO_ID, ""]))
    return str(tmp_path / "feed")


@pytest.mark.parametrize("streaming", [True, False])
@pytest.mark.parametrize("columns", [["*"], ["id"]])
def test_malformed_lines_are_dropped_whatever_is_selected(
    spark, feed_dir, tmp_path, streaming, columns
):
    rows = accepted(csv_feed(spark, feed_dir, FEED, streaming=streaming), ("id",)).select(*columns)
    if streaming:
        finish(start(rows, f"{tmp_path}/checkpoint", f"{tmp_path}/out"))
        rows = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(r["id"] for r in rows.collect()) == list(range(1000, 1010))


def test_counts_and_rejects(spark, feed_dir):
    feed = csv_feed(spark, feed_dir, FEED, streaming=False)
    assert accepted(feed).count() == 11  # an empty id is well-formed unless required
    assert accepted(feed, ("id",)).count() == 10
    assert sorted(r["line"] for r in rejected(feed, ("id",)).collect()) == sorted([*BAD, NO_ID])


def test_clock_of_the_timestamp_format(spark, tmp_path):
    (tmp_path / "raw.csv").write_text(GOOD[0] + "\n" + GOOD[1].replace("12:10", "13:10"))
    hours = {}
    for pattern in ("HH", "hh"):
        feed = csv_feed(spark, str(tmp_path), FEED, f"yyyy-MM-dd {pattern}:mm:ss", streaming=False)
        hours[pattern] = sorted(r["createDate"].hour for r in accepted(feed).collect())
    assert hours == {"HH": [12, 13], "hh": [0]}


def enveloped(rows, key):
    """Rows as messages of two partitions by ``key``, densely numbered."""
    return encode_envelope(rows, key, keep=(key,)).select(
        "key",
        "value",
        F.lit("t").alias("topic"),
        (F.col(key) % 2).cast("int").alias("partition"),
        F.expr(f"{key} div 2").alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )


def test_feed_to_messages_and_back(spark, feed_dir, tmp_path):
    feed = accepted(csv_feed(spark, feed_dir, FEED), ("id",))
    finish(start(enveloped(feed, "id"), f"{tmp_path}/checkpoint", f"{tmp_path}/topic"))
    rows = spark.read.schema(ENVELOPE).parquet(f"{tmp_path}/topic")
    messages = from_offsets(rows, "t", '{"t": {"0": 501, "1": 500}}')
    assert messages.columns == ["key", "value", "topic", "partition", "offset", "timestamp"]
    back = decode_envelope(messages, FEED, keep=("offset",)).orderBy("id").collect()
    assert [(r["id"], r["offset"]) for r in back] == [(1000 + i, 500 + i // 2) for i in range(1, 10)]
    assert back[0]["createDate"] == datetime(2023, 1, 21, 12, 10, 10)


def send(spark, place, first, count):
    messages = enveloped(spark.range(first, first + count), "id")
    messages.write.mode("append").parquet(place)


def read(spark, place, *args, **kwargs):
    rows = spark.read.schema(ENVELOPE).parquet(place)
    got = from_offsets(rows, "t", *args, **kwargs).collect()
    return sorted((r["partition"], r["offset"], int(r["key"])) for r in got)


def test_starting_and_ending_offsets(spark, tmp_path):
    place = f"{tmp_path}/topic"
    send(spark, place, 0, 10)
    everything = read(spark, place)
    ends = {0: 5, 1: 5}
    assert everything == sorted((k % 2, k // 2, k) for k in range(10))
    assert read(spark, place, "earliest") == everything
    assert read(spark, place, "latest", latest=ends) == []
    assert read(spark, place, {"t": {"0": 3}}) == [r for r in everything if r[0] == 1 or r[1] >= 3]
    some = json.dumps({"t": {"0": -2, "1": -1}})
    assert read(spark, place, some, latest=ends) == [r for r in everything if r[0] == 0]
    ending = {"t": {"0": 2, "1": -1}}
    assert read(spark, place, "earliest", ending) == [r for r in everything if r[0] == 1 or r[1] < 2]
    for starting in ("latest", some):
        with pytest.raises(ValueError, match="pinned_ends"):
            read(spark, place, starting)


def test_offset_filter_reaches_parquet(spark, tmp_path):
    send(spark, f"{tmp_path}/topic", 0, 10)
    rows = spark.read.schema(ENVELOPE).parquet(f"{tmp_path}/topic")
    plan = plan_of(from_offsets(rows, "t", {"t": {"0": 3}}).select("value"))
    assert "Or(Not(EqualTo(partition,0)),GreaterThanOrEqual(offset,3))" in plan


def test_topic_as_a_stream_sees_new_messages_once(spark, tmp_path):
    place = f"{tmp_path}/topic"
    for n in range(3):
        send(spark, place, 10 * n, 10)
        rows = from_offsets(append_stream(spark, place, ENVELOPE), "t").select("key")
        finish(start(rows, f"{tmp_path}/checkpoint", f"{tmp_path}/out"))
    got = sorted(int(r["key"]) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == list(range(30))


def test_a_restart_from_latest_returns_what_came_between(spark, tmp_path):
    place = f"{tmp_path}/topic"
    for n in range(3):
        send(spark, place, 10 * n, 10)
        ends = pinned_ends(spark, spark.read.parquet(place), "t", f"{tmp_path}/ends")
        arriving = append_stream(spark, place, ENVELOPE)
        rows = from_offsets(arriving, "t", "latest", latest=ends).select("key")
        finish(start(rows, f"{tmp_path}/checkpoint", f"{tmp_path}/out"))
    got = sorted(int(r["key"]) for r in spark.read.schema("key string").parquet(f"{tmp_path}/out").collect())
    assert got == list(range(10, 30))


def test_rate_counts_from_zero(spark, tmp_path):
    rows = rate_stream(spark, rows_per_batch=25, partitions=3)
    assert rows.columns == ["timestamp", "value"]
    finish(start(rows, f"{tmp_path}/checkpoint", f"{tmp_path}/out"))
    got = sorted(r["value"] for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == list(range(25))


def test_rate_on_the_clock(spark, tmp_path):
    rows = rate_stream(spark, rows_per_second=10, partitions=10)
    query = start(rows, f"{tmp_path}/checkpoint", f"{tmp_path}/out", every="1 second")
    assert not finish(query, timeout=8)
    assert not query.isActive
    got = sorted(r["value"] for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got and got == list(range(len(got)))
