from __future__ import annotations

import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceworks.functions import (
    day_of_week,
    decode_envelope,
    digest_projection,
    encode_envelope,
    equals_ignore_case,
    matches_ignore_case,
    instants,
    register_functions,
    wall_clocks,
)
from tests.conftest import plan_of

FEED = (
    T.StructType()
    .add("id", T.LongType())
    .add("aggregated_id", T.StringType())
    .add("source", T.StringType())
    .add("version", T.IntegerType())
    .add("type", T.StringType())
    .add("createDate", T.TimestampType())
)


def test_equals_ignore_case_is_false_for_null(spark):
    df = spark.createDataFrame([("View",), ("view",), ("click",), (None,)], "t string")
    got = [r[0] for r in df.select(equals_ignore_case("t", "VIEW")).collect()]
    assert got == [True, True, False, False]


def test_filter_form_skips_nulls_in_the_scan(spark, tmp_path):
    spark.sql("SELECT explode(array('View', 'x', null)) AS t").write.parquet(f"{tmp_path}/t")
    kept = spark.read.parquet(f"{tmp_path}/t").where(matches_ignore_case("t", "vIEW"))
    assert [r[0] for r in kept.collect()] == ["View"]
    assert "PushedFilters: [IsNotNull(t)]" in plan_of(kept)


def test_equals_ignore_case_runs_in_generated_code(spark):
    df = spark.range(5).select(F.col("id").cast("string").alias("t"))
    assert "Python" not in plan_of(df.where(equals_ignore_case("t", "3")))


def test_day_of_week_numbers_from_sunday(spark):
    df = spark.createDataFrame([("2024-01-07",), ("2024-01-13",)], "d string")
    assert [r[0] for r in df.select(day_of_week(F.to_date("d"))).collect()] == [1, 7]
    register_functions(spark)
    assert spark.sql("SELECT day_of_week(DATE '2024-01-13')").first()[0] == 7


def test_bucket_keeps_the_sign(spark):
    df = spark.createDataFrame([(-105, datetime(2024, 1, 1))], "value bigint, timestamp timestamp")
    row = digest_projection(df, "value", "timestamp").first()
    assert row["id"] == -5
    assert row["md5"] == hashlib.md5(b"-105").hexdigest()


def test_zone_conversions_are_inverse(spark):
    df = spark.sql("SELECT 1 AS a, TIMESTAMP_NTZ '2024-05-05 01:02:03.456789' AS t")
    there = instants(df)
    assert there.schema["t"].dataType == T.TimestampType()
    assert wall_clocks(there).collect() == df.collect()


def test_envelope_keeps_microseconds(spark):
    row = (7, "a", "s", 1, "type1", datetime(2023, 1, 21, 12, 10, 10, 123456))
    df = spark.createDataFrame([row], FEED)
    packed = encode_envelope(df, "id")
    assert packed.columns == ["key", "value"] and packed.first()["key"] == "7"
    assert tuple(decode_envelope(packed, FEED).first()) == row


def test_envelope_reads_bad_messages_as_nulls(spark):
    good = '{"id":1,"aggregated_id":"a","source":"s","version":2,"type":"t"}'
    messages = spark.createDataFrame(
        [("a", good), ("b", None), ("c", good[:6]), ("d", good.replace("2", '"two"'))],
        "key string, value string",
    )
    got = {r["key"]: r for r in decode_envelope(messages, FEED, keep=("key",)).collect()}
    assert got["a"]["version"] == 2 and got["a"]["createDate"] is None
    assert got["b"]["id"] is None
    assert all(got["c"][n] is None for n in FEED.names)
    assert got["d"]["version"] is None and got["d"]["id"] == 1 and got["d"]["type"] == "t"


def test_envelope_without_key(spark):
    got = encode_envelope(spark.range(2), value="id").collect()
    assert sorted((r["key"], r["value"]) for r in got) == [(None, "0"), (None, "1")]


@pytest.mark.parametrize("name", ["key", "value"])
def test_envelope_columns_are_strings(spark, name):
    assert encode_envelope(spark.range(1), "id").schema[name].dataType == T.StringType()
