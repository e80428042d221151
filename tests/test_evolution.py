from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceworks.functions.evolution import conformed, merged_type, wider
from sluiceworks.operators import KeyedTable, key_join, pinned_hot_keys
from sluiceworks.streaming import finish, start


def struct(spark, ddl):
    return spark.createDataFrame([], ddl).schema


A = "id int, s struct<a:int,b:struct<x:float>>, l array<struct<p:int>>, m map<string,struct<u:int>>"
B = "m map<string,struct<v:string,u:bigint>>, S struct<B:struct<y:string,x:double>,a:bigint,c:date>, l array<struct<q:int,p:smallint>>, z int"


def test_types_merge_at_any_depth(spark):
    merged = merged_type(struct(spark, A), struct(spark, B))
    assert merged.simpleString() == (
        "struct<id:int,s:struct<a:bigint,b:struct<x:double,y:string>,c:date>,"
        "l:array<struct<p:int,q:int>>,m:map<string,struct<u:bigint,v:string>>,z:int>"
    )


def test_rows_conform_with_nulls_where_they_lack_fields(spark):
    merged = merged_type(struct(spark, A), struct(spark, B))
    row = (1, (2, (0.5,)), [(3,), None], {"k": (4,), "n": None})
    df = spark.createDataFrame([row, (2, None, None, None), (3, (None, None), [], {})], A)
    found = conformed(df, merged).orderBy("id").collect()
    plain = [r.asDict(recursive=True) for r in found]
    assert plain[0] == {
        "id": 1,
        "s": {"a": 2, "b": {"x": 0.5, "y": None}, "c": None},
        "l": [{"p": 3, "q": None}, None],
        "m": {"k": {"u": 4, "v": None}, "n": None},
        "z": None,
    }
    assert plain[1]["s"] is None and plain[1]["l"] is None and plain[2]["s"] == {"a": None, "b": None, "c": None}


def test_wider_types():
    d = T.DecimalType
    assert wider(T.IntegerType(), T.LongType()) == wider(T.LongType(), T.ByteType()) == T.LongType()
    assert wider(T.IntegerType(), T.DoubleType()) == wider(T.FloatType(), T.DoubleType()) == T.DoubleType()
    assert wider(T.LongType(), T.DoubleType()) is None and wider(T.StringType(), T.LongType()) is None
    assert wider(d(10, 2), d(8, 4)) == d(12, 4) and wider(d(38, 0), d(38, 10)) is None
    assert wider(T.IntegerType(), d(12, 2)) == d(12, 2) and wider(T.IntegerType(), d(11, 2)) is None


def test_what_does_not_merge_is_named(spark):
    with pytest.raises(ValueError, match=r"s\.a is int and string"):
        merged_type(struct(spark, "s struct<a:int>"), struct(spark, "s struct<a:string>"))
    with pytest.raises(ValueError, match="keys of the map m"):
        merged_type(struct(spark, "m map<int,int>"), struct(spark, "m map<string,int>"))


def test_a_merge_grows_structs_and_types(spark, tmp_path):
    one = spark.createDataFrame([(1, (1, "a"), 1), (2, (2, "b"), 2)], "k int, s struct<n:int,t:string>, w int")
    two = spark.createDataFrame([(2, (2**40, 0.5), 2**40), (3, None, None)], "k int, s struct<n:bigint,d:double>, w bigint")
    for order, name in (((one, two), "a"), ((two, one), "b")):
        table = KeyedTable.create_if_absent(spark, f"{tmp_path}/{name}", order[0].schema, ["k"], buckets=2)
        for n, rows in enumerate(order):
            table.merge(rows, ["k"], n)
        plain = {r["k"]: r.asDict(recursive=True) for r in table.read().collect()}
        want = {"n": 2**40, "t": None, "d": 0.5} if name == "a" else {"n": 2, "t": "b", "d": None}
        assert plain[2]["s"] == want and plain[2]["w"] == (2**40 if name == "a" else 2)
        assert plain[1]["s"] == {"n": 1, "t": "a", "d": None} and plain[3]["s"] is None
        assert dict(table.read().dtypes)["w"] == "bigint"
    with pytest.raises(ValueError, match="key k"):
        table.merge(one.withColumn("k", F.col("k").cast("bigint")), ["k"])


def test_pinned_hot_keys_keep_their_types(spark, tmp_path):
    values = (date(2024, 2, 29), datetime(2024, 1, 1, 1, 2, 3, 4), Decimal("1.50"), b"\0\xff", 0.1, 7, "x", None, True)
    hot = [(values, 2, 3), ((1,) * 9, 1, 4)]
    assert pinned_hot_keys(spark, f"{tmp_path}/keys", hot) == hot
    again = pinned_hot_keys(spark, f"{tmp_path}/keys")
    assert again == hot and [type(v) for v in again[0][0]] == [type(v) for v in values]
    assert pinned_hot_keys(spark, f"{tmp_path}/keys", hot) == hot


def test_join_that_keeps_rows_for_some_time(spark, tmp_path):
    """Rows that are further apart don't meet, and old ones leave the state."""
    base = datetime(2024, 1, 1)
    days = [0, 1, 2, 40, 80, 120]
    rows = [(d, base + timedelta(days=d)) for d in days]
    left, right = "k int, l int, lt timestamp", "rk int, r int, rt timestamp"
    states = []
    for n, (d, t) in enumerate(rows):
        spark.createDataFrame([(1, d, t)], left).write.mode("append").parquet(f"{tmp_path}/l")
        spark.createDataFrame([(1, d, t)], right).write.mode("append").parquet(f"{tmp_path}/r")
        streams = [spark.readStream.schema(s).parquet(f"{tmp_path}/{p}") for s, p in ((left, "l"), (right, "r"))]
        joined = key_join(*streams, [("k", "rk")], keep=timedelta(days=1), times=("lt", "rt"), delays=("0 days", "0 days"))
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "true")
        query = start(joined.select("l", "r"), f"{tmp_path}/checkpoint", f"{tmp_path}/out")
        finish(query)
        spark.conf.unset("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows")
        states.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    found = sorted(tuple(r) for r in spark.read.schema("l int, r int").parquet(f"{tmp_path}/out").collect())
    assert found == sorted((a, b) for a in days for b in days if abs(a - b) <= 1)
    assert max(states[3:]) <= 4 and max(states) > states[-1]
    with pytest.raises(ValueError):
        key_join(*streams, [("k", "rk")], keep=timedelta(days=1))
