from __future__ import annotations

import sqlite3
from datetime import date, datetime

import pytest
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceworks.operators import merge_into
from sluiceworks.sources import register_stream_source
from sluiceworks.sources.stream_source import (
    IncrementalTableSource,
    _Database,
    _RangeStream,
    cuts,
    spark_type,
)
from sluiceworks.streaming import finish, start


@pytest.fixture
def db(tmp_path):
    path = f"{tmp_path}/rows.db"
    run(path, "CREATE TABLE random_stream (id INTEGER, name TEXT, amount REAL, ts TIMESTAMP)")
    return path


def run(path, sql, rows=()):
    connection = sqlite3.connect(path)
    connection.executemany(sql, rows) if rows else connection.execute(sql)
    connection.commit()
    connection.close()


def insert(path, ids):
    rows = [(i, f"n{i}", i / 2, f"2024-01-01 00:00:{i:02}") for i in ids]
    run(path, "INSERT INTO random_stream VALUES (?, ?, ?, ?)", rows)


def options(path, **more):
    given = {"connect": "sqlite3:connect", "url": path, "dbtable": "random_stream", "offsetColumn": "ID"}
    return {**given, **{k: str(v) for k, v in more.items()}}


def test_a_stream_goes_on_after_a_restart(spark, db, tmp_path):
    register_stream_source(spark)
    insert(db, range(1, 8))

    def once():
        rows = spark.readStream.format("jdbc-streaming").options(**options(db, numPartitions=3)).load()
        finish(start(rows, f"{tmp_path}/checkpoint", f"{tmp_path}/out"))
        return sorted(r["id"] for r in spark.read.schema(rows.schema).parquet(f"{tmp_path}/out").collect())

    assert once() == list(range(1, 8))
    assert once() == list(range(1, 8))
    insert(db, [7, 8, 9])  # the second 7 comes too late
    assert once() == list(range(1, 10))


def test_it_joins_like_any_stream(spark, db, tmp_path):
    register_stream_source(spark)
    insert(db, range(1, 5))
    names = spark.createDataFrame([(2, "two"), (3, "three")], "id bigint, word string")
    rows = spark.readStream.format("jdbc-streaming").options(**options(db)).load()
    joined = rows.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "1 minute")
    finish(start(joined.join(names, "id"), f"{tmp_path}/checkpoint", f"{tmp_path}/out"))
    assert sorted(r["word"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["three", "two"]


def ranges(reader, start_offset, end_offset):
    found = []
    for query in reader.partitions(start_offset, end_offset):
        found += [v for batch in reader.read(query) for v in batch.column(0).to_pylist()]
    return sorted(found)


def reader_of(path, **more):
    database = _Database(options(path, **more))
    return _RangeStream(database, database.schema())


def test_schema_comes_from_the_table(db):
    insert(db, [1])
    schema = IncrementalTableSource(options(db)).schema()
    assert schema.simpleString() == "struct<id:bigint,name:string,amount:double,ts:timestamp_ntz>"


@pytest.mark.parametrize(
    "more,expected",
    [
        ({}, list(range(1, 11))),
        ({"startingOffset": "latest"}, [10]),
        ({"startingOffset": "4"}, list(range(4, 11))),
        ({"startingOffset": "99"}, []),
        ({"numPartitions": 4}, list(range(1, 11))),
        ({"numPartitions": 40}, list(range(1, 11))),
        ({"numPartitions": 4, "splitColumn": "id"}, list(range(1, 11))),
    ],
)
def test_first_range(db, more, expected):
    insert(db, range(1, 11))
    reader = reader_of(db, **more)
    assert ranges(reader, reader.initialOffset(), reader.latestOffset()) == expected


@pytest.mark.parametrize("parts", [1, 3])
def test_next_range_and_no_change(db, parts):
    reader = reader_of(db, numPartitions=parts)
    assert reader.latestOffset() == reader.initialOffset()
    assert reader.partitions(reader.initialOffset(), reader.latestOffset()) == []
    insert(db, [3, 4])
    reader = reader_of(db, numPartitions=parts)
    first = reader.latestOffset()
    assert first == {"columnName": "id", "range": {"end": 4}}
    assert reader.partitions(first, first) == []
    insert(db, [4, 5, 9])
    assert ranges(reader, first, reader.latestOffset()) == [5, 9]


def test_position_does_not_move_back_in_one_run(db):
    insert(db, [1, 5])
    reader = reader_of(db)
    first = reader.latestOffset()
    run(db, "DELETE FROM random_stream WHERE id = 5")
    assert reader.latestOffset() == first


def test_position_does_not_move_back_over_a_restart(spark, db, tmp_path):
    register_stream_source(spark)
    insert(db, range(1, 10))

    def once():
        given = options(db, positionPath=f"{tmp_path}/position")
        rows = spark.readStream.format("jdbc-streaming").options(**given).load()
        finish(start(rows, f"{tmp_path}/checkpoint", f"{tmp_path}/out"))
        return sorted(r["id"] for r in spark.read.schema(rows.schema).parquet(f"{tmp_path}/out").collect())

    assert once() == list(range(1, 10))
    run(db, "DELETE FROM random_stream WHERE id > 4")
    assert once() == list(range(1, 10))
    insert(db, range(5, 12))  # 5 to 9 were delivered before
    assert once() == list(range(1, 12))


def test_times_as_offsets_are_split(db):
    insert(db, range(1, 50))
    reader = reader_of(db, offsetColumn="TS", numPartitions=5)
    end = reader.latestOffset()
    assert len(reader.partitions(reader.initialOffset(), end)) == 5
    assert ranges(reader, reader.initialOffset(), end) == list(range(1, 50))


def test_cuts():
    day = date(2024, 1, 1)
    assert cuts(0, 10, 3) == [0, 3, 6, 10]
    assert cuts(2**60, 2**60 + 4, 2) == [2**60, 2**60 + 2, 2**60 + 4]
    assert cuts(day, day.replace(day=3), 2) == [day, day.replace(day=2), day.replace(day=3)]
    assert cuts("a", "b", 4) == ["a", "b"] and cuts(1, 1, 4) == [1, 1]
    a, b = datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 2)
    assert cuts(a, b, 2) == [a, datetime(2024, 1, 1, 0, 0, 1), b]


def test_types_come_from_declarations():
    names = {
        "INTEGER": "bigint", "character varying": "string", "timestamp without time zone": "timestamp_ntz",
        "timestamp with time zone": "timestamp", "NUMERIC(10, 2)": "decimal(10,2)", "double precision": "double",
        "bytea": "binary", "date": "date", "boolean": "boolean",
    }
    for declared, expected in names.items():
        assert spark_type(declared).simpleString() == expected
    for unknown in ("", "geometry"):
        with pytest.raises(ValueError, match="give the stream a schema"):
            spark_type(unknown)


def login(url, user=None, password=None):
    assert (user, password) == ("me", "secret")
    return sqlite3.connect(url)


def test_user_and_password_reach_the_driver(db):
    given = options(db, user="me", password="secret")
    given["driver"] = f"{__name__}:login"
    del given["connect"]
    assert _Database(given).one("SELECT 1") == 1


def test_missing_options(db):
    for name in ("connect", "url", "dbtable", "offsetColumn"):
        given = options(db)
        del given[name]
        with pytest.raises(ValueError, match="missing"):
            _Database(given)
    with pytest.raises(ValueError, match="no column"):
        reader_of(db, offsetColumn="nope")


@pytest.mark.parametrize(
    "kind,value",
    [
        (T.TimestampType(), datetime(2024, 1, 1, 2, 3, 4, 5)),
        (T.DateType(), date(2024, 1, 1)),
        (T.LongType(), 5),
        (T.DoubleType(), 0.1),
        (T.StringType(), "it's"),
    ],
)
def test_offsets_survive_json(db, kind, value):
    database = _Database(options(db))
    reader = _RangeStream(database, T.StructType().add("id", kind))
    assert reader._load(reader._store(value)) == value


def test_catalog_merge_needs_a_row_level_catalog(spark):
    spark.range(3).selectExpr("id", "id AS seq").write.saveAsTable("plain_rows", mode="overwrite")
    with pytest.raises(UnsupportedOperationException):
        merge_into(spark.range(2).selectExpr("id", "id AS seq"), "plain_rows", ["id"], ["seq"])
