from __future__ import annotations

import json
import time
from collections import Counter
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluiceworks.sources import (
    FrameTable,
    IncrementalReader,
    JdbcTable,
    OffsetRange,
    append_stream,
    jdbc_stream,
    offset_bounds,
)
from sluiceworks.storage import scratch_dir
from sluiceworks.streaming import append_batches
from sluiceworks.streaming.sinks import read_batches
from tests.conftest import plan_of

DERBY = "org.apache.derby.jdbc.EmbeddedDriver"


class Source:
    """A table in memory that a test changes between polls."""

    def __init__(self, spark, rows=(), schema="id int, off bigint"):
        self.spark, self.rows, self.schema = spark, list(rows), schema

    def load(self):
        return self.spark.createDataFrame(self.rows, self.schema)

    def reader(self, log, column="off", **options):
        return IncrementalReader(self.spark, FrameTable(self.load, column), str(log), **options)


def ids(batch):
    return sorted(r["id"] for r in batch.df.collect())


def take(reader):
    batch = reader.next_batch()
    found = None if batch is None else ids(batch)
    if batch is not None:
        reader.commit(batch)
    return found


def test_first_range_includes_both_ends(spark, tmp_path):
    rows = [(1, 10), (2, 20), (3, 30), (4, 30)]
    assert take(Source(spark, rows).reader(tmp_path / "a")) == [1, 2, 3, 4]
    assert take(Source(spark, rows).reader(tmp_path / "b", starting="latest")) == [3, 4]
    assert take(Source(spark, rows).reader(tmp_path / "c", starting="20")) == [2, 3, 4]
    assert take(Source(spark, rows).reader(tmp_path / "d", starting="15")) == [2, 3, 4]


def test_next_range_excludes_the_previous_end(spark, tmp_path):
    source = Source(spark, [(1, 10), (2, 20)])
    reader = source.reader(tmp_path)
    assert take(reader) == [1, 2]
    source.rows += [(3, 20), (4, 21), (5, 40)]
    assert take(reader) == [4, 5]  # 3 came too late for its offset


def test_nothing_new_gives_no_batch(spark, tmp_path):
    source = Source(spark)
    reader = source.reader(tmp_path)
    assert reader.next_batch() is None
    source.rows = [(1, 10)]
    assert take(reader) == [1]
    assert reader.next_batch() is None


def test_a_literal_start_beyond_the_table_waits(spark, tmp_path):
    source = Source(spark, [(1, 10)])
    reader = source.reader(tmp_path, starting="100")
    assert reader.next_batch() is None
    source.rows += [(2, 60)]
    assert reader.next_batch() is None
    source.rows += [(3, 100), (4, 101)]
    assert take(reader) == [3, 4]


def test_null_offsets_do_not_stall_the_reader(spark, tmp_path):
    source = Source(spark, [(1, None), (2, 10)])
    assert take(source.reader(tmp_path)) == [2]
    assert tuple(offset_bounds(source.load(), "off").first()) == (10, 10)


def test_a_smaller_maximum_does_not_move_the_position_back(spark, tmp_path):
    source = Source(spark, [(1, 10), (2, 20)])
    reader = source.reader(tmp_path)
    assert take(reader) == [1, 2]
    source.rows = [(1, 10), (3, 15)]
    assert reader.next_batch() is None
    source.rows += [(4, 25)]
    assert take(reader) == [4]


def test_offsets_compare_as_typed_values(spark, tmp_path):
    source = Source(spark, [(1, 9)])
    reader = source.reader(tmp_path)
    assert take(reader) == [1]
    source.rows += [(2, 10)]  # "10" < "9" as text
    assert take(reader) == [2]


@pytest.mark.parametrize(
    "kind,values",
    [
        ("timestamp", [datetime(2024, 1, 1, 0, 0, 0, 123456), datetime(2024, 1, 1, 0, 0, 0, 123457)]),
        ("timestamp_ntz", [datetime(2024, 1, 1, 0, 0, 0, 1), datetime(2024, 1, 1, 0, 0, 0, 2)]),
        ("date", [date(2024, 1, 1), date(2024, 1, 2)]),
        ("double", [0.1, 0.30000000000000004]),
        ("string", ["it's", "it's not"]),
    ],
)
def test_offset_types(spark, tmp_path, kind, values):
    source = Source(spark, [(1, values[0])], f"id int, off {kind}")
    assert take(source.reader(tmp_path)) == [1]
    source.rows += [(2, values[1])]
    assert take(source.reader(tmp_path)) == [2]
    assert source.reader(tmp_path).next_batch() is None


def test_column_is_found_ignoring_case(spark, tmp_path):
    source = Source(spark, [(1, 10)])
    reader = source.reader(tmp_path, column="OFF")
    assert take(reader) == [1]
    assert json.loads((tmp_path / "offsets" / f"{0:012d}").read_text())["columnName"] == "off"
    with pytest.raises(ValueError):
        source.reader(tmp_path, column="missing")


def test_offset_entry_is_checked():
    text = '{"columnName": "ts", "range": {"start": "1", "end": "2"}}'
    assert json.loads(OffsetRange.from_json(text).to_json()) == json.loads(text)
    for bad in (
        '{"columnName": "ts", "range": {"start": "1", "end": "2"}, "more": 1}',
        '{"columnName": "ts", "range": {"start": "1", "end": "2", "more": 1}}',
        '{"columnName": "ts", "range": {"start": "1"}}',
        '{"columnName": "ts", "range": {"end": "1"}}',
        '{"columnName": "ts", "range": {"start": null, "end": "1"}}',
        '{"range": {"start": "1", "end": "2"}}',
    ):
        with pytest.raises(ValueError):
            OffsetRange.from_json(bad)


def test_uncommitted_range_comes_back_with_the_same_bounds(spark, tmp_path):
    source = Source(spark, [(1, 10), (2, 20)])
    lost = source.reader(tmp_path).next_batch()
    source.rows += [(3, 30)]
    again = source.reader(tmp_path)
    batch = again.next_batch()
    assert (batch.batch_id, batch.range) == (lost.batch_id, lost.range)
    assert ids(batch) == [1, 2]
    again.commit(batch)
    assert take(source.reader(tmp_path)) == [3]


def test_failure_between_write_and_commit_leaves_one_copy(spark, tmp_path):
    source = Source(spark, [(i, i) for i in range(10)])
    write = append_batches(f"{tmp_path}/rows")

    def write_and_die(df, batch_id):
        write(df, batch_id)
        raise RuntimeError

    with pytest.raises(RuntimeError):
        source.reader(tmp_path / "log").run(write_and_die)
    source.rows += [(10, 10)]
    assert source.reader(tmp_path / "log").run(write) == 2
    rows = read_batches(spark, f"{tmp_path}/rows", source.load().schema)
    assert sorted((r["id"], r["batchId"]) for r in rows.collect()) == [
        *((i, 0) for i in range(10)),
        (10, 1),
    ]


def test_lag_holds_the_end_back(spark, tmp_path):
    source = Source(spark, [(i, i) for i in range(11)])
    reader = source.reader(tmp_path, lag=F.lit(3))
    assert take(reader) == list(range(8))
    assert reader.next_batch() is None
    source.rows += [(11, 14)]
    assert take(reader) == [8, 9, 10]


def test_lag_on_timestamps(spark, tmp_path):
    rows = [(i, datetime(2024, 1, 1, 0, i)) for i in range(10)]
    source = Source(spark, rows, "id int, off timestamp")
    assert take(source.reader(tmp_path, lag=F.expr("INTERVAL 2 MINUTES"))) == list(range(8))


def drain(reader):
    batches = []
    reader.run(lambda df, _id: batches.append(sorted((r["off"], r["id"]) for r in df.collect())))
    return batches


offsets = st.lists(
    st.one_of(st.none(), st.integers(-5, 5), st.sampled_from([10**6, -(10**15)])), max_size=25
)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(parts=st.lists(offsets, min_size=1, max_size=3), limit=st.one_of(st.none(), st.integers(1, 6)))
def test_every_row_comes_exactly_once(spark, parts, limit):
    """For any split of rows into arrivals whose offsets grow."""
    source, number, shift = Source(spark), 0, 0
    log = scratch_dir(spark, "log")
    seen, expected = [], []
    for part in parts:
        known = [o for o in part if o is not None]
        shift += 10**16  # arrivals later than all before
        for off in part:
            source.rows.append((number, None if off is None else off + shift))
            if off is not None:
                expected.append((off + shift, number))
            number += 1
        batches = drain(source.reader(log, max_rows_per_batch=limit))
        assert bool(batches) == bool(known)
        seen += [row for batch in batches for row in batch]
    assert sorted(seen) == sorted(expected)


def test_bounded_batches(spark, tmp_path):
    """At most the limit, except where rows share an offset."""
    rows = [(i, i // 3) for i in range(300)] + [(1000 + i, 50) for i in range(100)]
    batches = drain(Source(spark, rows).reader(tmp_path, max_rows_per_batch=20))
    assert sum(len(b) for b in batches) == 400
    for batch in batches:
        assert len(batch) <= 20 or len({off for off, _ in batch}) == 1
    assert Counter(off for b in batches for off, _ in b)[50] == 103


def test_bounded_batches_with_a_far_outlier(spark, tmp_path):
    rows = [(i, i) for i in range(200)] + [(999, 10**14)]
    batches = drain(Source(spark, rows).reader(tmp_path, max_rows_per_batch=50))
    assert [len(b) for b in batches][-1] >= 1 and all(len(b) <= 50 for b in batches)
    assert sum(len(b) for b in batches) == 201


def sized(batches):
    """Each batch as its number of rows and of offsets, None for a null."""
    return [(len(b), len({off for off, _ in b})) for b in batches]


@pytest.mark.parametrize(
    ("kind", "value"),
    [
        ("string", lambda i: f"{'zäa€'[i % 4]}'{i // 7:05d}"),
        ("decimal(30,10)", lambda i: Decimal(i // 3) / 7 + 10**18),
        ("date", lambda i: date(2020, 1, 1) + timedelta(days=i // 5)),
        ("timestamp", lambda i: datetime(2020, 1, 1) + timedelta(microseconds=i * i)),
        ("timestamp_ntz", lambda i: datetime(2020, 3, 29) + timedelta(minutes=i)),
        ("double", lambda i: {1: float("nan"), 2: float("inf"), 3: -1e300}.get(i % 40, i / 3)),
    ],
)
def test_bounded_batches_of_any_offset_that_sorts(spark, tmp_path, kind, value):
    rows = [(i, value(i)) for i in range(700)] + [(-1, None)]
    source = Source(spark, rows, f"id int, off {kind}")
    batches = drain(source.reader(tmp_path, max_rows_per_batch=40))
    assert sorted(i for b in batches for _, i in b) == list(range(700))
    assert all(n <= 40 or offsets == 1 for n, offsets in sized(batches))
    assert len(batches) < 60


def test_one_offset_that_most_rows_share(spark, tmp_path):
    rows = [(i, "m" if i % 3 else f"{i:04d}") for i in range(600)] + [(9000, "z")]
    batches = drain(Source(spark, rows, "id int, off string").reader(tmp_path, max_rows_per_batch=30))
    assert sum(n for n, _ in sized(batches)) == 601
    assert [n for n, offsets in sized(batches) if n > 30] == [400]


def test_backlog_goes_on_after_a_restart(spark, tmp_path):
    """From what was dealt, whatever the table has by then, and is gone after its last batch."""
    source = Source(spark, [(i, f"{i:03d}") for i in range(100)], "id int, off string")
    options = {"max_rows_per_batch": 10}
    first = source.reader(tmp_path, **options)
    seen = take(first)
    batch = first.next_batch()  # not committed
    kept, source.rows = source.rows, source.rows[:3]
    again = source.reader(tmp_path, **options).next_batch()
    assert ids(again) == ids(batch) and again.range == batch.range
    while (found := take(source.reader(tmp_path, **options))) is not None:
        seen += found
    assert sorted(seen) == list(range(100))
    assert not (tmp_path / "backlog").exists()
    source.rows = kept + [(500, "x")]
    assert take(source.reader(tmp_path, **options)) == [500]


def test_backlog_is_read_once(spark, tmp_path):
    """Batches read their folders, not the table."""
    spark.range(1000).selectExpr("id", "cast(id % 97 as string) off").write.parquet(f"{tmp_path}/t")
    reader = IncrementalReader(
        spark,
        FrameTable(lambda: spark.read.parquet(f"{tmp_path}/t"), "off"),
        f"{tmp_path}/log",
        max_rows_per_batch=200,
    )
    total = 0
    while (batch := reader.next_batch()) is not None:
        assert all("/log/backlog/" in f for f in batch.df.inputFiles())
        assert len(batch.df.inputFiles()) <= 8
        total += batch.df.count()
        reader.commit(batch)
    assert total == 1000


@pytest.mark.parametrize("column", ["t", "name"])
def test_database_pages_through_other_offsets(spark, derby, tmp_path, column):
    """Ties never part, and no query returns more than two offsets."""
    base = datetime(2021, 5, 1)
    rows = [(i, base + timedelta(microseconds=(i // 4) * 10**5), f"o'{i // 6:04d}") for i in range(200)]
    rows += [(1000 + i, base + timedelta(seconds=1), "o'0007") for i in range(60)]
    frame = spark.createDataFrame(rows, "id int, t timestamp, name string")
    writer = frame.write.format("jdbc").options(dbtable="paged", **derby)
    writer.option("createTableColumnTypes", "name VARCHAR(20)").save()
    source = JdbcTable(spark, dbtable="paged", offset_column=column, **derby)
    asked = []
    own = source._offsets
    source._offsets = lambda query: asked.append(own(query)) or asked[-1]
    reader = IncrementalReader(spark, source, str(tmp_path / "log"), max_rows_per_batch=25)
    sizes, seen = [], []
    while (batch := reader.next_batch()) is not None:
        found = [(r["id"], r[column]) for r in batch.df.select("id", source.column).toDF("id", column).collect()]
        sizes.append((len(found), len({v for _, v in found})))
        seen += [i for i, _ in found]
        reader.commit(batch)
    assert sorted(seen) == sorted(r[0] for r in rows)
    assert all(n <= 25 or offsets == 1 for n, offsets in sizes) and max(sizes)[0] > 60
    assert asked and all(len(a) <= 2 for a in asked)


def late_reader(source, log, overlap=10, **options):
    return source.reader(log, overlap=F.lit(overlap), key=["ID"], **options)


def test_rows_behind_the_end_come_once(spark, tmp_path):
    source = Source(spark, [(1, 100), (2, 110), (3, 120)])
    assert take(late_reader(source, tmp_path)) == [1, 2, 3]
    source.rows += [(4, 111), (5, 109), (6, 120), (7, 130)]  # 109 is behind the window
    assert take(late_reader(source, tmp_path)) == [4, 6, 7]
    assert take(late_reader(source, tmp_path)) is None
    source.rows += [(8, 121), (9, 130)]  # nothing above the end
    assert take(late_reader(source, tmp_path)) == [8, 9]
    source.rows += [(10, 119), (11, 126), (None, 125), (8, 122)]  # 8 again with another offset
    reader = late_reader(source, tmp_path)
    batch = reader.next_batch()
    found = sorted(((r["id"], r["off"]) for r in batch.df.collect()), key=repr)
    assert found == [(11, 126), (8, 122), (None, 125)]
    reader.commit(batch)
    assert take(late_reader(source, tmp_path)) is None


def test_a_late_batch_that_was_cut_short_comes_again_as_it_was(spark, tmp_path):
    source = Source(spark, [(1, 100), (2, 110)])
    assert take(late_reader(source, tmp_path)) == [1, 2]
    source.rows += [(3, 105), (4, 115)]
    assert ids(late_reader(source, tmp_path).next_batch()) == [3, 4]
    source.rows += [(5, 106), (6, 116)]  # after the rows were gathered
    reader = late_reader(source, tmp_path)
    batch = reader.next_batch()
    assert ids(batch) == [3, 4]
    reader.commit(batch)
    assert take(late_reader(source, tmp_path)) == [5, 6]


def test_nothing_before_a_given_start_is_late(spark, tmp_path):
    source = Source(spark, [(1, 90), (2, 100), (3, 105)])
    assert take(late_reader(source, tmp_path, starting="100")) == [2, 3]
    source.rows += [(4, 99), (5, 100), (6, 101)]
    assert take(late_reader(source, tmp_path, starting="100")) == [5, 6]


def test_batches_behind_the_window_are_deleted(spark, tmp_path):
    source = Source(spark)
    for n in range(6):
        source.rows.append((n, 100 * n))
        assert take(late_reader(source, tmp_path, overlap=150)) == [n]
    assert sorted(p.name for p in (tmp_path / "gathered").iterdir()) == [f"{n:012d}" for n in (3, 4, 5)]


def test_late_rows_of_a_bounded_backlog(spark, tmp_path):
    source = Source(spark, [(i, i) for i in range(50)])
    options = {"max_rows_per_batch": 20, "overlap": 30}
    seen = take(late_reader(source, tmp_path, **options))
    source.rows += [(100, 5), (101, 45)]
    while (found := take(late_reader(source, tmp_path, **options))) is not None:
        seen += found
    assert sorted(seen) == [*range(50), 100, 101]
    with pytest.raises(ValueError):
        source.reader(tmp_path, key=["id"])


def test_late_times_in_a_database(spark, derby, tmp_path):
    base = datetime(2024, 1, 1)
    fill(spark, derby, [(base, 1), (base + timedelta(hours=2), 2)])
    table = JdbcTable(spark, dbtable="random_stream", offset_column="timestamp", **derby)
    hour = F.expr("INTERVAL 1 HOUR")
    options = {"overlap": hour, "key": ["value"]}

    def values():
        reader = IncrementalReader(spark, table, str(tmp_path / "log"), **options)
        batch = reader.next_batch()
        found = batch and sorted(r["value"] for r in batch.df.collect())
        if batch:
            reader.commit(batch)
        return found

    assert values() == [1, 2]
    fill(spark, derby, [(base + timedelta(minutes=59), 3), (base + timedelta(minutes=61), 4), (base + timedelta(hours=3), 5)])
    assert values() == [4, 5] and values() is None


def test_range_filter_reaches_parquet(spark, tmp_path):
    spark.range(1000).withColumn("x", F.col("id")).write.parquet(f"{tmp_path}/t")
    reader = IncrementalReader(
        spark, FrameTable(lambda: spark.read.parquet(f"{tmp_path}/t"), "id"), f"{tmp_path}/log"
    )
    plan = plan_of(reader.next_batch().df.select("id"))
    assert "GreaterThanOrEqual(id,0)" in plan and "LessThanOrEqual(id,999)" in plan
    assert "ReadSchema: struct<id:bigint>" in plan


def test_old_log_entries_are_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("sluiceworks.sources.incremental._RETAINED", 2)
    source = Source(spark)
    reader = source.reader(tmp_path)
    for i in range(5):
        source.rows.append((i, i))
        assert take(reader) == [i]
    assert len([p for p in (tmp_path / "offsets").iterdir() if p.name[0] != "."]) == 2
    source.rows.append((5, 5))
    assert take(source.reader(tmp_path)) == [5]


def test_polling_as_a_streaming_query(spark, tmp_path):
    source = Source(spark, [(1, 1), (2, 2)])
    write = append_batches(f"{tmp_path}/rows")
    query = source.reader(tmp_path / "log").stream(write, f"{tmp_path}/checkpoint", "1 second")
    try:
        deadline = time.time() + 60
        while time.time() < deadline and not (tmp_path / "log" / "commits" / f"{0:012d}").exists():
            time.sleep(0.2)
        source.rows.append((3, 3))
        while time.time() < deadline and not (tmp_path / "log" / "commits" / f"{1:012d}").exists():
            time.sleep(0.2)
    finally:
        query.stop()
    rows = read_batches(spark, f"{tmp_path}/rows", source.load().schema).collect()
    assert sorted((r["id"], r["batchId"]) for r in rows) == [(1, 0), (2, 0), (3, 1)]


def test_an_incremental_read_feeds_a_stream(spark, tmp_path):
    """Ranges land in an append-only table, which is a stream for joins and watermarks."""
    source = Source(spark, [(i, i) for i in range(5)])
    source.reader(tmp_path / "log").run(append_batches(f"{tmp_path}/rows"))
    stream = append_stream(spark, f"{tmp_path}/rows/batchId=*", source.load().schema)
    assert stream.isStreaming


# ---- databases --------------------------------------------------------------------------


@pytest.fixture
def derby(spark, tmp_path):
    return {"url": f"jdbc:derby:{tmp_path}/db;create=true", "driver": DERBY}


def fill(spark, derby, rows):
    df = spark.createDataFrame(rows, "timestamp timestamp, value bigint")
    df.write.format("jdbc").options(dbtable="random_stream", **derby).mode("append").save()


def at(minute, second=0):
    return datetime(2024, 1, 1, 0, minute, second)


def values(batch):
    return sorted(r["value"] for r in batch.df.collect())


def test_database_rounds(spark, derby, tmp_path):
    fill(spark, derby, [(at(i), i) for i in range(10)] + [(None, 99)])
    options = dict(DBTABLE="random_stream", offsetColumn="TimeStamp", **derby)
    reader = jdbc_stream(spark, f"{tmp_path}/log", **options)
    batch = reader.next_batch()
    assert values(batch) == list(range(10))
    reader.commit(batch)
    assert reader.next_batch() is None
    fill(spark, derby, [(at(9), 100), (at(9, 1), 10)])
    again = jdbc_stream(spark, f"{tmp_path}/log", startingOffset="latest", **options)
    batch = again.next_batch()
    assert values(batch) == [10]


def test_database_options(spark, derby, tmp_path):
    fill(spark, derby, [(at(i), i) for i in range(10)])
    with pytest.raises(ValueError, match="offsetcolumn"):
        jdbc_stream(spark, f"{tmp_path}/a", dbtable="random_stream", **derby)
    with pytest.raises(ValueError, match="no column"):
        jdbc_stream(spark, f"{tmp_path}/b", dbtable="random_stream", offsetcolumn="x", **derby)
    late = jdbc_stream(
        spark,
        f"{tmp_path}/c",
        dbtable="random_stream",
        OFFSETCOLUMN="timestamp",
        STARTINGOFFSET="2024-01-01 00:07:00",
        maxRowsPerBatch="2",
        **derby,
    )
    assert values(late.next_batch()) == [7, 8]


def test_database_filter_and_bounds_run_in_the_database(spark, derby):
    fill(spark, derby, [(at(i), i) for i in range(40)])
    table = JdbcTable(spark, derby["url"], "random_stream", "timestamp", 4, driver=DERBY)
    low, high = table.bounds().first()
    assert (low, high) == (at(0), at(39))
    df = table.scan(OffsetRange("timestamp", str(low), str(high), True))
    assert df.rdd.getNumPartitions() == 4
    assert "GreaterThanOrEqual(timestamp" in plan_of(df).replace("*", "")
    assert df.count() == 40


def test_database_split_by_remainder_is_even_for_a_hot_offset(spark, derby):
    """All rows at one offset: strides of it would put them in one task."""
    fill(spark, derby, [(at(1), i) for i in range(-20, 20)])
    table = JdbcTable(
        spark, derby["url"], "random_stream", "timestamp", 4, split_column="VALUE", driver=DERBY
    )
    df = table.scan(OffsetRange("timestamp", str(at(1)), str(at(1)), True))
    sizes = df.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 4 and sum(r["count"] for r in sizes) == 40
    assert max(r["count"] for r in sizes) <= 12


def test_database_subquery_as_table(spark, derby, tmp_path):
    fill(spark, derby, [(at(i), i) for i in range(10)])
    reader = jdbc_stream(
        spark,
        f"{tmp_path}/log",
        dbtable='(SELECT * FROM random_stream WHERE "value" > 4) t',
        offsetColumn="value",
        **derby,
    )
    assert values(reader.next_batch()) == [5, 6, 7, 8, 9]


def test_offset_with_a_quote_is_a_value(spark, derby, tmp_path):
    rows = spark.createDataFrame([("it's", 1), ("o'clock", 2)], "name string, value bigint")
    typed = {"dbtable": "names", "createTableColumnTypes": "name VARCHAR(100)"}
    rows.write.format("jdbc").options(**typed, **derby).save()
    reader = jdbc_stream(
        spark, f"{tmp_path}/log", dbtable="names", offsetColumn="name", startingOffset="it's", **derby
    )
    assert values(reader.next_batch()) == [1, 2]
