from __future__ import annotations

import sqlite3
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluiceworks.sources import (
    FrameTable,
    IncrementalReader,
    append_stream,
    jdbc_table,
    rate_stream,
)
from sluiceworks.storage import SharedFiles, scratch_dir
from sluiceworks.streaming import (
    InsertWriter,
    UpsertWriter,
    append_batches,
    append_jdbc_batches,
    database_upsert,
    finish,
    start,
    upsert_statement,
)
from sluiceworks.streaming.database import _Sender
from sluiceworks.streaming.sinks import read_batches

DERBY = "org.apache.derby.jdbc.EmbeddedDriver"
COLUMNS = ["md5", "value", "hash", "timestamp"]


@pytest.fixture
def db(tmp_path):
    path = f"{tmp_path}/rows.db"
    connection = sqlite3.connect(path)
    connection.execute(
        "CREATE TABLE random_stream (md5 TEXT, value INTEGER, hash INTEGER UNIQUE, timestamp TEXT)"
    )
    connection.execute("CREATE TABLE plain (value INTEGER UNIQUE)")
    connection.commit()
    connection.close()
    return path


def stored(path, query="SELECT hash, value FROM random_stream ORDER BY hash"):
    connection = sqlite3.connect(path)
    try:
        return connection.execute(query).fetchall()
    finally:
        connection.close()


def connector(path):
    return lambda: sqlite3.connect(path, timeout=60)


def feed(spark, low, high, parts=8):
    return spark.range(low, high, 1, parts).select(
        F.md5(F.col("id").cast("string")).alias("md5"),
        F.col("id").alias("value"),
        (F.col("id") % 100).alias("hash"),
        F.lit("2024-01-01 00:00:00").alias("timestamp"),
    )


# ---- upserts ----------------------------------------------------------------------------


def test_batch_upsert_keeps_the_latest_row(spark, db):
    write = database_upsert(connector(db), "random_stream", ["hash"], ["value"], batch_size=7)
    for n in range(3):
        write(feed(spark, 400 * n, 400 * n + 400), n)
    assert stored(db) == [(h, 1100 + h) for h in range(100)]
    write(feed(spark, 800, 1200), 2)  # replay
    assert stored(db) == [(h, 1100 + h) for h in range(100)]


def test_batch_upsert_binds_by_name(spark, db):
    write = database_upsert(connector(db), "random_stream", ["hash"], ["value"])
    write(feed(spark, 0, 10).select("timestamp", "hash", "md5", "value"), 0)
    assert stored(db) == [(h, h) for h in range(10)]


rows = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 50)), min_size=1, max_size=20)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=rows, cut=st.integers(0, 20))
def test_any_batch_split_gives_the_latest_row(spark, tmp_path_factory, data, cut):
    path = str(tmp_path_factory.mktemp("db") / "rows.db")
    connection = sqlite3.connect(path)
    connection.execute("CREATE TABLE t (k INTEGER UNIQUE, seq INTEGER, x INTEGER)")
    connection.close()
    numbered = [(k, i, x) for i, (k, x) in enumerate(data)]
    write = database_upsert(connector(path), "t", ["k"], ["seq"], batch_size=2, max_connections=2)
    for n, part in enumerate((numbered[:cut], numbered[cut:])):
        write(spark.createDataFrame(part, "k int, seq int, x int"), n)
    expected = sorted({k: (k, i, x) for k, i, x in numbered}.values())
    assert stored(path, "SELECT * FROM t ORDER BY k") == expected


def test_row_upsert_is_independent_of_order(spark, db, tmp_path):
    for n in (2, 0, 1):  # the newest part comes first
        append_batches(f"{tmp_path}/in")(feed(spark, 300 * n, 300 * n + 300, 3), n)
        stream = append_stream(spark, f"{tmp_path}/in/*/batchId=*", feed(spark, 0, 1).schema)
        writer = UpsertWriter(
            connector(db), "random_stream", COLUMNS, ["hash"], "value", batch_size=50
        )
        finish(
            start(stream, f"{tmp_path}/checkpoint", each_row=writer, output_mode="update")
        )
    assert stored(db) == [(h, 800 + h) for h in range(100)]


class Calls:
    """A connection that notes its calls."""

    def __init__(self):
        self.sizes, self.log = [], []

    def cursor(self):
        return self

    def executemany(self, _sql, rows):
        self.sizes.append(len(rows))

    def execute(self, *_):
        self.log.append("execute")

    def fetchall(self):
        return []

    def commit(self):
        self.log.append("commit")

    def close(self):
        self.log.append("close")


def test_rows_go_out_in_batches_of_the_given_size():
    calls = Calls()
    sender = _Sender(lambda: calls, "", ["a"], 100)
    for i in range(250):
        sender.add({"a": i})
    sender.commit()
    sender.close()
    assert calls.sizes == [100, 100, 50] and calls.log == ["commit", "close"]


def test_no_connection_for_an_empty_partition():
    sender = _Sender(pytest.fail, "", ["a"], 1)
    sender.commit()
    sender.close()


@pytest.mark.parametrize("writer_type", ["insert", "upsert"])
def test_nothing_is_committed_after_an_error(writer_type):
    calls = Calls()
    if writer_type == "insert":
        writer = InsertWriter(lambda: calls, "t", ["a"], ["a"], batch_size=1)
    else:
        writer = UpsertWriter(lambda: calls, "t", ["a"], ["a"], "a", batch_size=1)
    assert writer.open(0, 0)
    writer.process({"a": 1})
    writer.close(RuntimeError())
    assert "commit" not in calls.log and calls.log[-1] == "close"


def test_statements():
    args = ("t", ["k", "a", "n"], ["k"])
    assert upsert_statement(*args) == (
        'INSERT INTO "t" ("k", "a", "n") VALUES (?, ?, ?) '
        'ON CONFLICT ("k") DO UPDATE SET "a" = excluded."a", "n" = excluded."n"'
    )
    assert upsert_statement(*args, dialect="on_duplicate_key", mark="%s") == (
        "INSERT INTO `t` (`k`, `a`, `n`) VALUES (%s, %s, %s) "
        "ON DUPLICATE KEY UPDATE `a` = VALUES(`a`), `n` = VALUES(`n`)"
    )
    assert upsert_statement(*args, dialect="on_duplicate_key", newest="a").endswith(
        "UPDATE `n` = IF(VALUES(`a`) >= `a`, VALUES(`n`), `n`), "
        "`a` = IF(VALUES(`a`) >= `a`, VALUES(`a`), `a`)"
    )
    assert upsert_statement(*args, dialect="merge", newest="n") == (
        'MERGE INTO "t" t USING (SELECT ? AS "k", ? AS "a", ? AS "n") s ON t."k" = s."k" '
        'WHEN MATCHED AND s."n" >= t."n" THEN UPDATE SET "a" = s."a", "n" = s."n" '
        'WHEN NOT MATCHED THEN INSERT ("k", "a", "n") VALUES (s."k", s."a", s."n")'
    )
    with pytest.raises(ValueError):
        upsert_statement(*args, dialect="other")


def test_statements_of_rows_that_are_all_key():
    assert upsert_statement("t", ["k"], ["k"]).endswith('ON CONFLICT ("k") DO NOTHING')
    assert upsert_statement("t", ["k"], ["k"], "on_duplicate_key").endswith("UPDATE `k` = `k`")
    assert "WHEN MATCHED" not in upsert_statement("t", ["k"], ["k"], "merge")


def test_odd_names(spark, tmp_path):
    path = f"{tmp_path}/rows.db"
    connection = sqlite3.connect(path)
    connection.execute('CREATE TABLE "Order" ("timestamp" INTEGER UNIQUE, "Mixed Case" TEXT)')
    connection.close()
    rows = spark.range(5).selectExpr("id AS `timestamp`", "'x' AS `Mixed Case`")
    write = database_upsert(connector(path), "Order", ["timestamp"], ["timestamp"])
    write(rows, 0)
    write(rows, 1)
    assert stored(path, 'SELECT count(*), min("Mixed Case") FROM "Order"') == [(5, "x")]


# ---- inserts ----------------------------------------------------------------------------


def test_a_repeated_epoch_in_other_partitions_adds_nothing(spark, db):
    """The first try wrote a part of the rows; the second cuts them differently."""
    for parts, wanted in ((4, "id % 2 = 0"), (7, "true")):
        rows = spark.range(0, 100, 1, parts).where(wanted).withColumnRenamed("id", "value")
        for part in range(parts):
            writer = InsertWriter(connector(db), "plain", ["value"], ["value"], batch_size=10)
            assert writer.open(part, 0)
            for row in rows.where(F.spark_partition_id() == part).collect():
                writer.process(row)
            writer.close(None)
    assert [v for v, in stored(db, "SELECT value FROM plain ORDER BY value")] == list(range(100))


def test_insert_from_a_stream(spark, db, tmp_path):
    spark.range(100).withColumnRenamed("id", "value").repartition(4).write.parquet(f"{tmp_path}/in")
    schema = spark.read.parquet(f"{tmp_path}/in").schema
    for checkpoint in ("checkpoint", "lost"):
        stream = append_stream(spark, f"{tmp_path}/in", schema)
        writer = InsertWriter(connector(db), "plain", ["value"], ["value"], batch_size=10)
        finish(start(stream, f"{tmp_path}/{checkpoint}", each_row=writer))
    assert [v for v, in stored(db, "SELECT value FROM plain ORDER BY value")] == list(range(100))


def test_a_new_checkpoint_appends_to_the_same_table(spark, tmp_path):
    sink = append_batches(f"{tmp_path}/rows")
    for run in range(2):
        rows = rate_stream(spark, rows_per_batch=20)
        finish(start(rows, f"{tmp_path}/checkpoint-{run}", each_batch=sink))
    got = read_batches(spark, f"{tmp_path}/rows", rows.schema)
    assert Counter(r["value"] for r in got.collect()) == dict.fromkeys(range(20), 2)


def test_new_logs_append_to_the_same_database_table(spark, tmp_path):
    database = {"url": f"jdbc:derby:{tmp_path}/db;create=true", "driver": DERBY}
    write = append_jdbc_batches(table="readings", **database)
    for run in range(2):
        rows = spark.range(10 * run, 10 * run + 10)
        source = FrameTable(lambda rows=rows: rows, "id")
        reader = IncrementalReader(spark, source, f"{tmp_path}/log-{run}")
        batch = reader.next_batch()
        reader.write(batch, write)
        reader.write(batch, write)  # a replay
        reader.commit(batch)
    got = jdbc_table(spark, dbtable="readings", **database).collect()
    assert sorted(r["id"] for r in got) == list(range(20))


def test_database_append_replaces_a_replayed_batch(spark, tmp_path):
    database = {"url": f"jdbc:derby:{tmp_path}/db;create=true", "driver": DERBY}
    write = append_jdbc_batches(table="random_stream", **database)
    for n in (0, 1, 1, 0, 2):
        write(spark.range(10 * n, 10 * n + 10).withColumnRenamed("id", "value"), n)
    got = jdbc_table(spark, dbtable="random_stream", **database).collect()
    assert Counter(r["batchId"] for r in got) == {0: 10, 1: 10, 2: 10}
    assert sorted(r["value"] for r in got) == list(range(30))


def test_append_from_a_stream(spark, tmp_path):
    rows = rate_stream(spark, rows_per_batch=20)
    finish(start(rows, f"{tmp_path}/checkpoint", each_batch=append_batches(f"{tmp_path}/rows")))
    got = read_batches(spark, f"{tmp_path}/rows", rows.schema).collect()
    assert sorted((r["value"], r["batchId"]) for r in got) == [(i, 0) for i in range(20)]


def test_append_reads_only_the_wanted_batch(spark, tmp_path):
    for n in range(3):
        append_batches(f"{tmp_path}/rows")(spark.range(5), n)
    one = read_batches(spark, f"{tmp_path}/rows", spark.range(1).schema).where("batchId = 1")
    assert one.count() == 5 and len(one.inputFiles()) >= 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batchId" in plan


def test_console_and_memory_need_no_path(spark, tmp_path):
    rows = rate_stream(spark, rows_per_batch=3)
    finish(start(rows, f"{tmp_path}/a", format="console", options={"truncate": "false"}))
    query = start(rows, f"{tmp_path}/b", format="memory", options={"queryName": "seen"})
    finish(query)
    assert spark.table("seen").count() == 3


# ---- storage and runner -----------------------------------------------------------------


def test_scratch_follows_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x").startswith(shared + "/x-")
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_publish_refuses_to_replace(spark, tmp_path):
    files = SharedFiles(spark)
    files.publish_text(f"{tmp_path}/a/b", "ä\n")
    assert files.read_text(f"{tmp_path}/a/b") == "ä\n"
    with pytest.raises(FileExistsError):
        files.publish_text(f"{tmp_path}/a/b", "other")
    assert [n for n, _ in files.children(f"{tmp_path}/a")] == ["b"]


def test_state_provider_setting_is_left_alone(spark, tmp_path):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    rows = rate_stream(spark, rows_per_batch=3)
    finish(start(rows, f"{tmp_path}/a", f"{tmp_path}/out"))
    assert spark.conf.get(name, None) == before


def test_own_state_provider_is_used(spark, tmp_path):
    name = "spark.sql.streaming.stateStore.providerClass"
    own = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(name, own)
    try:
        finish(start(rate_stream(spark, rows_per_batch=3), f"{tmp_path}/a", f"{tmp_path}/out"))
        assert spark.conf.get(name) == own
        assert spark.conf.get("spark.sql.streaming.join.stateFormatVersion", None) is None
    finally:
        spark.conf.unset(name)
