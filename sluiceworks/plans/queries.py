"""Acceptance queries: every operator on the whole of a given table.

Each function takes a session and a folder of Parquet tables and returns a DataFrame.
Streams run over all available input into a new scratch path and are read back from it.

The queries marked "embedded database" use Derby or SQLite. Derby belongs to the process
that opened it and SQLite to one file system, so they need a local session, or for SQLite
a mounted shared folder; with a database server the same operators take its address.
"""

from __future__ import annotations

import re
import sqlite3
from collections.abc import Callable
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceworks.functions import (
    decode_envelope,
    digest_projection,
    encode_envelope,
    equals_ignore_case,
    instants,
    matches_ignore_case,
    register_functions,
    wall_clocks,
)
from sluiceworks.operators import (
    KeyedTable,
    hot_keys,
    interval_join,
    key_join,
    pinned_hot_keys,
    time_bin,
)
from sluiceworks.sources import (
    ENVELOPE,
    FrameTable,
    IncrementalReader,
    accepted,
    append_stream,
    csv_feed,
    csv_lines,
    from_offsets,
    jdbc_stream,
    jdbc_table,
    pinned_ends,
    quoted_feed,
    rate_stream,
    register_stream_source,
    rejected,
)
from sluiceworks.sources import offset_bounds as bounds_of
from sluiceworks.storage import SharedFiles, scratch_dir
from sluiceworks.streaming import (
    Database,
    InsertWriter,
    LateSplit,
    StagedUpsert,
    append_batches,
    append_jdbc_batches,
    database_insert,
    finish,
    merge_batches,
    start,
)
from sluiceworks.streaming.sinks import read_batches

DERBY = "org.apache.derby.jdbc.EmbeddedDriver"
ROUNDS = 5


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One test table as a stream, whether it is a file or a folder of files."""
    schema = table(spark, sf, name).schema
    return append_stream(spark, f"{sf}/{name}.parque[t]", schema)


def settle(df: DataFrame, label: str) -> DataFrame:
    """Run a stream to its end into a Parquet table and read that."""
    spark = df.sparkSession
    place = scratch_dir(spark, label)
    finish(start(df, f"{place}/checkpoint", f"{place}/rows"))
    return wall_clocks(spark.read.schema(df.schema).parquet(f"{place}/rows"))


# ---- functions and filters --------------------------------------------------------------


def hash_projection(spark, sf):
    return wall_clocks(digest_projection(table(spark, sf, "events"), "event_id", "ts"))


def filter_ieq(spark, sf):
    events = table(spark, sf, "events")
    return events.where(matches_ignore_case("event_type", "ViEw"))


def flag_ieq(spark, sf):
    events = table(spark, sf, "events")
    return events.select("event_id", equals_ignore_case("event_type", "VIEW").alias("is_view"))


def day_of_week(spark, sf):
    register_functions(spark)
    orders = table(spark, sf, "orders")
    return orders.selectExpr(
        "o_orderkey", "o_orderdate", "day_of_week(cast(o_orderdate as date)) as weekday"
    )


# ---- rate, feed, envelope, topic --------------------------------------------------------


def rate_source(spark, sf):
    """The rate counter replays the events table: value n brings event n."""
    events = table(spark, sf, "events")
    ticks = rate_stream(spark, rows_per_batch=events.count())
    replayed = ticks.join(events, ticks["value"] == events["event_id"])
    return settle(replayed.select("event_id", "event_type", events["value"]), "rate")


def _damaged_feed(spark, sf):
    """The events as CSV lines; every tenth has a letter before its id."""
    events = table(spark, sf, "events")
    line = F.to_csv(F.struct("*"), {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"})
    damaged = F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("x"), line)).otherwise(line)
    place = scratch_dir(spark, "feed")
    events.select(damaged.alias("value")).write.text(place)
    return csv_feed(spark, place, events.schema, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def csv_feed_accepted(spark, sf):
    return settle(accepted(_damaged_feed(spark, sf), required=("event_id",)), "csv")


def csv_feed_rejected(spark, sf):
    lines = rejected(_damaged_feed(spark, sf), required=("event_id",))
    number = F.regexp_extract("line", r"^x(\d+),", 1).cast("bigint")
    return settle(lines.select(number.alias("event_id")), "csv")


def _noted_events(events: DataFrame) -> DataFrame:
    """Events with a note of several lines, commas and quotes."""
    lines = [F.col("props"), F.lit(' says "'), "event_type", F.lit('",\nthen, "\n\n",'), "user_id"]
    return events.withColumn("note", F.concat(*lines))


def _quoted_feed(spark, sf, pick: Callable, label: str) -> DataFrame:
    """The events as CSV files of several chunks each; every tenth record has a letter before its id."""
    events = _noted_events(table(spark, sf, "events"))
    times = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    quoting = {"timestampNTZFormat": times, "escape": '"', "quoteAll": "true"}
    record = F.to_csv(F.struct("*"), quoting)
    damaged = F.when(F.col("event_id") % 10 == 0, F.regexp_replace(record, '^"', '"x')).otherwise(record)
    place = scratch_dir(spark, "quoted")
    # one file for every 40,000 events, so that each has several chunks of the size below
    files = events.count() // 40_000 + 1
    events.repartition(files, "event_id").select(damaged.alias("value")).write.text(f"{place}/feed")
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, str(1 << 17))
    try:
        feed = quoted_feed(csv_lines(spark, f"{place}/feed"), events.schema, times)
        pick(feed).write.parquet(f"{place}/{label}")
    finally:
        spark.conf.set(name, before)
    return spark.read.parquet(f"{place}/{label}")


def csv_quoted(spark, sf):
    rows = _quoted_feed(spark, sf, lambda f: wall_clocks(accepted(f, required=("event_id",))), "accepted")
    return wall_clocks(rows)


def csv_quoted_rejected(spark, sf):
    """The ids of the damaged records, and their line breaks."""

    def pick(feed):
        number = F.regexp_extract("line", '^"x([0-9]+)"', 1).cast("bigint")
        breaks = F.length("line") - F.length(F.replace("line", F.lit("\n")))
        lines = rejected(feed, required=("event_id",))
        return lines.select(number.alias("event_id"), breaks.alias("breaks"))

    return _quoted_feed(spark, sf, pick, "rejected")


def _messages(events: DataFrame, key="event_id", value=None) -> DataFrame:
    """The events as messages of three partitions; event n is the n // 3-th of its own."""
    messages = encode_envelope(events, key, value, keep=("event_id", "ts"))
    return messages.select(
        "key",
        "value",
        F.lit("events").alias("topic"),
        (F.col("event_id") % 3).cast("int").alias("partition"),
        F.expr("event_id div 3").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def envelope_roundtrip(spark, sf):
    schema = table(spark, sf, "events").schema
    return settle(decode_envelope(_messages(stream(spark, sf, "events")), schema), "envelope")


def envelope_value_only(spark, sf):
    messages = _messages(stream(spark, sf, "events"), key=None, value="event_id")
    return settle(messages.select("key", "value"), "envelope")


def envelope_malformed(spark, sf):
    events = table(spark, sf, "events")
    cut = F.when(F.col("key") % 7 == 0, F.substring("value", 1, 10)).otherwise(F.col("value"))
    messages = encode_envelope(events, "event_id").withColumn("value", cut)
    return decode_envelope(messages, events.schema, keep=("key",))


def _positions(messages: DataFrame) -> DataFrame:
    return messages.select("key", "partition", "offset")


def topic_earliest(spark, sf):
    return settle(_positions(from_offsets(_messages(stream(spark, sf, "events")), "events")), "topic")


def topic_from_offsets(spark, sf):
    starting = '{"events": {"0": 1, "1": 100, "2": -2}}'
    messages = from_offsets(_messages(stream(spark, sf, "events")), "events", starting)
    return settle(_positions(messages), "topic")


def topic_offset_range(spark, sf):
    starting = '{"events": {"0": 1, "1": 100, "2": 50}}'
    ending = '{"events": {"0": 200, "1": -1, "2": 51}}'
    messages = _messages(table(spark, sf, "events"))
    return _positions(from_offsets(messages, "events", starting, ending))


def topic_latest_restart(spark, sf):
    """A stream from the end of the first half, stopped, and started again after the second."""
    messages = _messages(table(spark, sf, "events"))
    half = bounds_of(table(spark, sf, "events"), "event_id").first()["hi"] // 2
    place = scratch_dir(spark, "latest")
    number = F.col("offset") * 3 + F.col("partition")
    for part in (number <= half, number > half):
        messages.where(part).write.mode("append").parquet(f"{place}/topic")
        ends = pinned_ends(
            spark, spark.read.parquet(f"{place}/topic"), "events", f"{place}/checkpoint-ends"
        )
        arriving = append_stream(spark, f"{place}/topic", ENVELOPE)
        rows = _positions(from_offsets(arriving, "events", "latest", latest=ends))
        finish(start(rows, f"{place}/checkpoint", f"{place}/rows"))
    return spark.read.schema(rows.schema).parquet(f"{place}/rows")


# ---- tables and databases ---------------------------------------------------------------


def table_stream_copy(spark, sf):
    return settle(stream(spark, sf, "orders"), "copy")


def timed_copy(spark, sf):
    """On a processing-time trigger the query goes on until it is stopped after its timeout."""
    orders = stream(spark, sf, "orders")
    place = scratch_dir(spark, "timed")
    query = start(orders, f"{place}/checkpoint", f"{place}/rows", every="200 milliseconds")
    query.processAllAvailable()
    ended = finish(query, timeout=0.5)
    rows = spark.read.schema(orders.schema).parquet(f"{place}/rows")
    return rows.withColumn("ended", F.lit(ended))


def late_rows(spark, sf):
    """The second half of the events arrives first; of the others those too old are dropped."""
    events = instants(table(spark, sf, "events"))
    low, high = bounds_of(events, "ts").first()
    middle = F.lit(low + (high - low) / 2)
    place = scratch_dir(spark, "late")
    for part in (F.col("ts") > middle, F.col("ts") <= middle):
        events.where(part).write.mode("append").parquet(f"{place}/feed")
        arriving = append_stream(spark, f"{place}/feed", events.schema)
        timely = arriving.withWatermark("ts", "18 days").dropDuplicates(["event_id", "ts"])
        finish(start(timely, f"{place}/checkpoint", f"{place}/rows"))
    return wall_clocks(spark.read.schema(events.schema).parquet(f"{place}/rows"))


def _late_split(spark, sf) -> tuple[DataFrame, str]:
    """The events in three files, the newest first; what is 18 days behind is parted from the rest.

    Returns the events and the folder of both outputs. The last batch comes twice.
    """
    events = instants(table(spark, sf, "events"))
    low, high = bounds_of(events, "ts").first()
    third = (high - low) / 3
    place = scratch_dir(spark, "late")
    outputs = [append_batches(f"{place}/{name}") for name in ("timely", "late")]
    split = LateSplit("ts", F.expr("INTERVAL 18 DAYS"), f"{place}/log", *outputs)
    for n in (2, 0, 1):
        after = F.col("ts") > F.lit(low + third * n) if n else F.lit(True)
        until = F.col("ts") <= F.lit(low + third * (n + 1)) if n < 2 else F.lit(True)
        events.where(after & until).write.mode("append").parquet(f"{place}/feed")

        def write(batch, batch_id, n=n):
            split(batch, batch_id)
            if n == 1:
                split(batch, batch_id)

        arriving = append_stream(spark, f"{place}/feed", events.schema)
        finish(start(arriving, f"{place}/checkpoint", each_batch=write))
    return events, place


def late_kept(spark, sf):
    """Timely and late rows together are the events."""
    events, place = _late_split(spark, sf)
    rows = [
        read_batches(spark, f"{place}/{name}", events.schema).withColumn("late", F.lit(name == "late"))
        for name in ("timely", "late")
    ]
    return wall_clocks(rows[0].unionByName(rows[1]).drop("batchId"))


def late_kept_counts(spark, sf):
    """A stateful query on the timely rows, with the same delay, drops none of them."""
    events, place = _late_split(spark, sf)
    timely = append_stream(spark, f"{place}/timely", events.schema, maxFilesPerTrigger="1")
    marked = timely.withWatermark("ts", "18 days")
    # each batch keeps its files' order, so nothing is behind the watermark of this query
    days = marked.groupBy(F.window("ts", "1 day").start.alias("day")).agg(F.count("*").alias("n"))
    path = f"{place}/counts"
    finish(
        start(
            days,
            f"{place}/checkpoint-counts",
            each_batch=lambda b, _: b.write.mode("overwrite").parquet(path),
            output_mode="complete",
        )
    )
    return wall_clocks(spark.read.parquet(path))


def table_overwrite(spark, sf):
    """A batch write replaces what is there."""
    place = scratch_dir(spark, "overwrite")
    orders = table(spark, sf, "orders")
    for rows in (orders.withColumn("o_totalprice", F.lit(0.0)), orders):
        rows.write.mode("overwrite").parquet(place)
    return spark.read.schema(orders.schema).parquet(place)


def _derby(spark, label) -> dict[str, str]:
    # "//" after "jdbc:derby:" would name a server, so file:/// goes as a whole
    folder = re.sub("^file:/+", "/", scratch_dir(spark, label))
    return {"url": f"jdbc:derby:{folder};create=true", "driver": DERBY}


def jdbc_roundtrip(spark, sf):
    """Embedded database."""
    customer = table(spark, sf, "customer")
    database = _derby(spark, "derby")
    customer.write.format("jdbc").options(dbtable="customer", **database).save()
    low, high = bounds_of(customer, "c_custkey").first()
    return jdbc_table(
        spark,
        dbtable="customer",
        partition_column="c_custkey",
        lower=low,
        upper=high,
        partitions=4,
        **database,
    )


# ---- incremental reads ------------------------------------------------------------------


def offset_bounds(spark, sf):
    return bounds_of(table(spark, sf, "events"), "ts")


def _first_read(spark, sf, starting):
    events = FrameTable(lambda: table(spark, sf, "events"), "TS")
    reader = IncrementalReader(spark, events, scratch_dir(spark, "log"), starting)
    return reader.next_batch().df


def incr_first_earliest(spark, sf):
    return _first_read(spark, sf, "earliest")


def incr_first_latest(spark, sf):
    return _first_read(spark, sf, "latest")


def incr_first_specific(spark, sf):
    return _first_read(spark, sf, "2024-01-15 00:00:00")


class _Growing:
    """A table that shows its rows up to a limit, as if the rest had not come yet."""

    def __init__(self, df: DataFrame, column: str):
        self.df, self.column, self.limit = df, column, None

    def load(self) -> DataFrame:
        shown = self.df if self.limit is None else self.df.where(F.col(self.column) <= self.limit)
        return shown


def _orders_in_rounds(spark, sf, rounds: Callable, **reader_options):
    orders = table(spark, sf, "orders")
    growing = _Growing(orders, "o_orderdate")
    place = scratch_dir(spark, "incremental")

    def reader() -> IncrementalReader:
        source = FrameTable(growing.load, "o_orderdate")
        return IncrementalReader(spark, source, f"{place}/log", **reader_options)

    rounds(growing, reader, append_batches(f"{place}/rows"))
    return read_batches(spark, f"{place}/rows", orders.schema)


def incr_next(spark, sf):
    def rounds(growing, reader, write):
        polling = reader()
        for growing.limit in (F.lit("1998-01-01").cast("timestamp_ntz"), None):
            polling.run(write)

    return _orders_in_rounds(spark, sf, rounds)


def incr_no_change(spark, sf):
    def rounds(growing, reader, write):
        polling = reader()
        for _ in range(3):
            polling.run(write)

    return _orders_in_rounds(spark, sf, rounds)


def incr_restart(spark, sf):
    """The first try ends between write and commit; a new reader repeats its range."""

    def rounds(growing, reader, write):
        growing.limit = F.lit("1998-01-01").cast("timestamp_ntz")
        tried = reader()
        batch = tried.next_batch()
        tried.write(batch, write)
        growing.limit = None
        reader().run(write)

    return _orders_in_rounds(spark, sf, rounds)


def incr_bounded(spark, sf):
    """The backlog in batches of at most a seventh of the table; every row comes once."""
    limit = max(1, table(spark, sf, "orders").count() // 7)

    def rounds(growing, reader, write):
        reader().run(write)

    rows = _orders_in_rounds(spark, sf, rounds, max_rows_per_batch=limit)
    return rows.drop("batchId")


def incr_late(spark, sf):
    """Every fifth order arrives a round late; those within a year of the end then still come, once."""
    orders = table(spark, sf, "orders")
    place = scratch_dir(spark, "incremental")
    early = (F.col("o_orderdate") <= F.lit("1998-01-01").cast("timestamp_ntz")) & (F.col("o_orderkey") % 5 != 0)
    shown = [early, F.col("o_orderdate") <= F.lit("1998-06-01").cast("timestamp_ntz"), F.lit(True), F.lit(True)]
    write = append_batches(f"{place}/rows")
    for arrived in shown:

        def reader(arrived=arrived) -> IncrementalReader:
            source = FrameTable(lambda: orders.where(arrived), "o_orderdate")
            year = F.expr("INTERVAL 365 DAYS")
            return IncrementalReader(spark, source, f"{place}/log", overlap=year, key=["O_OrderKey"])

        cut_short = reader()
        batch = cut_short.next_batch()
        if batch is not None:
            cut_short.write(batch, write)  # and no commit
        reader().run(write)
    return read_batches(spark, f"{place}/rows", orders.schema).drop("batchId")


def incr_bounded_text(spark, sf):
    """The same by a text that many rows share, with null offsets, over a restart."""
    orders = table(spark, sf, "orders")
    day = F.date_format("o_orderdate", "yyyy.MM.dd")
    rows = orders.select("o_orderkey", F.when(F.col("o_orderkey") % 50 != 0, day).alias("day"))
    limit = max(1, rows.count() // 7)
    place = scratch_dir(spark, "incremental")

    def reader() -> IncrementalReader:
        source = FrameTable(lambda: rows, "day")
        return IncrementalReader(spark, source, f"{place}/log", max_rows_per_batch=limit)

    write = append_batches(f"{place}/rows")
    reader().run(write, max_batches=3)
    cut_short = reader()
    cut_short.write(cut_short.next_batch(), write)  # and no commit
    reader().run(write)
    found = read_batches(spark, f"{place}/rows", rows.schema)
    size = F.count("*").over(Window.partitionBy("batchId"))
    days = F.size(F.collect_set("day").over(Window.partitionBy("batchId")))
    bounded = (size <= limit) | (days == 1)
    return found.withColumn("bounded", bounded).drop("batchId")


def incr_bounded_times(spark, sf):
    """Embedded database: the backlog by a time, whose ends the database finds page by page."""
    orders = instants(table(spark, sf, "orders"))
    database = _derby(spark, "derby")
    orders.write.format("jdbc").options(dbtable="orders", **database).save()
    with Database(spark, database["url"], database).transaction() as connection:
        connection.run('CREATE INDEX by_date ON orders ("o_orderdate")')
    place = scratch_dir(spark, "incremental")
    reader = jdbc_stream(
        spark,
        f"{place}/log",
        dbtable="orders",
        offsetColumn="o_orderdate",
        maxRowsPerBatch=str(max(1, orders.count() // 7)),
        **database,
    )
    batches = reader.run(append_batches(f"{place}/rows"))
    rows = wall_clocks(read_batches(spark, f"{place}/rows", orders.schema))
    return rows.drop("batchId").withColumn("several", F.lit(batches >= 7))


def incr_jdbc(spark, sf):
    """Embedded database: the orders arrive in Derby in two parts."""
    orders = instants(table(spark, sf, "orders"))
    database = _derby(spark, "derby")
    place = scratch_dir(spark, "incremental")
    cut = F.lit("1998-01-01").cast("timestamp")
    write, reader = append_batches(f"{place}/rows"), None
    for part in (F.col("o_orderdate") <= cut, F.col("o_orderdate") > cut):
        (
            orders.where(part)
            .write.format("jdbc")
            .options(dbtable="orders", **database)
            .mode("append")
            .save()
        )
        reader = reader or jdbc_stream(
            spark,
            f"{place}/log",
            dbtable="orders",
            offsetColumn="O_OrderDate",
            numPartitions="4",
            splitColumn="o_orderkey",
            **database,
        )
        reader.run(write)
    return wall_clocks(read_batches(spark, f"{place}/rows", orders.schema))


def incr_bounded_jdbc(spark, sf):
    """Embedded database: the backlog in batches of at most a seventh, cut by a histogram there."""
    orders = instants(table(spark, sf, "orders"))
    database = _derby(spark, "derby")
    orders.write.format("jdbc").options(dbtable="orders", **database).save()
    place = scratch_dir(spark, "incremental")
    reader = jdbc_stream(
        spark,
        f"{place}/log",
        dbtable="orders",
        offsetColumn="O_OrderKey",
        numPartitions="4",
        maxRowsPerBatch=str(max(1, orders.count() // 7)),
        **database,
    )
    batches = reader.run(append_batches(f"{place}/rows"))
    rows = wall_clocks(read_batches(spark, f"{place}/rows", orders.schema))
    return rows.drop("batchId").withColumn("several", F.lit(batches >= 7))


def stream_jdbc(spark, sf):
    """Embedded database: the events arrive in SQLite in two parts, a stream reads each.

    Its schema comes from the database, its offset is a time.
    """
    path = _sqlite(spark, "stream", f"CREATE TABLE rows ({_EVENT_DDL})")
    register_stream_source(spark)
    place = scratch_dir(spark, "copy")
    insert = database_insert(lambda: sqlite3.connect(path, timeout=60), "rows", max_connections=2)
    growing = _Growing(table(spark, sf, "events"), "ts")
    low, high = bounds_of(growing.df, "ts").first()
    middle = F.lit(low + (high - low) / 2)
    for part in (F.col("ts") <= middle, F.col("ts") > middle):
        insert(_event_rows(growing.df.where(part)), 0)
        arriving = (
            spark.readStream.format("jdbc-streaming")
            .options(
                connect="sqlite3:connect",
                url=path,
                dbtable="rows",
                offsetColumn="TS",
                numPartitions=4,
                positionPath=f"{place}/position",
            )
            .load()
        )
        finish(start(arriving, f"{place}/checkpoint", f"{place}/rows"))
    return spark.read.schema(arriving.schema).parquet(f"{place}/rows")


# ---- joins ------------------------------------------------------------------------------


def _views(events):
    return instants(events.where(matches_ignore_case("event_type", "view"))).select(
        F.col("event_id").alias("imp_id"),
        F.col("user_id").alias("imp_user"),
        F.col("ts").alias("imp_ts"),
    )


def _clicks(events):
    return instants(events.where(matches_ignore_case("event_type", "click"))).select(
        F.col("event_id").alias("clk_id"),
        F.col("user_id").alias("clk_user"),
        F.col("ts").alias("clk_ts"),
    )


ROWS_PER_TASK = 1_000_000  # of a key, beyond which a join spreads it


def _views_with_clicks(events: DataFrame, how: str, hot: list) -> DataFrame:
    return interval_join(
        _views(events),
        _clicks(events),
        [("imp_user", "clk_user")],
        "imp_ts",
        "clk_ts",
        *_SPAN,
        how=how,
        left_delay="20 minutes",
        right_delay="30 minutes",
        hot=hot,
    )


_SPAN = timedelta(0), timedelta(hours=6)


def _hot_views(events: DataFrame, how: str, rows_per_task: int = ROWS_PER_TASK) -> list:
    return hot_keys(
        _views(events),
        _clicks(events),
        [("imp_user", "clk_user")],
        rows_per_task,
        how,
        time_bin("imp_ts", *_SPAN),
    )


def _view_stream(spark, sf, how):
    place = scratch_dir(spark, "hot")
    hot = pinned_hot_keys(spark, f"{place}/keys", _hot_views(table(spark, sf, "events"), how))
    return settle(_views_with_clicks(stream(spark, sf, "events"), how, hot), "join")


def join_left_outer_interval(spark, sf):
    return _view_stream(spark, sf, "left_outer")


def join_inner_interval(spark, sf):
    return _view_stream(spark, sf, "inner")


def join_batch_interval(spark, sf):
    """The same join on tables, where every unmatched view appears."""
    events = table(spark, sf, "events")
    hot = _hot_views(events, "left_outer")
    return wall_clocks(_views_with_clicks(events, "left_outer", hot))


def _orders_and_customers(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Orders and customers by a key of which 0 is a third of the orders and many customers."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 3 == 0, 0).otherwise(F.col("o_orderkey")).alias("o_key"),
    )
    customers = table(spark, sf, "customer").select(
        "c_custkey",
        F.when(F.col("c_custkey") % 50 == 0, 0).otherwise(F.col("c_custkey")).alias("c_key"),
    )
    return orders, customers


def join_hot_both(spark, sf):
    """A join whose input has a key that is hot on both sides, spread over a grid of tasks."""
    orders, customers = _orders_and_customers(spark, sf)
    keys = [("o_key", "c_key")]
    hot = hot_keys(orders, customers, keys, rows_per_task=max(1, customers.count() // 100))
    if not any(a > 1 and b > 1 for _, a, b in hot):
        raise ValueError("no key is hot on both sides")
    # an order needs the totals of its customers only, not a row for each pair
    totals = {"n": F.count("*"), "sum_custkey": F.sum("c_custkey")}
    joined = key_join(orders, customers, keys, hot=hot, totals=totals)
    return joined.groupBy("o_orderkey", "o_key").agg(
        F.sum("n").alias("n"), F.sum("sum_custkey").alias("sum_custkey")
    )


def join_hot_interval(spark, sf):
    """A stream join with the keys of most views spread, restarted with the list it began with."""
    events = table(spark, sf, "events")
    place = scratch_dir(spark, "hot")
    hot = _hot_views(events, "left_outer", rows_per_task=1)
    for _ in range(2):
        pinned = pinned_hot_keys(spark, f"{place}/keys", hot)
        joined = _views_with_clicks(stream(spark, sf, "events"), "left_outer", pinned)
        finish(start(joined, f"{place}/checkpoint", f"{place}/rows"))
    return wall_clocks(spark.read.schema(joined.schema).parquet(f"{place}/rows"))


def join_inner_key(spark, sf):
    orders = stream(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customers = stream(spark, sf, "customer").select("c_custkey", "c_name")
    keys = [("o_custkey", "c_custkey")]
    hot = hot_keys(table(spark, sf, "orders"), table(spark, sf, "customer"), keys, ROWS_PER_TASK)
    return settle(key_join(orders, customers, keys, hot=hot), "join")


def join_inner_kept(spark, sf):
    """Views and clicks of a user within two days of each other; what is older leaves the state."""
    events = stream(spark, sf, "events")
    two_days = timedelta(days=2)
    joined = key_join(
        _views(events),
        _clicks(events),
        [("imp_user", "clk_user")],
        keep=two_days,
        times=("imp_ts", "clk_ts"),
        delays=("20 minutes", "30 minutes"),
    )
    return settle(joined, "join")


def join_left_outer_table(spark, sf):
    """One table split by type: the right row is at most 90 days older than the left."""

    def newer(orders: DataFrame) -> DataFrame:
        return instants(orders.where(matches_ignore_case("o_orderstatus", "o"))).select(
            F.col("o_orderkey").alias("l_key"),
            F.col("o_custkey").alias("l_cust"),
            F.col("o_orderdate").alias("l_ts"),
        )

    def older(orders: DataFrame) -> DataFrame:
        return instants(orders.where(matches_ignore_case("o_orderstatus", "f"))).select(
            F.col("o_orderkey").alias("r_key"),
            F.col("o_custkey").alias("r_cust"),
            F.col("o_orderdate").alias("r_ts"),
        )

    span = timedelta(days=-90), timedelta(0)
    keys = [("l_cust", "r_cust")]
    whole = table(spark, sf, "orders")
    bins = time_bin("l_ts", *span)
    hot = hot_keys(newer(whole), older(whole), keys, ROWS_PER_TASK, "left_outer", bins)
    orders = stream(spark, sf, "orders")
    joined = interval_join(
        newer(orders),
        older(orders),
        keys,
        "l_ts",
        "r_ts",
        *span,
        how="left_outer",
        left_delay="5 days",
        right_delay="5 days",
        hot=hot,
    )
    return settle(joined, "join")


# ---- sinks ------------------------------------------------------------------------------


def _events_in_rounds(spark, sf, write, rounds: int = ROUNDS) -> None:
    """The events in parts by id, each read as one new range."""
    events = table(spark, sf, "events")
    growing = _Growing(events, "event_id")
    highest = bounds_of(events, "event_id").first()["hi"]
    source = FrameTable(growing.load, "event_id")
    reader = IncrementalReader(spark, source, scratch_dir(spark, "log"))
    for n in range(1, rounds + 1):
        growing.limit = highest * n // rounds
        reader.run(write)


def append_with_batch_id(spark, sf):
    place = scratch_dir(spark, "append")
    _events_in_rounds(spark, sf, append_batches(place))
    return read_batches(spark, place, table(spark, sf, "events").schema)


def append_replay(spark, sf):
    """Every batch is written twice, as after a failure before its commit."""
    place = scratch_dir(spark, "append")
    append = append_batches(place)

    def twice(batch, batch_id):
        append(batch, batch_id)
        append(batch, batch_id)

    _events_in_rounds(spark, sf, twice)
    return read_batches(spark, place, table(spark, sf, "events").schema)


def _two_runs(spark, sf, write) -> None:
    """The events in two halves, each read under an offset log of its own, from batch 0 on."""
    events = table(spark, sf, "events")
    half = bounds_of(events, "event_id").first()["hi"] // 2
    for part in (F.col("event_id") <= half, F.col("event_id") > half):
        source = FrameTable(lambda part=part: events.where(part), "event_id")
        IncrementalReader(spark, source, scratch_dir(spark, "log")).run(write)


def append_two_runs(spark, sf):
    """A second run with a new log appends to what the first one left; each is replayed."""
    place = scratch_dir(spark, "append")
    append = append_batches(place)

    def twice(batch, batch_id):
        append(batch, batch_id)
        append(batch, batch_id)

    _two_runs(spark, sf, twice)
    return read_batches(spark, place, table(spark, sf, "events").schema)


def append_two_checkpoints(spark, sf):
    """The same with two streaming queries, each with a new checkpoint."""
    place = scratch_dir(spark, "append")
    events = table(spark, sf, "events")
    half = bounds_of(events, "event_id").first()["hi"] // 2
    for n, part in enumerate((F.col("event_id") <= half, F.col("event_id") > half)):
        rows = stream(spark, sf, "events").where(part)
        finish(start(rows, f"{place}/checkpoint-{n}", each_batch=append_batches(f"{place}/rows")))
    return read_batches(spark, f"{place}/rows", events.schema)


def append_jdbc(spark, sf):
    """Embedded database; every batch is written twice."""
    database = _derby(spark, "derby")
    append = append_jdbc_batches(table="events", **database)

    def twice(batch, batch_id):
        rows = instants(batch)
        append(rows, batch_id)
        append(rows, batch_id)

    _events_in_rounds(spark, sf, twice)
    highest = bounds_of(table(spark, sf, "events"), "event_id").first()["hi"]
    rows = jdbc_table(
        spark,
        dbtable="events",
        partition_column="event_id",
        lower=0,
        upper=highest,
        partitions=4,
        **database,
    )
    return wall_clocks(rows.drop("batchSource"))


def _sqlite(spark, label, *ddl: str) -> str:
    files = SharedFiles(spark)
    folder = scratch_dir(spark, label)
    files.publish_text(f"{folder}/created", "")
    path = folder.removeprefix("file:") + "/rows.db"
    connection = sqlite3.connect(path)
    for statement in ddl:
        connection.execute(statement)
    connection.commit()
    connection.close()
    return path


def _sqlite_rows(spark, path, name, schema: T.StructType, parts: int = 4) -> DataFrame:
    """A SQLite table, read by several tasks by row number."""

    def read(chunks):
        for chunk in chunks:
            for part in chunk["id"]:
                connection = sqlite3.connect(path, timeout=60)
                try:
                    first, last = connection.execute(
                        f"SELECT min(rowid), max(rowid) FROM {name}"
                    ).fetchone()
                    # a range of row numbers is read from the tree, not picked from a scan
                    step = ((last or 0) - (first or 0)) // parts + 1
                    low = (first or 0) + step * int(part)
                    query = f"SELECT * FROM {name} WHERE rowid >= {low} AND rowid < {low + step}"
                    rows = pd.read_sql_query(query, connection, chunksize=10_000)
                    yield from (r[schema.fieldNames()] for r in rows)
                finally:
                    connection.close()

    return spark.range(0, parts, 1, parts).mapInPandas(read, schema)


_EVENT_ROW = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.StringType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
_EVENT_DDL = (
    "event_id INTEGER UNIQUE, ts TIMESTAMP, user_id BIGINT, event_type TEXT, value DOUBLE, props TEXT"
)
_TEXT_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _event_rows(events: DataFrame) -> DataFrame:
    return events.withColumn("ts", F.date_format("ts", _TEXT_TIME))


def foreach_insert(spark, sf):
    """Embedded database; a second query with a new checkpoint sends every row again."""
    path = _sqlite(spark, "insert", f"CREATE TABLE rows ({_EVENT_DDL})")
    rows = _event_rows(stream(spark, sf, "events"))
    for _ in range(2):
        writer = InsertWriter(
            lambda: sqlite3.connect(path, timeout=60), "rows", rows.columns, ["event_id"]
        )
        finish(start(rows, scratch_dir(spark, "checkpoint"), each_row=writer))
    stored = _sqlite_rows(spark, path, "rows", _EVENT_ROW)
    return stored.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _digests(events: DataFrame) -> DataFrame:
    return instants(digest_projection(events, "event_id", "ts", "hash"))


_DIGEST_DDL = '"md5" VARCHAR(32), "value" BIGINT, "hash" BIGINT UNIQUE, "timestamp" TIMESTAMP'


def _derby_table(spark, label, name, ddl) -> dict[str, str]:
    database = _derby(spark, label)
    with Database(spark, database["url"], database).transaction() as connection:
        connection.run(f"CREATE TABLE {name} ({ddl})")
    return database


def _stored_digests(spark, database):
    keys = {"partition_column": "hash", "lower": 0, "upper": 100, "partitions": 4}
    return wall_clocks(jdbc_table(spark, dbtable="digests", **keys, **database))


def db_upsert_batch(spark, sf):
    """Embedded database: each key many times, batches cut short before the merge and repeated."""
    database = _derby_table(spark, "upsert", "digests", _DIGEST_DDL)
    upsert = StagedUpsert(table="digests", keys=["hash"], order_by=["value"], **database)

    def write(batch, batch_id):
        rows = _digests(batch)
        upsert.load(rows, batch_id)  # and no merge, as after a failure between the two
        upsert(rows, batch_id)
        upsert(rows, batch_id)

    _events_in_rounds(spark, sf, write)
    return _stored_digests(spark, database)


def db_upsert_row(spark, sf):
    """Embedded database: two streams, the newer events first; what is older replaces nothing."""
    database = _derby_table(spark, "upsert", "digests", _DIGEST_DDL)
    upsert = StagedUpsert(table="digests", keys=["hash"], order_by=["value"], newest="value", **database)
    events = stream(spark, sf, "events")
    half = bounds_of(table(spark, sf, "events"), "event_id").first()["hi"] // 2
    for part in (F.col("event_id") > half, F.col("event_id") <= half):
        rows = _digests(events.where(part))
        checkpoint = scratch_dir(spark, "checkpoint")
        finish(start(rows, checkpoint, each_batch=upsert, output_mode="update"))
    return _stored_digests(spark, database)


def db_insert_absent(spark, sf):
    """Embedded database: a second stream brings all events again, altered; the first ones stay."""
    ddl = '"event_id" BIGINT PRIMARY KEY, "ts" TIMESTAMP, "user_id" BIGINT, "value" DOUBLE'
    database = _derby_table(spark, "insert", "events", ddl)
    events = instants(stream(spark, sf, "events").select("event_id", "ts", "user_id", "value"))
    insert = StagedUpsert(table="events", keys=["event_id"], order_by=["ts"], update=False, **database)
    for rows in (events.where("event_id % 3 <> 0"), events.withColumn("value", F.col("value") + 1)):
        finish(start(rows, scratch_dir(spark, "checkpoint"), each_batch=insert))
    highest = bounds_of(table(spark, sf, "events"), "event_id").first()["hi"]
    keys = {"partition_column": "event_id", "lower": 0, "upper": highest, "partitions": 4}
    return wall_clocks(jdbc_table(spark, dbtable="events", **keys, **database))


# ---- keyed tables -----------------------------------------------------------------------


def _merged_events(spark, sf) -> KeyedTable:
    schema = table(spark, sf, "events").schema
    keyed = KeyedTable.create_if_absent(
        spark, scratch_dir(spark, "keyed"), schema, ["user_id"], buckets=8
    )
    _events_in_rounds(spark, sf, merge_batches(keyed, ["event_id"]))
    return keyed


def merge_upsert(spark, sf):
    return _merged_events(spark, sf).read()


def merge_digests(spark, sf):
    """A table that starts with its key alone takes its columns from the first batch."""
    start_schema = T.StructType([T.StructField("id", T.LongType(), False)])
    place = scratch_dir(spark, "keyed")
    keyed = KeyedTable.create_if_absent(spark, place, start_schema, ["id"], buckets=4)
    rows = digest_projection(stream(spark, sf, "events"), "event_id", "ts")
    finish(start(rows, f"{place}-checkpoint", each_batch=merge_batches(keyed, ["value"])))
    return wall_clocks(keyed.read()).select("md5", "value", "id", "timestamp")


def _merge_halves(spark, sf, first: Callable, second: Callable, schema: T.StructType):
    keyed = KeyedTable.create_if_absent(
        spark, scratch_dir(spark, "keyed"), schema, ["user_id"], buckets=8
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        keyed.merge((first if batch_id == 0 else second)(batch), ["event_id"], batch_id)

    _events_in_rounds(spark, sf, write, rounds=2)
    return keyed.read()


def merge_schema_evolution(spark, sf):
    """The second half of the events brings a column that the table does not have."""
    schema = table(spark, sf, "events").schema
    return _merge_halves(
        spark, sf, lambda b: b, lambda b: b.withColumn("doubled", F.col("value") * 2), schema
    )


def merge_nested_evolution(spark, sf):
    """Halves whose structs have other fields and types, within an array too, merged in both orders."""
    events = table(spark, sf, "events")
    half = F.col("event_id") <= bounds_of(events, "event_id").first()["hi"] // 2
    k = F.get_json_object("props", "$.k")
    one = events.where(half).select(
        "event_id",
        F.struct(k.cast("int").alias("k"), "event_type").alias("payload"),
        F.array(F.struct(F.col("user_id").cast("int").alias("user"))).alias("tags"),
    )
    two = events.where(~half).select(
        "event_id",
        F.struct("event_type", k.cast("bigint").alias("K"), "value").alias("payload"),
        F.array(F.struct("ts", F.col("user_id").alias("user"))).alias("tags"),
    )
    found = []
    for n, halves in enumerate(((one, two), (two, one))):
        path = scratch_dir(spark, "keyed")
        keyed = KeyedTable.create_if_absent(spark, path, halves[0].schema, ["event_id"], buckets=4)
        for rows in halves:
            keyed.merge(rows, ["event_id"])
        tag = F.col("tags")[0]
        found.append(
            keyed.read().select(
                F.lit(n).alias("first"),
                "event_id",
                F.col("payload.k").alias("k"),
                F.col("payload.event_type").alias("event_type"),
                F.col("payload.value").alias("value"),
                tag["user"].alias("user_id"),
                tag["ts"].alias("ts"),
            )
        )
    return found[0].unionByName(found[1])


def merge_absent_columns(spark, sf):
    """The second half lacks columns; rows that it updates keep their old values there."""
    schema = table(spark, sf, "events").schema
    return _merge_halves(
        spark, sf, lambda b: b, lambda b: b.select("user_id", "event_id", "value"), schema
    )


def merge_two_runs(spark, sf):
    """A second run with a new log updates what the first one left."""
    keyed = KeyedTable.create_if_absent(
        spark, scratch_dir(spark, "keyed"), table(spark, sf, "events").schema, ["user_id"], buckets=8
    )
    _two_runs(spark, sf, merge_batches(keyed, ["event_id"]))
    return keyed.read()


def merge_orders(spark, sf):
    """Updates of every seventh order by broadcast keys, then of every fifth by one shuffle, of every
    third by a filter of its keys."""
    orders = table(spark, sf, "orders")
    keyed = KeyedTable.create_if_absent(
        spark, scratch_dir(spark, "keyed"), orders.schema, ["o_orderkey"], buckets=8
    )
    price, key = F.col("o_totalprice"), F.col("o_orderkey")
    keyed.merge(orders, ["o_orderdate"])
    keyed.merge(orders.where(key % 7 == 0).withColumn("o_totalprice", price * 2), ["o_orderdate"])
    fifth = orders.where(key % 5 == 0).withColumn("o_totalprice", -price)
    keyed.merge(fifth, ["o_orderdate"], broadcast_bytes=0, most_filter_bytes=0)
    third = orders.where(key % 3 == 0).withColumn("o_orderstatus", F.lit("third"))
    keyed.merge(third.drop("o_totalprice"), ["o_orderdate"], broadcast_bytes=0)
    return keyed.read()


def compact_table(spark, sf):
    """With the rows: whether files were packed, and surplus files left."""
    keyed = _merged_events(spark, sf)
    for rest in (0, 1):  # rows that stay and rows that come make a file each
        keyed.merge(keyed.read().where(F.col("user_id") % 2 == rest), ["event_id"])
    before = keyed.files()
    keyed.compact()
    after = keyed.files()
    rows = keyed.read()
    return rows.withColumn("packed", F.lit(before > after)).withColumn("files", F.lit(after))


def vacuum_table(spark, sf):
    """With the rows: whether folders were deleted, and those left."""
    keyed = _merged_events(spark, sf)
    before = keyed.folders()
    keyed.vacuum(retention_hours=0, force=True)
    after = keyed.folders()
    rows = keyed.read()
    return rows.withColumn("deleted", F.lit(before > after)).withColumn("folders", F.lit(after))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "rate_source": rate_source,
    "csv_feed": csv_feed_accepted,
    "csv_feed_rejected": csv_feed_rejected,
    "csv_quoted": csv_quoted,
    "csv_quoted_rejected": csv_quoted_rejected,
    "table_stream_copy": table_stream_copy,
    "timed_copy": timed_copy,
    "late_rows": late_rows,
    "late_kept": late_kept,
    "late_kept_counts": late_kept_counts,
    "table_overwrite": table_overwrite,
    "hash_projection": hash_projection,
    "filter_ieq": filter_ieq,
    "flag_ieq": flag_ieq,
    "day_of_week": day_of_week,
    "envelope_roundtrip": envelope_roundtrip,
    "envelope_value_only": envelope_value_only,
    "envelope_malformed": envelope_malformed,
    "topic_earliest": topic_earliest,
    "topic_from_offsets": topic_from_offsets,
    "topic_offset_range": topic_offset_range,
    "topic_latest_restart": topic_latest_restart,
    "jdbc_roundtrip": jdbc_roundtrip,
    "offset_bounds": offset_bounds,
    "incr_first_earliest": incr_first_earliest,
    "incr_first_latest": incr_first_latest,
    "incr_first_specific": incr_first_specific,
    "incr_next": incr_next,
    "incr_no_change": incr_no_change,
    "incr_restart": incr_restart,
    "incr_bounded": incr_bounded,
    "incr_jdbc": incr_jdbc,
    "incr_bounded_jdbc": incr_bounded_jdbc,
    "incr_late": incr_late,
    "incr_bounded_text": incr_bounded_text,
    "incr_bounded_times": incr_bounded_times,
    "stream_jdbc": stream_jdbc,
    "join_inner_key": join_inner_key,
    "join_inner_kept": join_inner_kept,
    "join_inner_interval": join_inner_interval,
    "join_left_outer_interval": join_left_outer_interval,
    "join_left_outer_table": join_left_outer_table,
    "join_batch_interval": join_batch_interval,
    "join_hot_both": join_hot_both,
    "join_hot_interval": join_hot_interval,
    "append_with_batch_id": append_with_batch_id,
    "append_replay": append_replay,
    "append_two_runs": append_two_runs,
    "append_two_checkpoints": append_two_checkpoints,
    "append_jdbc": append_jdbc,
    "foreach_insert": foreach_insert,
    "db_upsert_batch": db_upsert_batch,
    "db_upsert_row": db_upsert_row,
    "db_insert_absent": db_insert_absent,
    "merge_upsert": merge_upsert,
    "merge_digests": merge_digests,
    "merge_two_runs": merge_two_runs,
    "merge_orders": merge_orders,
    "merge_schema_evolution": merge_schema_evolution,
    "merge_nested_evolution": merge_nested_evolution,
    "merge_absent_columns": merge_absent_columns,
    "compact_table": compact_table,
    "vacuum_table": vacuum_table,
}
