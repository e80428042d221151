"""Micro-batch sinks: functions of ``(batch, batch_id)`` for ``foreachBatch``.

The same functions serve ``IncrementalReader.run``. All of them may see a batch again after
a failure and leave the same result as if they had seen it once. Batch ids start at 0 with
every new checkpoint or offset log, so a batch is known by its id and by where it comes from
(``source_of``): a new run appends to what earlier runs left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceworks.operators.keyed_table import KeyedTable
from sluiceworks.storage import READER_PROPERTY
from sluiceworks.streaming.jdbc import Database

BatchSink = Callable[[DataFrame, int], None]
# Fixed value: where a streaming query names itself, by an id that its checkpoint keeps.
_QUERY_PROPERTY = "sql.streaming.queryId"


def source_of(batch: DataFrame) -> str:
    """The checkpoint or offset log that a batch belongs to; ``direct`` outside of both."""
    context = batch.sparkSession.sparkContext
    found = context.getLocalProperty(READER_PROPERTY) or context.getLocalProperty(_QUERY_PROPERTY)
    return found or "direct"


def append_batches(path: str) -> BatchSink:
    """Append to a Parquet table with a ``batchId`` column.

    Each batch of each source has its own partition folder. A replay replaces the folder.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"{path}/batchSource={source_of(batch)}/batchId={batch_id}"
        batch.write.mode("overwrite").parquet(folder)

    return write


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What ``append_batches`` wrote; a filter on ``batchId`` prunes folders."""
    with_id = T.StructType(list(schema.fields)).add("batchSource", T.StringType())
    rows = spark.read.schema(with_id.add("batchId", T.LongType())).parquet(path)
    return rows.select(*[F.col(f"`{c}`") for c in schema.fieldNames()], "batchId")


def append_jdbc_batches(
    url: str, table: str, max_connections: int = 16, **options: str
) -> BatchSink:
    """Append to a database table, adding ``batchId`` and ``batchSource``.

    Only the first batch after a start, or one that comes again, can have rows of an earlier
    try in the table; these are deleted first. At most ``max_connections`` tasks write.
    """
    done: dict[str, int] = {}

    def write(batch: DataFrame, batch_id: int) -> None:
        source = source_of(batch)
        if done.get(source) != batch_id - 1:
            _delete_batch(batch.sparkSession, url, table, source, batch_id, options)
        done.pop(source, None)
        (
            batch.withColumn("batchId", F.lit(batch_id).cast("bigint"))
            .withColumn("batchSource", F.lit(source))
            .repartition(max_connections)
            .write.format("jdbc")
            .options(url=url, dbtable=table, **options)
            .option("createTableColumnTypes", "batchSource VARCHAR(64)")
            .mode("append")
            .save()
        )
        done[source] = batch_id

    return write


def _delete_batch(
    spark: SparkSession, url: str, table: str, source: str, batch_id: int, options: dict[str, str]
) -> None:
    database = Database(spark, url, options)
    matches = " AND ".join(f"{database.quoted(c)} = ?" for c in ("batchId", "batchSource"))
    with database.transaction() as connection:
        if connection.columns(table) is not None:  # else the write creates it
            connection.run(f"DELETE FROM {table} WHERE {matches}", batch_id, source)


def merge_batches(
    table: KeyedTable, order_by: list[str], source: str | None = None
) -> BatchSink:
    """Upsert into a keyed table; batches that their source has applied are skipped.

    The source is that of the batch unless one is named.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        table.merge(batch, order_by, batch_id, source or source_of(batch))

    return write
