"""Messages with Kafka's envelope columns, read from given offsets.

The envelope comes from a broker (``kafka_stream``) or from any table or stream that has its
columns; ``from_offsets`` treats both alike.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceworks.storage import SharedFiles

ENVELOPE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# What the message source takes for "from the start" and "from the end".
EARLIEST, LATEST = -2, -1


def pinned_ends(spark: SparkSession, rows: DataFrame, topic: str, place: str) -> dict[int, int]:
    """The first free offset of each partition, as it was when ``place`` was first used.

    ``rows`` is the topic as a table. The answer is written to the file ``place``, which goes
    beside a stream's checkpoint, so that a restart begins where the first start did and not at
    an end that has moved on. It has one number for each partition of the topic.
    """
    files = SharedFiles(spark)
    if not files.exists(place):
        ends = rows.where(F.col("topic") == topic).groupBy("partition")
        found = ends.agg((F.max("offset") + 1).alias("end")).collect()
        files.publish_text(place, json.dumps({str(r["partition"]): r["end"] for r in found}))
    return {int(p): end for p, end in json.loads(files.read_text(place)).items()}


def from_offsets(
    rows: DataFrame,
    topic: str,
    starting: str | dict | None = "earliest",
    ending: str | dict | None = None,
    latest: dict[int, int] | None = None,
) -> DataFrame:
    """Rows of ``topic`` from the starting offset of their partition on (inclusive).

    ``starting`` is ``earliest``, ``latest`` or JSON ``{topic: {partition: offset}}``, where -2
    means the start and -1 the end. Partitions that it does not name are read from the start.
    The end is that of ``latest`` (see ``pinned_ends``), which is needed wherever it is asked
    for. ``ending`` has the same form and is exclusive. The test is a plain comparison per
    partition, so Parquet skips the row groups outside the range.
    """
    condition = F.col("topic") == topic
    if starting == "latest":
        if latest is None:
            raise ValueError("give the ends to start from as latest, see pinned_ends")
        starting = {topic: latest}
    for limits, keep in ((starting, "from"), (ending, "to")):
        if limits in (None, "earliest", "latest"):
            continue
        named = (json.loads(limits) if isinstance(limits, str) else limits).get(topic, {})
        for partition, offset in named.items():
            elsewhere = F.col("partition") != int(partition)
            if keep == "from":
                if offset == LATEST:
                    if latest is None:
                        raise ValueError("give the ends to start from as latest, see pinned_ends")
                    offset = latest.get(int(partition), 0)
                if offset != EARLIEST:
                    condition = condition & (elsewhere | (F.col("offset") >= offset))
            elif offset != LATEST:
                condition = condition & (elsewhere | (F.col("offset") < offset))
    return rows.where(condition)


def kafka_stream(
    spark: SparkSession, servers: str, topic: str, starting: str = "earliest", **options: str
) -> DataFrame:
    """The same envelope from a broker, where the Kafka connector is on the classpath."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**options)
        .load()
        .withColumn("key", F.col("key").cast("string"))
        .withColumn("value", F.col("value").cast("string"))
        .select(*ENVELOPE.names)
    )
