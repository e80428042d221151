"""upsert_database.py SQLITE_FILE CHECKPOINT [row]

The table ``readings (md5, value, hash UNIQUE, timestamp)`` must exist. For another
database, connect with its driver and choose the dialect.
"""

import sqlite3
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sluiceworks.functions import digest_projection
from sluiceworks.sources import rate_stream
from sluiceworks.streaming import UpsertWriter, database_upsert, finish, start

path, checkpoint, *by = sys.argv[1:]
spark = SparkSession.builder.appName("upsert_database").getOrCreate()
rows = digest_projection(rate_stream(spark, 10, 10), "value", "timestamp", "hash")
rows = rows.withColumn("timestamp", F.col("timestamp").cast("string"))


def connect():
    return sqlite3.connect(path, timeout=60)


if by == ["row"]:
    writer = UpsertWriter(
        connect, "readings", rows.columns, ["hash"], newest="value", batch_size=100
    )
    query = start(rows, checkpoint, each_row=writer, output_mode="update", every="1 second")
else:
    sink = database_upsert(connect, "readings", ["hash"], ["value"], batch_size=100)
    query = start(rows, checkpoint, each_batch=sink, every="1 second")
finish(query)
