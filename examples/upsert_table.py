"""upsert_table.py TABLE CHECKPOINT"""

import sys

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from sluiceworks.functions import digest_projection
from sluiceworks.operators import KeyedTable
from sluiceworks.sources import rate_stream
from sluiceworks.streaming import finish, merge_batches, start

path, checkpoint = sys.argv[1:]
spark = SparkSession.builder.appName("upsert_table").getOrCreate()
key_only = T.StructType([T.StructField("id", T.LongType(), False)])
table = KeyedTable.create_if_absent(spark, path, key_only, ["id"], buckets=4)
rows = digest_projection(rate_stream(spark, 1, 10), "value", "timestamp")
sink = merge_batches(table, order_by=["value"])
finish(start(rows, checkpoint, each_batch=sink, every="10 seconds"))
