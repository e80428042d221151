"""follow_database.py JDBC_URL DRIVER TABLE OFFSET_COLUMN OUTPUT STATE [USER PASSWORD]

New rows land in OUTPUT, which ``append_stream(spark, OUTPUT + "/batchId=*", schema)`` turns
into a stream for joins and watermarks.
"""

import sys

from pyspark.sql import SparkSession

from sluiceworks.sources import jdbc_stream
from sluiceworks.streaming import append_batches, finish

url, driver, table, column, output, state, *login = sys.argv[1:]
spark = SparkSession.builder.appName("follow_database").getOrCreate()
options = {"driver": driver, **dict(zip(("user", "password"), login))}
reader = jdbc_stream(
    spark, f"{state}/log", url=url, dbtable=table, offsetColumn=column, numPartitions="8", **options
)
finish(reader.stream(append_batches(output), f"{state}/checkpoint", every="10 seconds"))
