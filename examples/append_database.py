"""append_database.py JDBC_URL DRIVER TABLE CHECKPOINT [USER PASSWORD]"""

import sys

from pyspark.sql import SparkSession

from sluiceworks.sources import rate_stream
from sluiceworks.streaming import append_jdbc_batches, finish, start

url, driver, table, checkpoint, *login = sys.argv[1:]
spark = SparkSession.builder.appName("append_database").getOrCreate()
options = {"driver": driver, **dict(zip(("user", "password"), login))}
sink = append_jdbc_batches(url, table, **options)
finish(start(rate_stream(spark), checkpoint, each_batch=sink, every="30 seconds"))
