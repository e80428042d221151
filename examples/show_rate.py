"""show_rate.py CHECKPOINT"""

import sys

from pyspark.sql import SparkSession

from sluiceworks.sources import rate_stream
from sluiceworks.streaming import finish, start

spark = SparkSession.builder.appName("show_rate").getOrCreate()
finish(start(rate_stream(spark), sys.argv[1], format="console", every="10 seconds"))
