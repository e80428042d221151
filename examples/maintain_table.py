"""maintain_table.py TABLE [RETENTION_HOURS]"""

import sys

from pyspark.sql import SparkSession

from sluiceworks.operators import KeyedTable

path, *retention = sys.argv[1:]
spark = SparkSession.builder.appName("maintain_table").getOrCreate()
table = KeyedTable(spark, path)
print("buckets rewritten:", table.compact(target_bytes=50 << 20))
if retention:
    print("folders deleted:", table.vacuum(float(retention[0]), force=True))
else:
    print("folders deleted:", table.vacuum())
