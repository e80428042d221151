"""join_clicks.py OUTPUT CHECKPOINT

Clicks carry the ad of the impression 15 seconds earlier.
"""

import sys
from datetime import timedelta

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sluiceworks.operators import interval_join
from sluiceworks.sources import rate_stream
from sluiceworks.streaming import finish, start

output, checkpoint = sys.argv[1:]
spark = SparkSession.builder.appName("join_clicks").getOrCreate()
ticks = rate_stream(spark, rows_per_second=1, partitions=1)
impressions = ticks.select(
    F.col("value").alias("shown_ad"), F.col("timestamp").alias("shown_at")
)
clicks = ticks.select((F.col("value") - 15).alias("clicked_ad"), F.col("timestamp").alias("clicked_at"))
joined = interval_join(
    impressions,
    clicks,
    [("shown_ad", "clicked_ad")],
    "shown_at",
    "clicked_at",
    timedelta(0),
    timedelta(seconds=30),
    "left_outer",
    left_delay="20 seconds",
    right_delay="30 seconds",
)
finish(start(joined, checkpoint, output, every="10 seconds"))
