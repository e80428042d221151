"""feed_to_topic.py CSV_FOLDER CHECKPOINT SERVERS TOPIC

Order lines from a CSV folder to a topic as JSON messages. It needs the Kafka connector.
"""

import sys

from pyspark.sql import SparkSession

from sluiceworks.functions import encode_envelope
from sluiceworks.sources import accepted, csv_feed
from sluiceworks.streaming import finish, start

FIELDS = "order_id bigint, customer string, status string, lines int, ordered_at timestamp"

folder, checkpoint, servers, topic = sys.argv[1:]
spark = SparkSession.builder.appName("feed_to_topic").getOrCreate()
schema = spark.createDataFrame([], FIELDS).schema
rows = accepted(csv_feed(spark, folder, schema), required=("order_id",))
messages = encode_envelope(rows, "order_id")
options = {"kafka.bootstrap.servers": servers, "topic": topic}
finish(start(messages, checkpoint, format="kafka", options=options, every="10 seconds"))
