"""topic_to_columns.py SERVERS TOPIC CHECKPOINT [STARTING_OFFSETS]

STARTING_OFFSETS is ``earliest``, ``latest`` or ``{"orders": {"0": 1}}``; a checkpoint keeps
where the first start began. It needs the Kafka connector.
"""

import sys

from pyspark.sql import SparkSession

from sluiceworks.functions import decode_envelope
from sluiceworks.sources import kafka_stream
from sluiceworks.streaming import finish, start

FIELDS = "order_id bigint, customer string, status string, lines int, ordered_at timestamp"

servers, topic, checkpoint, *starting = sys.argv[1:]
spark = SparkSession.builder.appName("topic_to_columns").getOrCreate()
schema = spark.createDataFrame([], FIELDS).schema
rows = decode_envelope(kafka_stream(spark, servers, topic, *starting), schema, keep=("timestamp",))
finish(
    start(rows, checkpoint, format="console", options={"truncate": "false"}, every="10 seconds")
)
