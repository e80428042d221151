"""join_by_type.py INPUT OUTPUT CHECKPOINT

INPUT is an append-only Parquet table with ``id``, ``type`` and ``createDate``. A ``type1``
row meets the ``type2`` row of its id that is at most five minutes older.
"""

import sys
from datetime import timedelta

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sluiceworks.functions import matches_ignore_case
from sluiceworks.operators import interval_join
from sluiceworks.sources import append_stream
from sluiceworks.streaming import finish, start

source, output, checkpoint = sys.argv[1:]
spark = SparkSession.builder.appName("join_by_type").getOrCreate()
schema = spark.read.parquet(source).schema


def rows_of(kind, prefix):
    rows = append_stream(spark, source, schema).where(matches_ignore_case("type", kind))
    return rows.select(*[F.col(c).alias(f"{prefix}_{c}") for c in ("id", "type", "createDate")])


joined = interval_join(
    rows_of("type1", "s1"),
    rows_of("type2", "s2"),
    [("s1_id", "s2_id")],
    "s1_createDate",
    "s2_createDate",
    timedelta(minutes=-5),
    timedelta(0),
    "left_outer",
    left_delay="5 minutes",
    right_delay="5 minutes",
)
finish(start(joined.select("s2_id", "s2_type"), checkpoint, output), timeout=60)
