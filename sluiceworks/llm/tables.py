"""Results of steps, written to the folder that all executors share."""

from __future__ import annotations

import gc
import time

from pyspark.sql import DataFrame, SparkSession

from sluiceworks.storage import scratch_dir


BATCH_ROWS = 1000


def stored(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` and read it back: later steps start from files, not from its lineage."""
    path = scratch_dir(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now, not at some later collection.

    The first collection frees what still holds the last step's plan, the second its shuffles.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def modest_batches(spark: SparkSession) -> None:
    """Whole texts are large rows: have Spark hand at most BATCH_ROWS of them to Python at once.

    The usual 10,000 would be tens of megabytes, held on both sides of every worker.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def partitions(spark: SparkSession) -> int:
    """Tasks of a shuffle, as the session wants them."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unused(df: DataFrame, name: str) -> str:
    """``name``, or the like of it, that is no column of ``df`` in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
