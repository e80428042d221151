"""Synthetic ``(timestamp, value)`` rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def rate_stream(
    spark: SparkSession,
    rows_per_second: int = 1,
    partitions: int | None = None,
    rows_per_batch: int | None = None,
) -> DataFrame:
    """Values count from 0.

    ``rows_per_batch`` makes the run repeatable: every micro-batch has that many rows,
    whatever the clock says.
    """
    if rows_per_batch is None:
        reader = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second)
    else:
        reader = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rows_per_batch)
    if partitions is not None:
        reader = reader.option("numPartitions", partitions)
    return reader.load()
