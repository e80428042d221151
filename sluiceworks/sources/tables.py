"""Append-only tables as streams, and database tables as batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def append_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    format: str = "parquet",
    **options: str,
) -> DataFrame:
    """New files of an append-only table. ``format='delta'`` works where Delta is installed.

    ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` bounds a micro-batch.
    """
    reader = spark.readStream.format(format).options(**options)
    return (reader if schema is None else reader.schema(schema)).load(path)


def jdbc_table(
    spark: SparkSession,
    url: str,
    dbtable: str,
    partition_column: str | None = None,
    lower: object | None = None,
    upper: object | None = None,
    partitions: int = 1,
    **options: str,
) -> DataFrame:
    """A database table with the schema the database reports.

    With a partition column and bounds, ``partitions`` tasks read a stride each; the
    bounds place the strides and drop no rows.
    """
    # without a fetch size some drivers hold a whole result in memory
    options = {"fetchsize": "10000", **{k.lower(): v for k, v in options.items()}}
    reader = spark.read.format("jdbc").options(url=url, dbtable=dbtable, **options)
    if partition_column is not None and partitions > 1:
        reader = reader.options(
            partitionColumn=partition_column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=partitions,
        )
    return reader.load()
