"""Native column expressions; all of them stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def equals_ignore_case(column: Column | str, text: str) -> Column:
    """True where the strings are equal up to case. A null gives false, not null."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.lower(column) == F.lit(text.lower()), F.lit(False))


def matches_ignore_case(column: Column | str, text: str) -> Column:
    """The same for filters, where a null keeps no row anyway: the scan also skips nulls."""
    column = F.col(column) if isinstance(column, str) else column
    return F.lower(column) == F.lit(text.lower())


def day_of_week(column: Column | str) -> Column:
    """Sunday = 1 ... Saturday = 7."""
    return F.dayofweek(column)


def register_functions(spark: SparkSession) -> None:
    """Make ``day_of_week`` callable from SQL text, as a SQL function rather than Python code."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION day_of_week(d DATE) RETURNS INT RETURN dayofweek(d)"
    )


def digest_projection(
    df: DataFrame, value: str, timestamp: str, bucket_name: str = "id", buckets: int = 100
) -> DataFrame:
    """``md5, value, <bucket_name>, timestamp``: the row shape of the upsert feeds.

    The bucket keeps the sign of the value, as ``%`` does.
    """
    return df.select(
        F.md5(F.col(value).cast("string")).alias("md5"),
        F.col(value).alias("value"),
        (F.col(value) % F.lit(buckets)).alias(bucket_name),
        F.col(timestamp).cast("timestamp").alias("timestamp"),
    )


def _recast(df: DataFrame, source: type, target: T.DataType) -> DataFrame:
    return df.select(
        *[
            F.col(f"`{f.name}`").cast(target).alias(f.name)
            if isinstance(f.dataType, source)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def instants(df: DataFrame) -> DataFrame:
    """Zone-less timestamps become instants, which is what watermarks accept."""
    return _recast(df, T.TimestampNTZType, T.TimestampType())


def wall_clocks(df: DataFrame) -> DataFrame:
    """Instants become zone-less timestamps; the inverse of ``instants``."""
    return _recast(df, T.TimestampType, T.TimestampNTZType())
