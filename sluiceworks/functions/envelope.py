"""Rows to key/value messages with a JSON value, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Microseconds are kept, where the default format cuts to milliseconds.
JSON_FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def encode_envelope(
    df: DataFrame,
    key: Column | str | None = None,
    value: Column | str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``key, value`` strings, then the columns named in ``keep``.

    Without ``value`` the whole row goes in as JSON; without ``key`` the key is null.
    """
    if value is None:
        payload = F.to_json(F.struct("*"), JSON_FORMATS)
    else:
        payload = (F.col(value) if isinstance(value, str) else value).cast("string")
    label = F.lit(None) if key is None else F.col(key) if isinstance(key, str) else key
    return df.select(label.cast("string").alias("key"), payload.alias("value"), *keep)


def decode_envelope(df: DataFrame, schema: StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """The payload's columns, then the envelope columns named in ``keep``.

    Text that is not JSON gives nulls in every field; one unreadable field is null alone.
    """
    parsed = F.from_json(F.col("value").cast("string"), schema, JSON_FORMATS)
    return df.select(parsed.alias("data"), *keep).select("data.*", *keep)
