"""CSV directories as streams.

Spark's CSV reader decides which rows are malformed after column pruning, so a query
that selects one column keeps rows that a full read drops. Here every line is parsed in
full by ``from_csv`` and the verdict travels with the row, whatever is selected later.
Fields of ``csv_feed`` must not contain line breaks; ``quoted_feed`` takes them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from sluiceworks.sources.records import QUOTE, whole_records

_CORRUPT = "_corrupt"


def csv_feed(
    spark: SparkSession,
    path: str,
    schema: StructType,
    timestamp_format: str = "yyyy-MM-dd HH:mm:ss",
    streaming: bool = True,
    csv_options: dict[str, str] | None = None,
    **options: str,
) -> DataFrame:
    """``line`` and its parsed ``row``; pass the result to ``accepted`` or ``rejected``.

    ``HH`` in the format is the 24-hour clock. ``hh`` reads 12:10 as 00:10 and rejects
    13:00 and later.
    """
    reader = (spark.readStream if streaming else spark.read).options(**options)
    lines = reader.text(path).where(F.col("value") != "")
    row = _parsed("value", schema, timestamp_format, csv_options)
    return lines.select(F.col("value").alias("line"), row.alias("row"))


def quoted_feed(
    lines: DataFrame,
    schema: StructType,
    timestamp_format: str = "yyyy-MM-dd HH:mm:ss",
    csv_options: dict[str, str] | None = None,
) -> DataFrame:
    """The same from ``csv_lines`` of files whose quoted fields may hold line breaks.

    Quotes are doubled within fields. A record that its file leaves open is rejected. ``line`` is the
    whole record. In a stream, call it on each micro-batch.
    """
    records = whole_records(lines)
    options = {"escape": QUOTE, **(csv_options or {})}
    row = _parsed("record", schema, timestamp_format, options)
    corrupt = F.when(~F.col("closed"), F.col("record")).otherwise(F.col(f"row.{_CORRUPT}"))
    parsed = records.select("record", "closed", row.alias("row"))
    return parsed.select(
        F.col("record").alias("line"), F.col("row").withField(_CORRUPT, corrupt).alias("row")
    )


def _parsed(
    column: str, schema: StructType, timestamp_format: str, csv_options: dict[str, str] | None
) -> Column:
    parsing = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": _CORRUPT,
        "timestampFormat": timestamp_format,
        "timestampNTZFormat": timestamp_format,
        **(csv_options or {}),
    }
    fields = StructType(list(schema.fields)).add(_CORRUPT, StringType())
    return F.from_csv(F.col(column), _ddl(fields), parsing)


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def accepted(feed: DataFrame, required: tuple[str, ...] = ()) -> DataFrame:
    """The columns of well-formed lines that have a value in every ``required`` column."""
    good = F.col(f"row.{_CORRUPT}").isNull()
    for name in required:
        good = good & F.col(f"row.{name}").isNotNull()
    return feed.where(good).select("row.*").drop(_CORRUPT)


def rejected(feed: DataFrame, required: tuple[str, ...] = ()) -> DataFrame:
    """The lines that ``accepted`` leaves out."""
    bad = F.col(f"row.{_CORRUPT}").isNotNull()
    for name in required:
        bad = bad | F.col(f"row.{name}").isNull()
    return feed.where(bad).select("line")
