"""Upserts into a table of a catalog that has row-level operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceworks.operators.latest import latest_per_key


def merge_into(updates: DataFrame, table: str, keys: list[str], order_by: list[str]) -> None:
    """Update the rows whose keys exist, insert the others, add new columns.

    The table's format does the merge, so a Delta or Iceberg catalog must be configured;
    Spark refuses it for plain Parquet tables, which ``KeyedTable`` is for. A batch is
    reduced to one row per key first, since a merge with two matches for a row fails.
    """
    condition = F.lit(True)
    for key in keys:
        condition = condition & (F.col(f"{table}.{key}") == F.col(f"updates.{key}"))
    (
        latest_per_key(updates, keys, order_by)
        .alias("updates")
        .mergeInto(table, condition)
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .withSchemaEvolution()
        .merge()
    )
