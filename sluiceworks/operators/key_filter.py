"""A filter of the keys of a batch, which says of most other keys that the batch doesn't have them.

Each key sets one bit of BITS_PER_KEY times as many bits as there are keys, by an aggregate that merges
partial bitmaps. The bitmaps, two bytes a key, are broadcast; a row whose bit isn't set surely has
no partner in the batch. Of the others about one in BITS_PER_KEY is there by chance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 16
BITMAP_BITS = 32768  # of one row of the filter, Spark's size of a bitmap
_PART, _BITS = "_part", "_bits"


def filter_bytes(n: int) -> int:
    """Size of the filter of n keys."""
    return _bitmaps(n) * (BITMAP_BITS // 8 + 64)


def _bitmaps(n: int) -> int:
    return -(-max(n, 1) * BITS_PER_KEY // BITMAP_BITS)


def _bit(keys: list[str], bitmaps: int) -> Column:
    # other bits of the hash than a layout by the keys uses
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys], F.lit(2)), F.lit(bitmaps * BITMAP_BITS))


def key_filter(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The filter of the keys of ``rows``, for about ``n`` of them: numbered bitmaps."""
    bit = rows.select(_bit(keys, _bitmaps(n)).alias("bit"))
    if _bitmaps(n) == 1:  # no shuffle by part
        bits = F.bitmap_construct_agg(F.col("bit") % BITMAP_BITS).alias(_BITS)
        return bit.agg(bits).select(F.lit(0).cast("long").alias(_PART), _BITS)
    part = F.call_function("div", F.col("bit"), F.lit(BITMAP_BITS)).alias(_PART)
    return bit.groupBy(part).agg(F.bitmap_construct_agg(F.col("bit") % BITMAP_BITS).alias(_BITS))


def split_by_filter(
    rows: DataFrame, keys: list[str], known: DataFrame, n: int
) -> tuple[DataFrame, DataFrame]:
    """(rows that may have a key of the filter, rows that surely have none), neither shuffled.

    ``known`` is ``key_filter`` for the same ``keys`` and ``n``. Rows with a null key are among either.
    """
    bit = _bit(keys, _bitmaps(n))
    numbered = rows.withColumn("_bit", bit % BITMAP_BITS).withColumn(
        _PART, F.call_function("div", bit, F.lit(BITMAP_BITS))
    )
    found = numbered.join(F.broadcast(known), _PART, "left")
    byte = F.expr(f"cast(conv(hex(substring({_BITS}, cast(_bit div 8 as int) + 1, 1)), 16, 10) as int)")
    isset = F.coalesce(F.expr("_byte >> cast(_bit % 8 as int) & 1") == 1, F.lit(False))
    marked = found.withColumn("_byte", byte).withColumn("_may", isset)
    columns = [F.col(f"`{c}`") for c in rows.columns]
    return marked.where("_may").select(*columns), marked.where("NOT _may").select(*columns)
