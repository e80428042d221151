"""Joins of two streams, or of two tables, on keys and a time interval.

The time axis is cut into bins a few intervals wide and the bin joins as one more key.
A key that holds a large share of the rows is thereby spread over as many tasks (or state
partitions) as there are bins, and rows meet only rows of the same bin. The left row has
one bin and the right row that of every possible partner, mostly one and at most two, so
every matching pair meets exactly once and a left outer join stays correct.
"""

from __future__ import annotations

import json
import math
from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceworks.storage import SharedFiles

_BIN = "_bin"
_NULL_PARTS = 64  # tasks for left rows whose key is null
_MICROSECOND = timedelta(microseconds=1)
_MOST_ITEMS, _MOST_TOP = 1_000_000, 100_000  # fixed values: what Spark's sketch takes
_INTERVALS_PER_BIN = 4  # a right row is repeated for one bin edge in this many intervals


def _check_how(how: str) -> None:
    if how not in ("inner", "left_outer"):
        raise ValueError(f"how must be 'inner' or 'left_outer', not {how!r}")


def time_bin(
    column: str, lower: timedelta, upper: timedelta, shift: timedelta = timedelta(0)
) -> Column:
    """The number of the bin that holds the column's time less ``shift``."""
    width = max(upper - lower, _MICROSECOND) // _MICROSECOND * _INTERVALS_PER_BIN
    instant = F.unix_micros(F.col(column).cast("timestamp")) - F.lit(shift // _MICROSECOND)
    return F.call_function("div", instant - F.pmod(instant, F.lit(width)), F.lit(width))


# A key's values, then the tasks for its left rows and for its right rows.
HotKey = tuple[tuple, int, int]


def _counted(df: DataFrame, columns: list[str], rows_per_task: int, within: Column | None):
    """(key, tasks) of the keys with more than ``rows_per_task`` rows.

    A sketch of frequent items, one small state a task and no shuffle, names the keys that may have as
    many; only their rows are counted. A key with so many rows is never missed: what a sketch of n
    rows and m items gets wrong is at most 3.5 n / m, a quarter of ``rows_per_task`` here.
    """
    keys = [F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(columns)]
    names = [f"_k{i}" for i in range(len(columns))]
    whole = df.select(*keys, *([] if within is None else [within.alias("_in")])).dropna(subset=names)
    hashed = F.xxhash64(*[F.col(c) for c in whole.columns])
    total = whole.count()
    at_most = total // rows_per_task  # keys with more rows
    if not at_most:
        return {}
    k, items = 2 * at_most + 10, 14 * at_most + 100
    if items <= _MOST_ITEMS and k <= _MOST_TOP:
        top = F.call_function("approx_top_k", F.col("h"), F.lit(k), F.lit(items))
        found = whole.select(hashed.alias("h")).agg(top.alias("top")).first()["top"]
        likely = [r["item"] for r in found if r["count"] > rows_per_task]
        if not likely:
            return {}
        named = df.sparkSession.createDataFrame([(h,) for h in likely], "_h long")
        whole = whole.withColumn("_h", hashed).join(F.broadcast(named), "_h", "left_semi").drop("_h")
    # partial sums first, so a key costs the shuffle one row for each task that has it
    counts = whole.groupBy(*whole.columns).count().where(F.col("count") > rows_per_task)
    found = counts.groupBy(*names).agg(F.max("count").alias("n")).collect()
    return {tuple(r[n] for n in names): math.ceil(r["n"] / rows_per_task) for r in found}


def hot_keys(
    left: DataFrame,
    right: DataFrame,
    keys: list[tuple[str, str]],
    rows_per_task: int = 1_000_000,
    how: str = "inner",
    left_bin: Column | None = None,
) -> list[HotKey]:
    """The keys with more than ``rows_per_task`` rows on a side, and the tasks they need there.

    The rows of likely keys, found by a sketch, are counted exactly. At most rows / ``rows_per_task`` keys of a side can be in the list.
    With ``left_bin``, such as ``time_bin(...)``, what counts is a key's largest bin; the right
    side of ``interval_join`` is spread over its bins as well. Only the left side of an outer
    join is spread: a left row that were in several tasks would be unmatched in some of them.
    """
    _check_how(how)
    on_left = _counted(left, [a for a, _ in keys], rows_per_task, left_bin)
    on_right = {}
    if how == "inner" and left_bin is None:
        on_right = _counted(right, [b for _, b in keys], rows_per_task, None)
    both = sorted({*on_left, *on_right}, key=repr)
    return [(k, on_left.get(k, 1), on_right.get(k, 1)) for k in both]


def pinned_hot_keys(
    spark: SparkSession, place: str, hot: list[HotKey] | None = None
) -> list[HotKey]:
    """The list that a stream started with, kept in the file ``place`` beside its checkpoint.

    The state of a running join is laid out by its list, so a restart reads it back; a list that
    differs from it is an error. Without a file and a list there are no hot keys.
    """
    files = SharedFiles(spark)
    text = json.dumps([[[_tagged(v) for v in k], a, b] for k, a, b in hot or []])
    if not files.exists(place):
        files.publish_text(place, text)
    stored = files.read_text(place)
    if hot is not None and stored != text:
        raise ValueError(f"the stream of {place} started with other hot keys")
    return [(tuple(_untagged(v) for v in k), a, b) for k, a, b in json.loads(stored)]


def _tagged(value: object) -> object:
    """A key's value for JSON; what JSON has no type for becomes [type, text]."""
    if isinstance(value, datetime):  # a date as well, so it comes first
        return ["datetime", value.isoformat()]
    if isinstance(value, date):
        return ["date", value.isoformat()]
    if isinstance(value, Decimal):
        return ["decimal", str(value)]
    if isinstance(value, (bytes, bytearray)):
        return ["bytes", bytes(value).hex()]
    if isinstance(value, float):
        return ["float", value.hex()]
    return value


def _untagged(value: object) -> object:
    if not isinstance(value, list):
        return value
    kind, text = value
    read = {
        "datetime": datetime.fromisoformat,
        "date": date.fromisoformat,
        "decimal": Decimal,
        "bytes": bytes.fromhex,
        "float": float.fromhex,
    }
    return read[kind](text)


def _spread(
    df: DataFrame,
    columns: list[str],
    side: str,
    hot: list[HotKey],
    scattered: bool,
    totals: dict[str, Column] | None = None,
) -> DataFrame:
    """Add the cell (left part, right part) of each row in its key's grid of tasks.

    A row has one part of its own side, by its hash, and goes to all parts of the other. The list
    is short (see ``hot_keys``) and joins as a broadcast. ``scattered`` rows with a null key,
    which match nothing, are dealt out evenly. With ``totals`` the rows of a key and part become one
    before they go there.
    """
    spark, names = df.sparkSession, [f"_k{i}" for i in range(len(columns))]
    kinds = [T.StructField(n, df.schema[c].dataType) for n, c in zip(names, columns, strict=True)]
    kinds += [T.StructField(n, T.IntegerType()) for n in ("_parts_l", "_parts_r")]
    table = spark.createDataFrame([(*k, a, b) for k, a, b in hot], T.StructType(kinds))
    same = F.lit(True)
    for n, c in zip(names, columns, strict=True):
        same = same & (df[f"`{c}`"] == table[n])
    found = df.join(F.broadcast(table), same, "left")
    own, other = (("_parts_l", "_parts_r") if side == "l" else ("_parts_r", "_parts_l"))
    parts = F.coalesce(F.col(own), F.lit(1))
    if scattered:
        lost = F.lit(False)
        for c in columns:
            lost = lost | df[f"`{c}`"].isNull()
        parts = F.when(lost, F.lit(_NULL_PARTS)).otherwise(parts)
    part = F.pmod(F.xxhash64(*[df[f"`{c}`"] for c in df.columns]), parts).cast("int")
    far = F.coalesce(F.col(other), F.lit(1))
    if totals:
        keyed = found.select(
            *[df[f"`{c}`"] for c in df.columns], part.alias(f"_cell_{side}"), far.alias("_parts")
        )
        found = _totalled(keyed, [*columns, f"_cell_{side}", "_parts"], totals)
        every = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
        return found.withColumn(f"_far_{side}", every).drop("_parts")
    every = F.explode(F.sequence(F.lit(0), far - 1))
    return found.select(
        *[df[f"`{c}`"] for c in df.columns], part.alias(f"_cell_{side}"), every.alias(f"_far_{side}")
    )


def _totalled(df: DataFrame, columns: list[str], totals: dict[str, Column]) -> DataFrame:
    grouped = df.groupBy(*[F.col(f"`{c}`") for c in columns])
    return grouped.agg(*[total.alias(name) for name, total in totals.items()])


def _salted(
    left: DataFrame,
    right: DataFrame,
    keys: list[tuple[str, str]],
    hot: list[HotKey],
    totals: dict[str, Column] | None = None,
) -> tuple[DataFrame, DataFrame, list[tuple[str, str]]]:
    """Both sides with their cells, and the cell columns that must be equal."""
    own = [b for _, b in keys]
    if not hot:
        return left, _totalled(right, own, totals) if totals else right, []
    left = _spread(left, [a for a, _ in keys], "l", hot, True)
    right = _spread(right, own, "r", hot, False, totals)
    return left, right, [("_cell_l", "_far_r"), ("_far_l", "_cell_r")]


def _equalities(pairs: list[tuple[str, str]]) -> Column:
    condition = F.lit(True)
    for a, b in pairs:
        condition = condition & (F.col(a) == F.col(b))
    return condition


def key_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[tuple[str, str]],
    how: str = "inner",
    hot: list[HotKey] = (),
    keep: timedelta | None = None,
    times: tuple[str, str] | None = None,
    delays: tuple[str, str] | None = None,
    totals: dict[str, Column] | None = None,
) -> DataFrame:
    """Equality join; on two streams only ``inner``, and without ``keep`` the state grows without bound.

    ``keys`` pairs a left with a right column name; names must differ between the sides.
    The rows of the ``hot`` keys (see ``hot_keys``) are spread over a grid of tasks. A stream
    must restart with the list it started with, see ``pinned_hot_keys``.

    With ``keep`` a row waits only so long for partners: rows join if their ``times``, a left
    and a right column, are at most that far apart. The ``delays`` of the streams, their watermarks, let
    Spark drop a row from the state once nothing can come any more that is near enough. So the rows
    are the same however they are cut into batches, but for those behind the watermark.

    With ``totals``, aggregates by name, a left row of a table meets totals of its partners instead
    of the partners: one row for each part of the right side (one, if the key isn't hot there), for
    the caller to add up. So a key that is hot on both sides costs its rows, not their pairs.
    """
    _check_how(how)
    if totals and (keep is not None or left.isStreaming or right.isStreaming):
        raise ValueError("totals of partners need tables, joined on keys alone")
    if keep is not None:
        if times is None or (left.isStreaming and delays is None):
            raise ValueError("to keep rows for some time only, a join needs times, on streams with delays")
        return interval_join(left, right, keys, *times, -keep, keep, how, *(delays or (None, None)), hot=hot)
    if how == "left_outer" and (left.isStreaming or right.isStreaming):
        raise ValueError("an outer join of streams needs a time interval: use interval_join")
    wanted = left.columns + ([*[b for _, b in keys], *totals] if totals else right.columns)
    if how == "left_outer" and any(b > 1 for _, _, b in hot):
        raise ValueError("only the left side of an outer join can be spread")
    left, right, cells = _salted(left, right, keys, list(hot), totals)
    return left.join(right, _equalities([*keys, *cells]), how).select(*wanted)


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[tuple[str, str]],
    left_time: str,
    right_time: str,
    lower: timedelta,
    upper: timedelta,
    how: str = "inner",
    left_delay: str | None = None,
    right_delay: str | None = None,
    hot: list[HotKey] = (),
) -> DataFrame:
    """Pairs with equal keys and ``right_time`` in ``[left_time + lower, left_time + upper]``.

    Both ends are included. The delays are the watermarks of streaming sides; on tables
    they are ignored. On streams an unmatched left row of ``left_outer`` appears once the
    watermark has passed the last moment at which a partner could still come. Column
    names must differ between the sides.

    Bins spread a frequent key over time but not within a micro-batch that spans few of
    them; the left rows of the ``hot`` keys (see ``hot_keys``) are also spread over tasks of
    their own. A stream must restart with the list it started with, see ``pinned_hot_keys``.
    """
    _check_how(how)
    if upper < lower:
        raise ValueError("upper must not be below lower")
    if how == "left_outer" and left.isStreaming and not (left_delay and right_delay):
        raise ValueError("an outer join of streams needs a delay on both sides")
    if left.isStreaming and left_delay:
        left = left.withWatermark(left_time, left_delay)
    if right.isStreaming and right_delay:
        right = right.withWatermark(right_time, right_delay)

    wanted = left.columns + right.columns
    left = left.withColumn(f"{_BIN}_l", time_bin(left_time, lower, upper))
    first = time_bin(right_time, lower, upper, shift=upper)
    last = time_bin(right_time, lower, upper, shift=lower)
    right = right.withColumn(f"{_BIN}_r", F.explode(F.sequence(first, last)))
    if how == "left_outer" and any(b > 1 for _, _, b in hot):
        raise ValueError("only the left side of an outer join can be spread")
    left, right, cells = _salted(left, right, keys, list(hot))
    condition = (
        _equalities([*keys, (f"{_BIN}_l", f"{_BIN}_r"), *cells])
        & (F.col(right_time) >= F.col(left_time) + F.lit(lower))
        & (F.col(right_time) <= F.col(left_time) + F.lit(upper))
    )
    return left.join(right, condition, how).select(*wanted)
