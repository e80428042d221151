"""A long backlog of a table, dealt into ranges of bounded size in one pass.

The cuts are equal-depth quantiles: of a mergeable KLL sketch for numbers and times, of a bounded
sample for text, decimals and whatever else sorts. Then the rows are shuffled by their offset, ties by a hash, so
that a task has rows of few ranges, and each range is written to a folder of its own. A batch reads its
folder only. Sketches and samples are nearly right, so the folders are counted, and one that
has become too large is dealt again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FANOUT = 64  # ranges of one pass
SAMPLE = 20_000  # offsets that the cuts of text are taken from, about
KLL_K = 800  # ranks right to some 0.4 percent
FILL = 0.9  # of the bound, so that few ranges need a second pass


@dataclass(frozen=True)
class Piece:
    """The rows of a range: its last offset as text, and its folder."""

    end: str
    path: str
    rows: int


def as_text(column: Column, kind: T.DataType) -> Column:
    """A typed offset as text that casts back to the same value in any session zone."""
    if isinstance(kind, T.TimestampType):
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSSXXX")
    return column.cast("string")


def _position(column: Column, kind: T.DataType) -> tuple[Column, str] | None:
    """An offset as a number that a sketch takes, and the kind of the sketch."""
    if isinstance(kind, T.IntegralType):
        return column.cast("bigint"), "bigint"
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("bigint"), "bigint"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp")), "bigint"
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return column.cast("double"), "double"
    return None


def _from_position(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(column.cast("int"))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.timestamp_micros(column).cast(kind)
    return column.cast(kind)


@dataclass(frozen=True)
class Survey:
    """What one pass over the offsets tells: their number, both ends as text, and a sketch of numbers."""

    rows: int
    low: str | None
    high: str | None
    sketch: bytes | None


def survey(df: DataFrame, column: str, kind: T.DataType) -> Survey:
    """Null offsets don't count."""
    offset = F.col(f"`{column}`")
    numeric, sketch = _position(offset, kind), F.lit(None).cast("binary")
    if numeric is not None:
        position, name = numeric
        known = F.when(~F.isnan(position), position) if name == "double" else position
        sketch = F.call_function(f"kll_sketch_agg_{name}", known, F.lit(KLL_K))
    ends = [as_text(f(offset), kind) for f in (F.min, F.max)]
    row = df.agg(F.count(offset), *ends, sketch if numeric is not None else F.max(sketch)).first()
    return Survey(row[0], row[1], row[2], None if row[3] is None else bytes(row[3]))


def depth_cuts(df: DataFrame, column: str, kind: T.DataType, rows: int, known: Survey) -> list[str]:
    """Offsets, as text and in order, that cut the table into parts of about ``rows`` rows each.

    At most FANOUT parts, and at least two unless all rows share one offset.
    """
    if known.low == known.high:
        return []
    cuts = _quantiles(df, column, kind, rows, known)
    ends = [F.lit(e).cast(kind) for e in (known.low, known.high)]
    inside = cuts.where((F.col("c") >= ends[0]) & (F.col("c") < ends[1])).distinct().orderBy("c")
    found = [r[0] for r in inside.select(as_text(F.col("c"), kind)).collect()]
    if found:
        return found
    offset = F.col(f"`{column}`")  # nearly all rows share the last offset
    return [df.where(offset < ends[1]).agg(as_text(F.max(offset), kind)).first()[0]]


def _quantiles(df: DataFrame, column: str, kind: T.DataType, rows: int, known: Survey) -> DataFrame:
    """Cuts (c) in no order, perhaps some of them equal."""
    spark = df.sparkSession
    parts = min(FANOUT, max(2, -(-known.rows // rows)))
    ranks = [i / parts for i in range(1, parts)]
    if known.sketch is not None:
        name = _position(F.lit(None), kind)[1]
        wanted = F.array(*[F.lit(r) for r in ranks])
        quantiles = F.call_function(f"kll_sketch_get_quantile_{name}", F.lit(known.sketch), wanted)
        cuts = spark.range(1).select(F.explode(quantiles).alias("x"))
        return cuts.select(_from_position(F.col("x"), kind).alias("c"))
    share = min(1.0, SAMPLE / known.rows)
    sample = df.select(F.col(f"`{column}`").alias("c")).where("c IS NOT NULL").where(F.rand(17) < share)
    found = [r["c"] for r in sample.orderBy("c").collect()]
    picked = [(found[int(r * len(found))],) for r in ranks] if found else []
    return spark.createDataFrame(picked, T.StructType([T.StructField("c", kind)]))


def _range_of(offset: Column, cuts: list[Column], first: int = 0) -> Column:
    """How many of the cuts are below the offset, by halving."""
    if not cuts:
        return F.lit(first)
    m = len(cuts) // 2
    below = _range_of(offset, cuts[:m], first)
    return F.when(offset <= cuts[m], below).otherwise(_range_of(offset, cuts[m + 1 :], first + m + 1))


def _salt(df: DataFrame) -> Column:
    """A hash of the row, of what can be hashed."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    plain = [c for c, k in kinds.items() if "map<" not in k and "variant" not in k]
    return F.xxhash64(*[F.col(f"`{c}`") for c in plain])


def _deal(df: DataFrame, column: str, kind: T.DataType, cuts: list[str], path: str) -> None:
    spark, offset = df.sparkSession, F.col(f"`{column}`")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), len(cuts) + 1)
    number = _range_of(offset, [F.lit(c).cast(kind) for c in cuts])
    (
        df.repartitionByRange(parts, offset, _salt(df))
        .withColumn("_range", number)
        .write.partitionBy("_range")
        .option("compression", "zstd")
        .parquet(path)
    )


def deal(
    df: DataFrame, column: str, kind: T.DataType, max_rows: int, path: str, known: Survey | None = None
) -> list[Piece]:
    """Write ``df`` below ``path`` as ranges of at most ``max_rows`` rows, in order of the offset.

    Only rows that share one offset can make a larger range. Rows with a null offset are left out.
    ``known`` is the survey of ``df``, if it has been made.
    """
    spark: SparkSession = df.sparkSession
    offset = F.col(f"`{column}`")
    if "_range" in df.columns:
        raise ValueError("the column name _range is taken")
    known = known or survey(df, column, kind)
    if known.rows == 0:
        return []
    df = df.where(offset.isNotNull())
    cuts = depth_cuts(df, column, kind, max(1, int(max_rows * FILL)), known)
    _deal(df, column, kind, cuts, path)
    dealt = spark.read.schema(T.StructType(list(df.schema.fields)).add("_range", T.IntegerType())).parquet(path)
    found = dealt.groupBy("_range").agg(
        F.count("*").alias("n"),
        as_text(F.min(offset), kind).alias("lo"),
        as_text(F.max(offset), kind).alias("hi"),
    )
    pieces: list[Piece] = []
    for row in found.orderBy("_range").collect():  # at most FANOUT
        own = f"{path}/_range={row['_range']}"
        if row["n"] > max_rows and row["lo"] != row["hi"]:
            part = spark.read.schema(df.schema).parquet(own)
            pieces += deal(part, column, kind, max_rows, f"{path}-{row['_range']}")
        else:
            pieces.append(Piece(row["hi"], own, row["n"]))
    return pieces
