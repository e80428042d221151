"""Reading a growing table in rounds, by the range of an offset column.

Each round covers ``(end of the round before, largest offset now]``; the first one
includes its start. The range is logged before the rows are read and marked committed
after they are written, so a round that was cut short is repeated with the same bounds.

Rows whose offset is null are never returned. Where rows may arrive behind the last end, ``lag`` holds
the end back, or ``overlap`` reads a window behind it again and hands out what is new there.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sluiceworks.sources.backlog import Piece, as_text, deal, survey
from sluiceworks.storage import READER_PROPERTY, SharedFiles

_RETAINED = 100  # log entries kept


def resolve_column(schema: T.StructType, name: str) -> T.StructField:
    """The field with this name, ignoring case."""
    for field in schema.fields:
        if field.name.lower() == name.lower():
            return field
    raise ValueError(f"no column {name!r} in {schema.fieldNames()}")


def _bounds_of(df: DataFrame, column: Column) -> DataFrame:
    return df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))


def offset_bounds(df: DataFrame, column: str) -> DataFrame:
    """Smallest and largest non-null offset, in one row."""
    return _bounds_of(df, F.col(column))


@dataclass(frozen=True)
class OffsetRange:
    """Offsets from ``start`` to ``end``, as text; ``end`` always belongs to it."""

    column: str
    start: str
    end: str
    start_inclusive: bool = False

    def to_json(self) -> str:
        return json.dumps(
            {"columnName": self.column, "range": {"start": self.start, "end": self.end}}
        )

    @classmethod
    def from_json(cls, text: str, start_inclusive: bool = False) -> OffsetRange:
        entry = json.loads(text)
        if set(entry) != {"columnName", "range"} or not set(entry["range"]) <= {"start", "end"}:
            raise ValueError(f"unknown or missing field in offset {text}")
        start, end = entry["range"].get("start"), entry["range"].get("end")
        if start is None or end is None:
            raise ValueError(f"offset without start or end: {text}")
        return cls(entry["columnName"], start, end, start_inclusive)

    def condition(self, kind: T.DataType) -> Column:
        column = F.col(f"`{self.column}`")
        start, end = F.lit(self.start).cast(kind), F.lit(self.end).cast(kind)
        return ((column >= start) if self.start_inclusive else (column > start)) & (column <= end)


class FrameTable:
    """A table that a function loads: ``load()`` is called anew for every poll and read.

    The offset range is an ordinary filter, so Parquet skips files and row groups
    outside it.
    """

    def __init__(self, load: Callable[[], DataFrame], offset_column: str):
        self._load = load
        field = resolve_column(load().schema, offset_column)
        self.column, self.kind = field.name, field.dataType

    def load_schema(self) -> T.StructType:
        return self._load().schema

    def bounds(self, after: str | None = None) -> DataFrame:
        df, column = self._load(), F.col(f"`{self.column}`")
        if after is not None:
            df = df.where(column > F.lit(after).cast(self.kind))
        return _bounds_of(df, column)

    def scan(self, wanted: OffsetRange) -> DataFrame:
        return self._load().where(wanted.condition(self.kind))


class JdbcTable:
    """A database table, or a query in parentheses with an alias.

    A poll asks the database for the smallest and largest offset, which an index answers.
    A read runs as ``num_partitions`` queries: strides of the offset range, or, where many
    rows share few offsets, remainders of an integer ``split_column`` such as the primary
    key, which are even whatever the offsets look like.
    """

    def __init__(
        self,
        spark: SparkSession,
        url: str,
        dbtable: str,
        offset_column: str,
        num_partitions: int = 1,
        split_column: str | None = None,
        **options: str,
    ):
        # without a fetch size some drivers hold a whole result in memory
        self.options = {"fetchsize": "10000", **{k.lower(): v for k, v in options.items()}}
        self.spark, self.url, self.dbtable = spark, url, dbtable
        self.num_partitions, self.split_column = num_partitions, split_column
        self.schema = self._reader().option("dbtable", dbtable).load().schema
        field = resolve_column(self.schema, offset_column)
        self.column, self.kind = field.name, field.dataType

    def load_schema(self) -> T.StructType:
        return self.schema

    def _reader(self):
        return self.spark.read.format("jdbc").option("url", self.url).options(**self.options)

    def _quoted(self, name: str) -> str:
        dialects = self.spark.sparkContext._jvm.org.apache.spark.sql.jdbc.JdbcDialects
        return dialects.get(self.url).quoteIdentifier(name)

    def bounds(self, after: str | None = None) -> DataFrame:
        c = self._quoted(self.column)
        low = f"MIN({c})" if after is None else f"MAX({c})"
        row = self._reader().option(
            "query", f"SELECT {low} AS lo, MAX({c}) AS hi FROM {self.dbtable}"
        )
        return row.load().toDF("lo", "hi")

    def ends(self, wanted: OffsetRange) -> tuple[int | None, int | None]:
        """Smallest and largest offset of a range of whole numbers, from the database."""
        c = self._quoted(self.column)
        above = ">=" if wanted.start_inclusive else ">"
        where = f"{c} {above} {int(wanted.start)} AND {c} <= {int(wanted.end)}"
        query = f"SELECT MIN({c}) AS lo, MAX({c}) AS hi FROM {self.dbtable} WHERE {where}"
        row = self._reader().option("query", query).load().first()
        return row[0], row[1]

    def bins(self, low: int, high: int, step: int) -> DataFrame:
        """Rows, smallest and largest offset in each ``step`` of whole numbers from ``low`` to
        ``high``, counted by the database."""
        c = self._quoted(self.column)
        start = f"({c} - MOD({c} - {low}, {step}))"
        query = (
            f"SELECT {start} AS bin, COUNT(*) AS n, MIN({c}) AS lo, MAX({c}) AS hi "
            f"FROM {self.dbtable} WHERE {c} >= {low} AND {c} <= {high} GROUP BY {start}"
        )
        found = self._reader().option("query", query).load().toDF("bin", "n", "from", "to")
        return found.withColumn("end", F.col("to").cast("string"))

    def _literal(self, text: str) -> str:
        """An offset as the database's SQL writes it."""
        jvm = self.spark.sparkContext._jvm
        if isinstance(self.kind, T.NumericType):
            return text
        if isinstance(self.kind, T.TimestampType):
            micros = self.spark.range(1).select(F.unix_micros(F.lit(text).cast("timestamp"))).first()[0]
            second, rest = divmod(micros, 1_000_000)
            value = jvm.java.sql.Timestamp(0)
            value.setTime(second * 1000)
            value.setNanos(rest * 1000)
        elif isinstance(self.kind, T.DateType):
            value = jvm.java.sql.Date.valueOf(text)
        else:
            value = text
        return str(jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(self.url).compileValue(value))

    def page_end(self, wanted: OffsetRange, rows: int) -> str:
        """Where a range of at most ``rows`` rows from the start of ``wanted`` ends.

        The database steps over that many rows of its index and returns two offsets. Only rows that
        share one offset make a longer range.
        """
        c, above = self._quoted(self.column), ">=" if wanted.start_inclusive else ">"
        low = f"FROM {self.dbtable} WHERE {c} {above} {self._literal(wanted.start)}"
        limited = self.url.startswith(("jdbc:mysql:", "jdbc:mariadb:", "jdbc:sqlite:"))
        page = (
            f"LIMIT 2 OFFSET {rows - 1}"
            if limited
            else f"OFFSET {rows - 1} ROWS FETCH NEXT 2 ROWS ONLY"
        )
        high = f"AND {c} <= {self._literal(wanted.end)}"
        found = self._offsets(f"SELECT {c} AS hi {low} {high} ORDER BY {c} {page}")
        if len(found) < 2:
            return wanted.end
        last, after = found
        if last != after:
            return last
        before = self._offsets(f"SELECT MAX({c}) AS hi {low} AND {c} < {self._literal(last)}")[0]
        return last if before is None else before

    def _offsets(self, query: str) -> list[str | None]:
        rows = self._reader().option("query", query).load().toDF("hi")
        text = as_text(F.col("hi").cast(self.kind), self.kind)
        return [r[0] for r in rows.orderBy("hi").select(text).collect()]

    def scan(self, wanted: OffsetRange) -> DataFrame:
        reader = self._reader()
        if self.num_partitions > 1 and self.split_column is not None:
            split = self._quoted(resolve_column(self.schema, self.split_column).name)
            n = self.num_partitions
            parts = [f"MOD(ABS({split}), {n}) = {i}" for i in range(n)]
            parts[0] = f"({parts[0]} OR {split} IS NULL)"
            df = self.spark.read.jdbc(
                self.url, self.dbtable, predicates=parts, properties=self.options
            )
        elif self.num_partitions > 1 and isinstance(
            self.kind, (T.NumericType, T.DateType, T.TimestampType)
        ):
            df = reader.options(
                dbtable=self.dbtable,
                partitionColumn=self.column,
                lowerBound=wanted.start,
                upperBound=wanted.end,
                numPartitions=self.num_partitions,
            ).load()
        else:
            df = reader.option("dbtable", self.dbtable).load()
        return df.where(wanted.condition(self.kind))


@dataclass(frozen=True)
class Batch:
    batch_id: int
    range: OffsetRange
    df: DataFrame


class IncrementalReader:
    """Polls a table and hands out each new range once.

    ``starting`` is ``earliest``, ``latest`` (the rows at the largest offset) or an offset
    value as text. ``lag`` is subtracted from the largest offset. ``max_rows_per_batch``
    splits a long backlog, whatever kind of value sorts as its offset; only rows that share one
    offset can exceed it, since a range never ends inside a run of equal offsets. A backlog of a
    ``FrameTable`` is dealt into folders beside the log in one pass, see ``backlog``; a database
    counts whole numbers in bins and pages through other offsets.

    With ``overlap``, a distance on the offset axis as an interval or a number, each round also reads
    the offsets up to so far behind the last end, and returns the rows there that no round has
    returned. A row is known by ``key``, columns that name it, and its offset. For that each
    batch is written beside the log before it is handed out, and kept while the window reaches it. A round
    may have late rows only. Rows before a start other than ``earliest`` are never late.
    """

    def __init__(
        self,
        spark: SparkSession,
        table: FrameTable | JdbcTable,
        log_dir: str,
        starting: str = "earliest",
        lag: Column | None = None,
        max_rows_per_batch: int | None = None,
        overlap: Column | None = None,
        key: list[str] | None = None,
    ):
        if (overlap is None) != (not key):
            raise ValueError("an overlap needs a key, and a key an overlap")
        self.spark, self.table, self.log_dir = spark, table, log_dir.rstrip("/")
        self.starting, self.lag, self.max_rows = starting, lag, max_rows_per_batch
        self.overlap, self.key = overlap, key or []
        self._files = SharedFiles(spark)
        self.id = self._name()
        self._ends: list[str] = []
        self._pieces: dict[int, Piece] = {}  # of a backlog, by the id of the batch
        self._piece_schema: T.StructType | None = None
        self._last: OffsetRange | None = None
        self._last_id, self._committed = -1, True
        logged = [name for name, _ in self._files.children(f"{self.log_dir}/offsets")]
        if logged:
            self._last_id = int(logged[-1])
            self._last = OffsetRange.from_json(
                self._files.read_text(f"{self.log_dir}/offsets/{logged[-1]}"),
                start_inclusive=self._last_id == 0,
            )
            if self._last.column != table.column:
                raise ValueError(f"the log is of column {self._last.column!r}")
            self._committed = self._files.exists(f"{self.log_dir}/commits/{logged[-1]}")
        for name, _ in self._files.children(f"{self.log_dir}/backlog"):
            if name.isdigit():
                self._know(json.loads(self._files.read_text(f"{self.log_dir}/backlog/{name}")))

    def _name(self) -> str:
        """What tells this log's batches from those of another log, written once."""
        place = f"{self.log_dir}/id"
        if not self._files.exists(place):
            self._files.publish_text(place, uuid.uuid4().hex)
        return self._files.read_text(place)

    def next_batch(self) -> Batch | None:
        """The next range and its rows, or None where no offset is above the last end.

        Until ``commit`` is called the same range comes back.
        """
        if self._committed:
            wanted = self._plan()
            if self.overlap is not None:
                wanted = self._gather(wanted)
            if wanted is None:
                return None
            self._last, self._last_id, self._committed = wanted, self._last_id + 1, False
            self._files.publish_text(
                f"{self.log_dir}/offsets/{self._last_id:012d}", wanted.to_json()
            )
        return Batch(self._last_id, self._last, self._rows())

    def _rows(self) -> DataFrame:
        if self.overlap is not None:
            return self._gathered([self._last_id])
        return self._new_rows(self._last, self._last_id)

    def _new_rows(self, wanted: OffsetRange, batch_id: int) -> DataFrame:
        piece = self._pieces.get(batch_id)
        if piece is None:
            return self.table.scan(wanted)
        return self.spark.read.schema(self._piece_schema).parquet(piece.path)

    # ---- rows behind the last end ----

    def _gather(self, wanted: OffsetRange | None) -> OffsetRange | None:
        """Write the next batch, new and late rows, and return its range; None if there are no rows."""
        batch_id, place = self._last_id + 1, f"{self.log_dir}/gathered/{self._last_id + 1:012d}"
        if self._last is None:
            if wanted is None:
                return None
            first = json.dumps(None if self.starting == "earliest" else wanted.start)
            if not self._files.exists(f"{self.log_dir}/first"):
                self._files.publish_text(f"{self.log_dir}/first", first)
            rows = self._new_rows(wanted, batch_id)
        else:
            rows = self._late_rows(self._last.end)
            if wanted is None:
                wanted = OffsetRange(self.table.column, self._last.end, self._last.end)
            else:
                rows = self._new_rows(wanted, batch_id).unionByName(rows)
        rows.write.mode("overwrite").option("compression", "zstd").parquet(place)
        if wanted.start == wanted.end and self._gathered([batch_id]).isEmpty():
            self._files.delete(place)
            return None
        return wanted

    def _gathered(self, batch_ids: list[int]) -> DataFrame:
        paths = [f"{self.log_dir}/gathered/{i:012d}" for i in batch_ids]
        return self.spark.read.schema(self.table.load_schema()).parquet(*paths)

    def _late_rows(self, end: str) -> DataFrame:
        """What the window behind ``end`` has and no batch had."""
        column, kind = self.table.column, self.table.kind
        first = json.loads(self._files.read_text(f"{self.log_dir}/first"))
        at = F.lit(end).cast(kind)
        behind = (at - self.overlap).cast(kind)
        clamped = F.lit(False) if first is None else behind < F.lit(first).cast(kind)
        kept = [int(name) for name, _ in self._files.children(f"{self.log_dir}/gathered")]
        kept = [i for i in kept if i <= self._last_id]
        ends = [
            OffsetRange.from_json(self._files.read_text(f"{self.log_dir}/offsets/{i:012d}")).end for i in kept
        ]
        reached = F.array(*[F.lit(e).cast(kind) > behind for e in ends])
        row = self.spark.range(1).select(as_text(behind, kind), clamped, reached).first()
        for batch_id, reaches in zip(kept, row[2], strict=True):
            if not reaches and batch_id != self._last_id:
                self._files.delete(f"{self.log_dir}/gathered/{batch_id:012d}")
        kept = [i for i, reaches in zip(kept, row[2], strict=True) if reaches or i == self._last_id]
        low, inclusive = (first, True) if row[1] else (row[0], False)
        window = self.table.scan(OffsetRange(column, low, end, inclusive))
        names = [*[resolve_column(window.schema, k).name for k in self.key], column]
        known = self._gathered(kept).select(*[F.col(f"`{c}`").alias(f"_known{i}") for i, c in enumerate(names)])
        same = [F.col(f"`{c}`").eqNullSafe(F.col(f"_known{i}")) for i, c in enumerate(names)]
        return window.join(known, same, "left_anti")

    def commit(self, batch: Batch) -> None:
        if batch.batch_id != self._last_id:
            raise ValueError(f"batch {batch.batch_id} is not the current one")
        if not self._committed:
            self._files.publish_text(f"{self.log_dir}/commits/{batch.batch_id:012d}", "{}")
            self._committed = True
            if batch.batch_id == max(self._pieces, default=None):
                self._files.delete(f"{self.log_dir}/backlog")
                self._pieces = {}
            for old in ("offsets", "commits"):
                expired = f"{batch.batch_id - _RETAINED:012d}"
                if not self._files.exists(f"{self.log_dir}/gathered/{expired}"):
                    self._files.delete(f"{self.log_dir}/{old}/{expired}")

    def run(self, write: Callable[[DataFrame, int], None], max_batches: int | None = None) -> int:
        """Read, write and commit until nothing is new. Returns the number of batches.

        ``write`` gets the same batch id and range again after a failure, so it has to
        replace or skip what it already wrote, as the sinks of this package do.
        """
        done = 0
        while max_batches is None or done < max_batches:
            batch = self.next_batch()
            if batch is None:
                break
            self.write(batch, write)
            self.commit(batch)
            done += 1
        return done

    def write(self, batch: Batch, sink: Callable[[DataFrame, int], None]) -> None:
        """Hand a batch to a sink that tells batches by their source."""
        context = self.spark.sparkContext
        before = context.getLocalProperty(READER_PROPERTY)
        context.setLocalProperty(READER_PROPERTY, self.id)
        try:
            sink(batch.df, batch.batch_id)
        finally:
            context.setLocalProperty(READER_PROPERTY, before)

    def stream(
        self, write: Callable[[DataFrame, int], None], checkpoint: str, every: str = "10 seconds"
    ) -> StreamingQuery:
        """Poll on a processing-time trigger, as a streaming query with its life cycle."""
        ticks = self.spark.readStream.format("rate").option("rowsPerSecond", 1).load()

        def poll(_tick: DataFrame, _tick_id: int) -> None:
            self.run(write)

        return (
            ticks.writeStream.foreachBatch(poll)
            .option("checkpointLocation", checkpoint)
            .trigger(processingTime=every)
            .start()
        )

    def _plan(self) -> OffsetRange | None:
        column, kind = self.table.column, self.table.kind
        after = None if self._last is None else self._last.end
        if self._ends and after is not None:
            return OffsetRange(column, after, self._ends.pop(0))
        if (piece := self._pieces.get(self._last_id + 1)) and after is not None:
            return OffsetRange(column, after, piece.end)
        high = F.col("hi") if self.lag is None else F.col("hi") - self.lag
        if after is not None:
            start, ready = F.lit(after), high > F.lit(after).cast(kind)
        elif self.starting == "earliest":
            start, ready = as_text(F.col("lo"), kind), high >= F.col("lo")
        elif self.starting == "latest":
            start, ready = as_text(high.cast(kind), kind), high.isNotNull()
        else:
            start, ready = F.lit(self.starting), high >= F.lit(self.starting).cast(kind)
        found = (
            self.table.bounds(after)
            .where(ready)
            .select(start.alias("start"), as_text(high.cast(kind), kind).alias("end"))
            .first()
        )
        if found is None:
            return None
        wanted = OffsetRange(column, found["start"], found["end"], after is None)
        if self.max_rows is None:
            return wanted
        end = wanted.end
        if isinstance(self.table, FrameTable):
            self._deal(wanted)
            if self._pieces:
                end = self._pieces[self._last_id + 1].end
        elif isinstance(kind, T.IntegralType):
            self._ends = self._split(wanted)
            end = self._ends.pop(0)
        else:
            end = self.table.page_end(wanted, self.max_rows)
        return OffsetRange(column, wanted.start, end, wanted.start_inclusive)

    def _deal(self, wanted: OffsetRange) -> None:
        """Deal a backlog of more than ``max_rows`` rows into folders, and note them.

        The note is published last: without it the next reader deals anew.
        """
        rows, place = self.table.scan(wanted), f"{self.log_dir}/backlog"
        known = survey(rows, self.table.column, self.table.kind)
        if known.rows <= self.max_rows:
            return
        self._files.delete(place)  # what an earlier try left
        pieces = deal(
            rows, self.table.column, self.table.kind, self.max_rows, f"{place}/{uuid.uuid4().hex}", known
        )
        note = {
            "first": self._last_id + 1,
            "schema": rows.schema.json(),
            "pieces": [[p.end, p.path, p.rows] for p in pieces],
        }
        self._files.publish_text(f"{place}/{self._last_id + 1:012d}", json.dumps(note))
        self._know(note)

    def _know(self, note: dict) -> None:
        self._piece_schema = T.StructType.fromJson(json.loads(note["schema"]))
        self._pieces = {note["first"] + k: Piece(*piece) for k, piece in enumerate(note["pieces"])}

    def _split(self, wanted: OffsetRange, bins: int = 1024) -> list[str]:
        """Ends of consecutive ranges of at most ``max_rows`` whole numbers in a database.

        The database counts the rows in equal bins of the offset axis (at most ``bins`` rows reach the
        driver); neighbouring bins are joined. Where the first bin alone is too large it is cut into
        bins again, down to a single offset.
        """
        low, high = self.table.ends(wanted)
        while True:
            if low == high:
                return [wanted.end]
            step = (high - low) // bins + 1
            counts = self.table.bins(low, high, step).orderBy("bin").collect()
            first = counts[0]
            if first["n"] > self.max_rows and first["from"] < first["to"]:
                low, high = first["from"], first["to"]
                wanted = OffsetRange(
                    wanted.column, wanted.start, first["end"], wanted.start_inclusive
                )
                continue
            ends, size, previous = [], 0, first["end"]
            for row in counts:
                if row["n"] > self.max_rows and row["from"] < row["to"]:
                    break  # cut further when its turn comes
                if size and size + row["n"] > self.max_rows:
                    ends.append(previous)
                    size = 0
                size += row["n"]
                previous = row["end"]
            return ends + [previous]


def jdbc_stream(spark: SparkSession, log_dir: str, **options: str) -> IncrementalReader:
    """An incremental database source from its options, whose names ignore case.

    ``url``, ``dbtable`` and ``offsetColumn`` are required; ``startingOffset``,
    ``numPartitions``, ``splitColumn`` and ``maxRowsPerBatch`` are optional; the others
    (``user``, ``password``, ``driver``, ``fetchsize`` ...) go to the database reader.
    """
    given = {name.lower(): value for name, value in options.items()}
    for required in ("url", "dbtable", "offsetcolumn"):
        if not given.get(required):
            raise ValueError(f"option {required} is missing")
    limit = given.pop("maxrowsperbatch", None)
    starting = given.pop("startingoffset", "earliest")
    table = JdbcTable(
        spark,
        given.pop("url"),
        given.pop("dbtable"),
        given.pop("offsetcolumn"),
        num_partitions=int(given.pop("numpartitions", 1)),
        split_column=given.pop("splitcolumn", None),
        **given,
    )
    return IncrementalReader(
        spark, table, log_dir, starting, max_rows_per_batch=None if limit is None else int(limit)
    )
