"""The incremental database source as a streaming format.

``register(spark)`` makes this work::

    spark.readStream.format("jdbc-streaming").options(
        connect="sqlite3:connect", url="/data/rows.db",
        dbtable="readings", offsetColumn="timestamp", positionPath="/shared/readings.json",
    ).load()

The tasks read through a Python database driver, since a Python data source cannot call
Spark's own JDBC reader; ``connect`` (or ``driver``) names the driver's connect function as
``module:function``. ``url`` is its argument; ``user`` and ``password`` go along where given.
``IncrementalReader`` is the way through JDBC.

A Python source is not told where its checkpoint stands, so the highest position handed out is
kept in the file ``positionPath``; without it a restart after the largest rows were deleted can
deliver rows again that come back later.
"""

from __future__ import annotations

import importlib
import json
import os
import re
import uuid
from collections.abc import Iterator
from datetime import date, datetime, timedelta
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from sluiceworks.sources.incremental import resolve_column
from sluiceworks.storage import file_system

FORMAT = "jdbc-streaming"
_FETCH = 10_000

# Declared types of databases, by the start of their upper-case names. The first
# that fits counts.
_DECLARED = (
    ("TIMESTAMP WITH TIME ZONE", T.TimestampType()),
    ("TIMESTAMPTZ", T.TimestampType()),
    ("TIMESTAMP", T.TimestampNTZType()),
    ("DATETIME", T.TimestampNTZType()),
    ("DATE", T.DateType()),
    ("BOOL", T.BooleanType()),
    ("INTERVAL", None),
    ("INT2", T.ShortType()),
    ("SMALLINT", T.ShortType()),
    ("INT", T.LongType()),
    ("BIGINT", T.LongType()),
    ("SERIAL", T.LongType()),
    ("BIGSERIAL", T.LongType()),
    ("REAL", T.DoubleType()),
    ("FLOAT", T.DoubleType()),
    ("DOUBLE", T.DoubleType()),
    ("CHAR", T.StringType()),
    ("VARCHAR", T.StringType()),
    ("NVARCHAR", T.StringType()),
    ("TEXT", T.StringType()),
    ("CLOB", T.StringType()),
    ("UUID", T.StringType()),
    ("JSON", T.StringType()),
    ("BLOB", T.BinaryType()),
    ("BYTEA", T.BinaryType()),
    ("VARBINARY", T.BinaryType()),
)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(IncrementalTableSource)


def spark_type(declared: str, precision: int | None = None, scale: int | None = None) -> T.DataType:
    """The Spark type of a declared column type; an unknown one is an error, not a guess."""
    name = re.sub(r"\s+", " ", declared.strip().upper())
    if name.startswith(("NUMERIC", "DECIMAL")):
        size = re.search(r"\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)", name)
        if size:
            precision, scale = int(size[1]), int(size[2] or 0)
        return T.DecimalType(precision or 38, 18 if scale is None else scale)
    if name.startswith("TIMESTAMP") and "WITH TIME ZONE" in name:
        return T.TimestampType()
    for start, kind in _DECLARED:
        if name.startswith(start) and kind is not None:
            return kind
    raise ValueError(f"no Spark type for column type {declared!r}: give the stream a schema")


class _Database:
    """Connections by the options of the format."""

    def __init__(self, options: dict[str, str]):
        given = {k.lower(): v for k, v in options.items()}
        given["connect"] = given.get("connect") or given.get("driver")
        for required in ("connect", "url", "dbtable", "offsetcolumn"):
            if not given.get(required):
                raise ValueError(f"option {required} is missing")
        self.connect, self.url, self.table = given["connect"], given["url"], given["dbtable"]
        self.login = {k: given[k] for k in ("user", "password") if given.get(k)}
        self.offset_column = given["offsetcolumn"]
        self.starting = given.get("startingoffset", "earliest")
        self.parts = int(given.get("numpartitions", 1))
        self.split_column = given.get("splitcolumn")
        self.mark = given.get("parametermark", "?")
        self.quote = given.get("quote", '"')
        self.cursor_name = given.get("cursorname")
        self.position = given.get("positionpath")

    @property
    def is_sqlite(self) -> bool:
        return self.connect.partition(":")[0] == "sqlite3"

    def quoted(self, name: str) -> str:
        q = self.quote
        return ".".join(f"{q}{part.replace(q, q * 2)}{q}" for part in name.split("."))

    def open(self):
        module, _, function = self.connect.partition(":")
        return getattr(importlib.import_module(module), function or "connect")(self.url, **self.login)

    def chunks(self, sql: str, values: tuple = ()) -> Iterator[list[tuple]]:
        """Rows as they come. Drivers that fetch a whole result at once do so only for plain
        cursors: ``cursorName`` asks them for one that the server keeps."""
        connection = self.open()
        try:
            cursor = connection.cursor(self.cursor_name) if self.cursor_name else connection.cursor()
            cursor.arraysize = _FETCH
            cursor.execute(sql, values)
            while chunk := cursor.fetchmany(_FETCH):
                yield chunk
        finally:
            connection.close()

    def one(self, sql: str, values: tuple = ()):
        return next(self.chunks(sql, values))[0][0]

    def schema(self) -> T.StructType:
        """Names and declared types from the database's catalogue; no row of the table is read."""
        if self.is_sqlite:
            sql, values = f"PRAGMA table_info({self.quoted(self.table)})", ()
            columns = [(r[1], r[2], None, None) for c in self.chunks(sql, values) for r in c]
        else:
            schema, _, name = self.table.rpartition(".")
            sql = (
                "SELECT column_name, data_type, numeric_precision, numeric_scale "
                f"FROM information_schema.columns WHERE table_name = {self.mark}"
            )
            values = (name,)
            if schema:
                sql, values = f"{sql} AND table_schema = {self.mark}", (name, schema)
            columns = [r for c in self.chunks(f"{sql} ORDER BY ordinal_position", values) for r in c]
        if not columns:
            raise ValueError(f"no columns of {self.table!r} in the catalogue: give the stream a schema")
        return T.StructType([T.StructField(n, spark_type(t, p, s)) for n, t, p, s in columns])


class IncrementalTableSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return _Database(self.options).schema()

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return _RangeStream(_Database(self.options), schema)


class _Query(InputPartition):
    def __init__(self, sql: str, values: tuple):
        self.sql, self.values = sql, values


_EPOCH = datetime(1970, 1, 1)


def _number(value):
    """A place on the axis of an offset, for cutting a range; None where there is none."""
    if isinstance(value, bool) or not isinstance(value, (int, float, Decimal, datetime, date)):
        return None
    if isinstance(value, datetime):
        return (value.replace(tzinfo=None) - _EPOCH) // timedelta(microseconds=1)
    return value.toordinal() if isinstance(value, date) else value


def _back(number, like):
    """The offset at a place, of the kind of ``like``."""
    if isinstance(like, datetime):
        return (_EPOCH + timedelta(microseconds=int(number))).replace(tzinfo=like.tzinfo)
    return date.fromordinal(int(number)) if isinstance(like, date) else number


def cuts(low, high, n: int) -> list:
    """``low``, up to n - 1 places between, ``high``, in ascending order without repeats."""
    a, b = _number(low), _number(high)
    if a is None or b is None or n < 2 or a == b:
        return [low, high]
    step = (b - a) / n if isinstance(a, float) or isinstance(b, float) else None
    inner = [a + step * i if step else a + (b - a) * i // n for i in range(1, n)]
    return [low, *[_back(x, low) for x in sorted(set(inner)) if a < x < b], high]


class _RangeStream(DataSourceStreamReader):
    """Ranges ``(previous end, largest offset]``; the first one includes its start."""

    def __init__(self, database: _Database, schema: T.StructType):
        self.database, self.schema = database, schema
        self.field = resolve_column(schema, database.offset_column)
        self._highest = self._remembered()  # never hand out less than this

    def _remembered(self):
        if not self.database.position:
            return None
        fs, name = file_system(self.database.position)
        if not fs.get_file_info(name).is_file:
            return None
        with fs.open_input_stream(name) as f:
            return self._load(json.loads(f.read())["end"])

    def _remember(self) -> None:
        if self.database.position:
            fs, name = file_system(self.database.position)
            fs.create_dir(os.path.dirname(name), recursive=True)
            draft = f"{name}.{uuid.uuid4().hex}"
            with fs.open_output_stream(draft) as f:
                f.write(json.dumps({"end": self._store(self._highest)}).encode())
            fs.move(draft, name)

    def _store(self, value) -> str | int | float:
        if isinstance(value, datetime):
            return value.isoformat(" ")
        return value if isinstance(value, (int, float, str)) else str(value)

    def _load(self, stored):
        """A stored or returned offset as its column's type."""
        kind = self.field.dataType
        if not isinstance(stored, str):
            return stored
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            return datetime.fromisoformat(stored)
        if isinstance(kind, T.DateType):
            return date.fromisoformat(stored)
        if isinstance(kind, T.IntegralType):
            return int(stored)
        if isinstance(kind, (T.FractionalType, T.DecimalType)):
            return Decimal(stored) if isinstance(kind, T.DecimalType) else float(stored)
        return stored

    def _bind(self, value):
        """As the driver compares it: SQLite keeps times as text."""
        if self.database.is_sqlite and isinstance(value, datetime):
            return value.isoformat(" ")
        return value.isoformat() if self.database.is_sqlite and isinstance(value, date) else value

    def _bound(self, function: str):
        db = self.database
        found = db.one(f"SELECT {function}({db.quoted(self.field.name)}) FROM {db.quoted(db.table)}")
        return self._load(found)

    def initialOffset(self) -> dict:
        return {"columnName": self.field.name, "range": {}}

    def latestOffset(self) -> dict:
        highest = self._bound("MAX")
        if highest is not None and (self._highest is None or highest > self._highest):
            self._highest = highest
            self._remember()
        if self._highest is None:
            return self.initialOffset()
        return {"columnName": self.field.name, "range": {"end": self._store(self._highest)}}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if "end" not in end["range"]:
            return []
        high = self._load(end["range"]["end"])
        previous, starting = start["range"].get("end"), self.database.starting
        if previous is not None:
            low, compare = self._load(previous), ">"
        elif starting == "earliest":
            low, compare = self._bound("MIN"), ">="
        else:
            low, compare = high if starting == "latest" else self._load(starting), ">="
        if low is None or low > high or (compare == ">" and low == high):
            return []
        return [_Query(sql, values) for sql, values in self._queries(low, compare, high)]

    def _queries(self, low, compare: str, high) -> Iterator[tuple[str, tuple]]:
        db, column, n = self.database, self.database.quoted(self.field.name), self.database.parts
        names = ", ".join(db.quoted(c) for c in self.schema.fieldNames())
        inside = f"{column} {{}} {db.mark} AND {column} <= {db.mark}"
        base = f"SELECT {names} FROM {db.quoted(db.table)} WHERE {inside}"
        ends = self._bind(low), self._bind(high)
        if db.split_column and n > 1:
            split = db.quoted(resolve_column(self.schema, db.split_column).name)
            for i in range(n):
                part = f"ABS({split}) % {n} = {i}"
                if i == 0:
                    part = f"({part} OR {split} IS NULL)"
                yield f"{base.format(compare)} AND {part}", ends
            return
        places = cuts(low, high, n)
        for i, (a, b) in enumerate(zip(places, places[1:])):
            yield base.format(compare if i == 0 else ">"), (self._bind(a), self._bind(b))

    def read(self, partition: _Query) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(self.schema)
        for chunk in self.database.chunks(partition.sql, partition.values):
            columns = []
            for field, kind, values in zip(target, self.schema, zip(*chunk, strict=True), strict=True):
                if isinstance(kind.dataType, (T.TimestampType, T.TimestampNTZType)):
                    values = [datetime.fromisoformat(v) if isinstance(v, str) else v for v in values]
                elif isinstance(kind.dataType, T.DateType):
                    values = [date.fromisoformat(v) if isinstance(v, str) else v for v in values]
                elif isinstance(kind.dataType, T.BooleanType):
                    values = [None if v is None else bool(v) for v in values]
                elif isinstance(kind.dataType, T.DecimalType):
                    values = [None if v is None else Decimal(str(v)) for v in values]
                columns.append(pa.array(values, field.type))
            yield pa.RecordBatch.from_arrays(columns, schema=target)
