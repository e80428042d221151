"""Inserts and upserts into databases through a Python database driver.

``connect`` is a function without arguments that returns a new DB-API connection; it runs
in the tasks. Rows are bound by column name, not by position, and names are quoted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from sluiceworks.operators.latest import latest_per_key


def quoted(name: str, dialect: str = "on_conflict") -> str:
    """An identifier as it is, whatever its letters; a table may have its schema before a dot."""
    sign = "`" if dialect == "on_duplicate_key" else '"'
    return ".".join(f"{sign}{part.replace(sign, sign * 2)}{sign}" for part in name.split("."))


def insert_statement(
    table: str, columns: list[str], mark: str = "?", dialect: str = "on_conflict"
) -> str:
    names = ", ".join(quoted(c, dialect) for c in columns)
    return f"INSERT INTO {quoted(table, dialect)} ({names}) VALUES ({', '.join([mark] * len(columns))})"


def upsert_statement(
    table: str,
    columns: list[str],
    keys: list[str],
    dialect: str = "on_conflict",
    mark: str = "?",
    newest: str | None = None,
) -> str:
    """One row's insert-or-update on the table's unique ``keys``.

    Dialects: ``on_conflict`` (PostgreSQL, SQLite), ``on_duplicate_key`` (MySQL) and
    ``merge`` (standard SQL). ``newest`` names a column: a row replaces the stored one only
    if its value there is not smaller, so rows may arrive in any order. Rows that are all key
    are inserted if absent.
    """

    def q(name: str) -> str:
        return quoted(name, dialect)

    values = [c for c in columns if c not in keys]
    insert = insert_statement(table, columns, mark, dialect)
    if dialect == "on_conflict":
        conflict = f"{insert} ON CONFLICT ({', '.join(map(q, keys))})"
        if not values:
            return f"{conflict} DO NOTHING"
        sets = ", ".join(f"{q(c)} = excluded.{q(c)}" for c in values)
        guard = f" WHERE excluded.{q(newest)} >= {q(table)}.{q(newest)}" if newest else ""
        return f"{conflict} DO UPDATE SET {sets}{guard}"
    if dialect == "on_duplicate_key":
        if not values:
            return f"{insert} ON DUPLICATE KEY UPDATE {q(keys[0])} = {q(keys[0])}"
        # assignments run left to right, so the column that decides is assigned last
        ordered = [c for c in values if c != newest] + [c for c in values if c == newest]
        sets = ", ".join(
            f"{q(c)} = IF(VALUES({q(newest)}) >= {q(newest)}, VALUES({q(c)}), {q(c)})"
            if newest
            else f"{q(c)} = VALUES({q(c)})"
            for c in ordered
        )
        return f"{insert} ON DUPLICATE KEY UPDATE {sets}"
    if dialect == "merge":
        source = ", ".join(f"{mark} AS {q(c)}" for c in columns)
        match = " AND ".join(f"t.{q(k)} = s.{q(k)}" for k in keys)
        sets = ", ".join(f"{q(c)} = s.{q(c)}" for c in values)
        guard = f" AND s.{q(newest)} >= t.{q(newest)}" if newest else ""
        update = f"WHEN MATCHED{guard} THEN UPDATE SET {sets} " if values else ""
        return (
            f"MERGE INTO {q(table)} t USING (SELECT {source}) s ON {match} {update}"
            f"WHEN NOT MATCHED THEN INSERT ({', '.join(map(q, columns))}) "
            f"VALUES ({', '.join('s.' + q(c) for c in columns)})"
        )
    raise ValueError(f"unknown dialect {dialect!r}")


def database_upsert(
    connect: Callable[[], object],
    table: str,
    keys: list[str],
    order_by: list[str],
    batch_size: int = 1000,
    max_connections: int = 16,
    dialect: str = "on_conflict",
    mark: str = "?",
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink: one connection per partition, ``batch_size`` rows a call.

    The batch is first reduced to the latest row per key on the cluster, so the database
    gets each key once and no two connections touch the same row. A repeated task repeats
    the same upserts.
    """

    def write(batch: DataFrame, _batch_id: int) -> None:
        sql = upsert_statement(table, batch.columns, keys, dialect, mark)
        # a shuffle, not coalesce, which would also run the aggregate in so few tasks
        rows = latest_per_key(batch, keys, order_by).repartition(max_connections, *keys)
        _send(rows, connect, sql, batch_size)

    return write


def database_insert(
    connect: Callable[[], object],
    table: str,
    batch_size: int = 1000,
    max_connections: int = 16,
    mark: str = "?",
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink that inserts every row; a repeated task inserts again.

    Use ``InsertWriter`` or ``append_jdbc_batches`` where a repeat must not show.
    """

    def write(batch: DataFrame, _batch_id: int) -> None:
        sql = insert_statement(table, batch.columns, mark)
        _send(batch.repartition(max_connections), connect, sql, batch_size)

    return write


def _send(df: DataFrame, connect, sql: str, batch_size: int) -> None:
    """Run ``sql`` for every row, a partition in one transaction, from columns, not rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        connection, sent = None, 0
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, batch_size):
                    connection = connection or connect()
                    part = batch.slice(at, batch_size)
                    columns = [c.to_pylist() for c in part.columns]
                    connection.cursor().executemany(sql, list(zip(*columns, strict=True)))
                    sent += part.num_rows
            if connection is not None:
                connection.commit()
        finally:
            if connection is not None:
                connection.close()
        yield pa.RecordBatch.from_arrays([pa.array([sent], pa.int64())], ["sent"])

    df.mapInArrow(run, "sent long").agg(F.sum("sent")).collect()


class _Sender:
    """Rows to one connection in calls of ``size`` rows; opens it with the first row."""

    def __init__(self, connect, sql: str, columns: list[str], size: int):
        self._connect, self._sql, self._columns, self._size = connect, sql, columns, size
        self._connection, self._waiting = None, []

    def add(self, row: Row) -> None:
        self._waiting.append(tuple(row[c] for c in self._columns))
        if len(self._waiting) >= self._size:
            self._flush()

    def _flush(self) -> None:
        if self._waiting:
            if self._connection is None:
                self._connection = self._connect()
            self._connection.cursor().executemany(self._sql, self._waiting)
            self._waiting = []

    def commit(self) -> None:
        self._flush()
        if self._connection is not None:
            self._connection.commit()

    def close(self) -> None:
        if self._connection is not None:
            self._connection.close()
            self._connection = None


class _RowWriter:
    """A ``foreach`` writer: each partition of an epoch is one transaction."""

    def __init__(self, connect, sql: str, columns: list[str], batch_size: int):
        self._connect, self._columns, self._batch_size = connect, columns, batch_size
        self._sql = sql
        self._sender = None

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self._sender = _Sender(self._connect, self._sql, self._columns, self._batch_size)
        return True

    def process(self, row: Row) -> None:
        self._sender.add(row)

    def close(self, error: Exception | None) -> None:
        if self._sender is None:
            return
        try:
            if error is None:
                self._sender.commit()
        finally:
            self._sender.close()
            self._sender = None


class UpsertWriter(_RowWriter):
    """A ``foreach`` writer that upserts rows as they come, ``batch_size`` at a time.

    Partitions write in any order, so the stored row is the one with the largest ``newest``.
    """

    def __init__(
        self,
        connect: Callable[[], object],
        table: str,
        columns: list[str],
        keys: list[str],
        newest: str,
        batch_size: int = 100,
        dialect: str = "on_conflict",
        mark: str = "?",
    ):
        sql = upsert_statement(table, columns, keys, dialect, mark, newest)
        super().__init__(connect, sql, columns, batch_size)


class InsertWriter(_RowWriter):
    """A ``foreach`` writer that inserts every row that the table doesn't have yet.

    ``keys`` are unique in the table and name a row wherever it comes from. So a repeated epoch
    adds nothing twice, however its rows are cut into partitions then.
    """

    def __init__(
        self,
        connect: Callable[[], object],
        table: str,
        columns: list[str],
        keys: list[str],
        batch_size: int = 1000,
        dialect: str = "on_conflict",
        mark: str = "?",
    ):
        sql = insert_statement(table, columns, mark, dialect)
        unique = ", ".join(quoted(k, dialect) for k in keys)
        if dialect == "on_conflict":
            sql += f" ON CONFLICT ({unique}) DO NOTHING"
        elif dialect == "on_duplicate_key":
            own = quoted(keys[0], dialect)
            sql += f" ON DUPLICATE KEY UPDATE {own} = {own}"
        else:
            raise ValueError(f"no insert-if-absent in dialect {dialect!r}")
        super().__init__(connect, sql, columns, batch_size)
