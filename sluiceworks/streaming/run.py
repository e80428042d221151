"""Starting and ending streaming queries."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
# Join state off the Java heap, changes uploaded instead of whole snapshots, no lookup per
# write just to count rows, and one store per partition instead of four.
_STATE = {
    _PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}
_lock = threading.Lock()


@contextmanager
def _state_settings(spark: SparkSession) -> Iterator[None]:
    """The settings above while a query starts, which is when it copies them.

    A session that names a state store provider keeps all its own settings.
    """
    with _lock:
        before = {name: spark.conf.get(name, None) for name in _STATE}
        mine = {} if before[_PROVIDER] else {n: v for n, v in _STATE.items() if not before[n]}
        for name, value in mine.items():
            spark.conf.set(name, value)
        try:
            yield
        finally:
            for name in mine:
                spark.conf.unset(name)


def start(
    df: DataFrame,
    checkpoint: str,
    path: str | None = None,
    *,
    format: str = "parquet",
    each_batch: Callable[[DataFrame, int], None] | None = None,
    each_row: object | None = None,
    output_mode: str = "append",
    every: str | None = None,
    options: dict[str, str] | None = None,
) -> StreamingQuery:
    """Start a query that survives restarts: the checkpoint path is required.

    The rows go to ``each_batch``, to ``each_row`` or to ``format`` at ``path``
    (``console`` and ``memory`` need no path). ``every`` is a processing-time
    interval; without it the query handles all available input and ends. Join
    state lives in RocksDB unless the session names a state store provider.
    """
    writer = (
        df.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .options(**(options or {}))
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    if each_batch is not None:
        writer = writer.foreachBatch(each_batch)
    elif each_row is not None:
        writer = writer.foreach(each_row)
    else:
        writer = writer.format(format)
    with _state_settings(df.sparkSession):
        return writer.start(path) if path else writer.start()


def finish(query: StreamingQuery, timeout: float | None = None) -> bool:
    """Wait for the end, at most ``timeout`` seconds, and stop the query in any case."""
    try:
        if timeout is None:
            query.awaitTermination()
            return True
        return bool(query.awaitTermination(timeout))
    finally:
        query.stop()
