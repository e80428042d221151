"""Late rows kept: micro-batches parted by a watermark of their own before any stateful operator.

A stateful query drops rows behind its watermark without a trace. Here the sink of a stateless query
keeps a watermark, the largest event time of the batches before, less a delay, and logs it for each
batch. What is behind it goes to a second output, the rest to the first, which a stateful query with the
same delay then reads: no row it gets is behind its own watermark.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceworks.sources.backlog import as_text
from sluiceworks.storage import SharedFiles
from sluiceworks.streaming.sinks import BatchSink, source_of

_RETAINED = 100  # log entries kept


class LateSplit:
    """A ``foreachBatch`` sink that hands timely rows to one sink and late rows to another.

    A row is late if its ``time`` is less than the largest one of the batches before, less ``delay``,
    an interval. Rows of the same batch don't make each other late, and rows without a time are
    never late. Both sinks are called for every batch, with its id, and must take repeats as the sinks
    of this package do. The log below ``log_dir``, one file for each batch, makes a repeated batch part
    in the same way; sources have logs of their own there.
    """

    def __init__(self, time: str, delay: Column, log_dir: str, timely: BatchSink, late: BatchSink):
        self.time, self.delay, self.log_dir = time, delay, log_dir.rstrip("/")
        self.timely, self.late = timely, late

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, place = batch.sparkSession, f"{self.log_dir}/{source_of(batch)}"
        files = SharedFiles(spark)
        highest = self._highest(files, place, batch_id - 1)
        time, kind = F.col(f"`{self.time}`"), batch.schema[self.time].dataType
        if highest is None:
            behind = F.lit(False)
        else:
            behind = F.coalesce(time < F.lit(highest).cast(kind) - self.delay, F.lit(False))
        self.timely(batch.where(~behind), batch_id)
        self.late(batch.where(behind), batch_id)
        entry = f"{place}/{batch_id:012d}"
        if not files.exists(entry):
            before = F.lit(highest).cast(kind)
            now = batch.agg(as_text(F.greatest(F.max(time), before), kind)).first()[0]
            files.publish_text(entry, json.dumps(now))
            files.delete(f"{place}/{batch_id - _RETAINED:012d}")

    def watermark(self, spark: SparkSession, source: str) -> str | None:
        """The largest event time that a source's batches have had, as text."""
        files = SharedFiles(spark)
        entries = [name for name, _ in files.children(f"{self.log_dir}/{source}")]
        return self._highest(files, f"{self.log_dir}/{source}", int(entries[-1])) if entries else None

    @staticmethod
    def _highest(files: SharedFiles, place: str, batch_id: int) -> str | None:
        if batch_id < 0:
            return None
        return json.loads(files.read_text(f"{place}/{batch_id:012d}"))
