from sluiceworks.sources.feed import accepted, csv_feed, quoted_feed, rejected
from sluiceworks.sources.incremental import (
    FrameTable,
    IncrementalReader,
    JdbcTable,
    OffsetRange,
    jdbc_stream,
    offset_bounds,
)
from sluiceworks.sources.rate import rate_stream
from sluiceworks.sources.records import csv_lines, whole_records
from sluiceworks.sources.stream_source import register as register_stream_source
from sluiceworks.sources.tables import append_stream, jdbc_table
from sluiceworks.sources.topic import ENVELOPE, from_offsets, kafka_stream, pinned_ends

__all__ = [
    "ENVELOPE",
    "FrameTable",
    "IncrementalReader",
    "JdbcTable",
    "OffsetRange",
    "accepted",
    "append_stream",
    "csv_feed",
    "csv_lines",
    "from_offsets",
    "jdbc_stream",
    "jdbc_table",
    "kafka_stream",
    "offset_bounds",
    "pinned_ends",
    "quoted_feed",
    "rate_stream",
    "register_stream_source",
    "rejected",
    "whole_records",
]
