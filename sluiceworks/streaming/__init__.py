from sluiceworks.streaming.database import (
    InsertWriter,
    UpsertWriter,
    database_insert,
    database_upsert,
    insert_statement,
    upsert_statement,
)
from sluiceworks.streaming.jdbc import Database
from sluiceworks.streaming.late import LateSplit
from sluiceworks.streaming.run import finish, start
from sluiceworks.streaming.sinks import append_batches, append_jdbc_batches, merge_batches
from sluiceworks.streaming.staged import StagedUpsert, merge_statement

__all__ = [
    "Database",
    "InsertWriter",
    "LateSplit",
    "StagedUpsert",
    "UpsertWriter",
    "append_batches",
    "append_jdbc_batches",
    "database_insert",
    "database_upsert",
    "finish",
    "insert_statement",
    "merge_batches",
    "merge_statement",
    "start",
    "upsert_statement",
]
