from sluiceworks.operators.catalog_merge import merge_into
from sluiceworks.operators.joins import (
    hot_keys,
    interval_join,
    key_join,
    pinned_hot_keys,
    time_bin,
)
from sluiceworks.operators.keyed_table import KeyedTable
from sluiceworks.operators.latest import latest_per_key

__all__ = [
    "KeyedTable",
    "hot_keys",
    "interval_join",
    "key_join",
    "latest_per_key",
    "merge_into",
    "pinned_hot_keys",
    "time_bin",
]
