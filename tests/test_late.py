from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sluiceworks.streaming import LateSplit, append_batches
from sluiceworks.streaming.sinks import read_batches

BASE = datetime(2024, 3, 1)
KIND = "id int, t timestamp"


def at(hours):
    return None if hours is None else BASE + timedelta(hours=hours)


@pytest.fixture
def split(spark, tmp_path):
    sinks = [append_batches(f"{tmp_path}/{n}") for n in ("timely", "late")]
    own = LateSplit("t", F.expr("INTERVAL 2 HOURS"), f"{tmp_path}/log", *sinks)

    def give(batch_id, *rows, by=own):
        by(spark.createDataFrame([(i, at(h)) for i, h in rows], KIND), batch_id)

    def found(name):
        schema = spark.createDataFrame([], KIND).schema
        return sorted(r["id"] for r in read_batches(spark, f"{tmp_path}/{name}", schema).collect())

    return give, found, own


def test_rows_behind_the_batches_before_are_late(split, spark):
    give, found, own = split
    give(0, (1, 10), (2, 1))  # nothing before, so nothing late
    give(1, (3, 8), (4, 7.99), (5, None), (6, 12))
    give(2, (7, 9), (8, 10), (9, 11.5))
    assert found("timely") == [1, 2, 3, 5, 6, 8, 9] and found("late") == [4, 7]
    assert own.watermark(spark, "direct").startswith("2024-03-01 12:00:00")
    assert own.watermark(spark, "another") is None


def test_a_repeated_batch_parts_in_the_same_way(split):
    give, found, _ = split
    give(0, (1, 10))
    for _ in range(2):
        give(1, (2, 9), (3, 20), (4, 5))
    give(1, (2, 9), (3, 20), (4, 5))
    assert found("timely") == [1, 2, 3] and found("late") == [4]


def test_a_batch_cut_short_parts_in_the_same_way(split, spark, tmp_path):
    give, found, own = split
    give(0, (1, 10))

    def fails(batch, batch_id):
        raise RuntimeError("lost")

    broken = LateSplit("t", F.expr("INTERVAL 2 HOURS"), own.log_dir, own.timely, fails)
    with pytest.raises(RuntimeError):
        give(1, (2, 30), (3, 1), by=broken)
    give(1, (2, 30), (3, 1))
    assert found("timely") == [1, 2] and found("late") == [3]


def test_empty_batches_keep_the_watermark(split):
    give, found, _ = split
    give(0)
    give(1, (1, None))
    give(2, (2, 10))
    give(3)
    give(4, (3, 7))
    assert found("timely") == [1, 2] and found("late") == [3]
