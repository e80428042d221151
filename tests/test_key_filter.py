from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sluiceworks.operators import KeyedTable
from sluiceworks.operators.key_filter import BITS_PER_KEY, filter_bytes, key_filter, split_by_filter
from tests.conftest import plan_of


@pytest.mark.parametrize("n", [1, 2_000, 40_000])
def test_no_key_is_missed_and_few_others_pass(spark, n):
    rows = spark.range(4 * n).select((F.col("id") * 977).alias("k"), F.md5(F.col("id").cast("string")).alias("t"))
    known = rows.where(f"k < 977 * {n}")
    may, stay = split_by_filter(rows, ["k", "t"], key_filter(known, ["k", "t"], n), n)
    assert may.where(f"k < 977 * {n}").count() == n and may.columns == rows.columns
    assert may.count() + stay.count() == 4 * n
    assert may.count() - n <= max(3, 3 * n / BITS_PER_KEY * 1.3)
    assert filter_bytes(n) <= 4160 + n * 3


def test_neither_part_is_shuffled(spark, tmp_path):
    spark.range(10_000).write.parquet(f"{tmp_path}/t")
    rows = spark.read.parquet(f"{tmp_path}/t")
    for part in split_by_filter(rows, ["id"], key_filter(rows.where("id % 3 = 0"), ["id"], 3334), 3334):
        part.count()
        before_broadcast = plan_of(part).split("BroadcastExchange")[0]
        assert "hashpartitioning(id" not in plan_of(part) and "Exchange hash" not in before_broadcast


def test_empty_filter_and_null_keys(spark):
    rows = spark.createDataFrame([(1,), (None,)], "k int")
    may, stay = split_by_filter(rows, ["k"], key_filter(rows.where("false"), ["k"], 0), 0)
    assert may.count() == 0 and stay.count() == 2


@pytest.mark.parametrize("limits", [{}, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "most_filter_bytes": 0}])
def test_all_ways_to_merge_agree(spark, tmp_path, limits):
    """A batch far above the bound for broadcast keys, with new keys, and one that lacks a column."""
    rows = spark.range(3000).select("id", (F.col("id") % 7).alias("v"), F.lit("old").alias("s"))
    table = KeyedTable.create_if_absent(spark, f"{tmp_path}/t", rows.schema, ["id"], buckets=4)
    table.merge(rows, ["v"])
    batch = spark.range(2000, 4000).where("id % 2 = 0").select("id", F.lit(50).cast("bigint").alias("v"))
    table.merge(batch, ["v"], **limits)
    table.merge(batch.where("id < 2100").withColumn("s", F.lit("new")), ["v"], **limits)
    found = {r["id"]: (r["v"], r["s"]) for r in table.read().collect()}
    want = {i: (i % 7, "old") for i in range(3000)}
    want |= {i: (50, want.get(i, (0, None))[1]) for i in range(2000, 4000, 2)}
    want |= {i: (50, "new") for i in range(2000, 2100, 2)}
    assert found == want and table.read().count() == len(want)
