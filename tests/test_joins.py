from __future__ import annotations

import itertools
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluiceworks.operators import hot_keys, interval_join, key_join, pinned_hot_keys, time_bin
from sluiceworks.plans import queries
from sluiceworks.sources import append_stream
from sluiceworks.streaming import finish, start
from tests.conftest import plan_of

DAWN = datetime(2024, 1, 1)


def settle(df, tmp_path):
    finish(start(df, f"{tmp_path}/checkpoint", f"{tmp_path}/out"))
    return df.sparkSession.read.schema(df.schema).parquet(f"{tmp_path}/out")


@pytest.fixture
def ticks(spark, tmp_path):
    """200 rows one second apart."""
    spark.range(200).select(
        F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("timestamp"), F.col("id").alias("value")
    ).coalesce(1).write.parquet(f"{tmp_path}/ticks")
    schema = spark.read.parquet(f"{tmp_path}/ticks").schema
    return lambda: append_stream(spark, f"{tmp_path}/ticks", schema)


def impressions_and_clicks(ticks, shift):
    impressions = ticks().select(
        F.col("value").alias("impressionAdId"), F.col("timestamp").alias("impressionTime")
    )
    clicks = ticks().select(
        (F.col("value") + shift).alias("clickAdId"), F.col("timestamp").alias("clickTime")
    )
    return interval_join(
        impressions,
        clicks,
        [("impressionAdId", "clickAdId")],
        "impressionTime",
        "clickTime",
        timedelta(0),
        timedelta(seconds=30),
        "left_outer",
        "20 seconds",
        "30 seconds",
    )


def test_clicks_before_their_impressions_never_match(ticks, tmp_path):
    rows = settle(impressions_and_clicks(ticks, 15), tmp_path).collect()
    assert sorted(r["impressionAdId"] for r in rows) == list(range(139))
    assert all(r["clickAdId"] is None and r["clickTime"] is None for r in rows)


def test_clicks_after_their_impressions_match(ticks, tmp_path):
    rows = settle(impressions_and_clicks(ticks, -15), tmp_path).collect()
    assert len(rows) == 185
    assert all(r["clickAdId"] == r["impressionAdId"] for r in rows)


def split_by_type(spark, tmp_path, rows):
    schema = "id bigint, type string, createDate timestamp"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in")

    def side(kind, prefix):
        stream = append_stream(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema)
        return stream.where(F.col("type") == kind).select(
            *[F.col(c).alias(f"{prefix}_{c}") for c in ("id", "type", "createDate")]
        )

    return interval_join(
        side("type1", "s1"),
        side("type2", "s2"),
        [("s1_id", "s2_id")],
        "s1_createDate",
        "s2_createDate",
        timedelta(minutes=-5),
        timedelta(0),
        "left_outer",
        "5 minutes",
        "5 minutes",
    )


def test_unmatched_row_waits_for_the_watermark(spark, tmp_path):
    rows = [(1000, "type1", DAWN), (1001, "type1", DAWN), (1001, "type2", DAWN)]
    got = settle(split_by_type(spark, tmp_path, rows), tmp_path).select("s2_id", "s2_type")
    assert [tuple(r) for r in got.collect()] == [(1001, "type2")]


def test_unmatched_rows_come_strictly_before_the_watermark(spark, tmp_path):
    rows = [(i, "type1", DAWN + timedelta(seconds=i)) for i in range(1000)]
    rows.append((5000, "type2", DAWN + timedelta(seconds=999)))
    got = settle(split_by_type(spark, tmp_path, rows), tmp_path)
    assert sorted(r["s1_id"] for r in got.collect()) == list(range(699))


def brute(left, right, lower, upper, outer):
    pairs = []
    for k, t, i in left:
        hits = [(i, j) for q, u, j in right if k == q and t + lower <= u <= t + upper]
        pairs += hits or ([(i, None)] if outer else [])
    return sorted(pairs, key=repr)


def batch_join(spark, left, right, lower, upper, how, hot=()):
    a = spark.createDataFrame(
        [(k, DAWN + timedelta(seconds=t), i) for k, t, i in left], "k int, t timestamp, i int"
    )
    b = spark.createDataFrame(
        [(k, DAWN + timedelta(seconds=t), i) for k, t, i in right], "q int, u timestamp, j int"
    )
    span = (timedelta(seconds=lower), timedelta(seconds=upper))
    return interval_join(a, b, [("k", "q")], "t", "u", *span, how, hot=hot)


times = st.lists(st.tuples(st.integers(0, 1), st.integers(-20, 20)), min_size=1, max_size=12)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    left=times,
    right=times,
    lower=st.integers(-6, 6),
    width=st.integers(0, 7),
    how=st.sampled_from(["inner", "left_outer"]),
    hot=st.sampled_from([[], [((1,), 3, 2)], [((0,), 2, 1), ((1,), 1, 4)], [((5,), 2, 2)]]),
)
def test_equals_the_definition(spark, left, right, lower, width, how, hot):
    number = itertools.count()
    left = [(k, t, next(number)) for k, t in left]
    right = [(k, t, next(number)) for k, t in right]
    if how == "left_outer":
        hot = [(k, a, 1) for k, a, _ in hot]
    got = batch_join(spark, left, right, lower, lower + width, how, hot)
    found = sorted(((r["i"], r["j"]) for r in got.collect()), key=repr)
    assert found == brute(left, right, lower, lower + width, how == "left_outer")


def test_a_hot_key_is_spread_over_time(spark):
    """One key for all rows: the join still hashes on the bin, not on the key alone."""
    left = [(1, t, t) for t in range(50)]
    joined = batch_join(spark, left, left, 0, 2, "inner")
    assert joined.count() == 50 + 49 + 48
    plan = plan_of(joined)
    assert "_bin_l" in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_hot_keys_are_counted_on_both_sides(spark):
    left = spark.range(300).select(F.when(F.col("id") < 100, 7).otherwise(F.col("id")).alias("k"))
    right = spark.range(60).select(F.when(F.col("id") < 30, 8).otherwise(None).alias("q"))
    keys = [("k", "q")]
    assert hot_keys(left, right, keys, 25) == [((7,), 4, 1), ((8,), 1, 2)]
    assert hot_keys(left, right, keys, 25, "left_outer") == [((7,), 4, 1)]
    assert hot_keys(left, right, keys, 100) == []
    assert hot_keys(left.limit(0), right.limit(0), keys, 1) == []


def test_many_keys_just_above_the_size_are_all_found(spark):
    left = spark.range(12_000).select((F.col("id") % 120).alias("k"))
    assert len(hot_keys(left, left.toDF("q"), [("k", "q")], 99)) == 120


def test_a_key_is_hot_within_a_bin(spark):
    """Key 1 is frequent but spread over time; key 2 is frequent in one bin."""
    span = timedelta(0), timedelta(seconds=1)
    df = spark.range(400).select(
        (F.col("id") % 2 + 1).alias("k"),
        F.timestamp_seconds(F.when(F.col("id") % 2 == 0, F.col("id") * 50).otherwise(0)).alias("t"),
    )
    right, keys = df.toDF("q", "u"), [("k", "q")]
    assert [h[0] for h in hot_keys(df, right, keys, 20)] == [(1,), (2,)]
    assert hot_keys(df, right, keys, 20, "inner", time_bin("t", *span)) == [((2,), 10, 1)]


def test_both_sides_hot(spark):
    left = spark.range(600).select(F.lit(1).alias("k"), F.col("id").alias("i"))
    right = spark.range(50).select(F.lit(1).alias("q"), F.col("id").alias("j"))
    hot = hot_keys(left, right, [("k", "q")], 20)
    assert hot == [((1,), 30, 3)]
    joined = key_join(left, right, [("k", "q")], hot=hot)
    assert joined.distinct().count() == joined.count() == 600 * 50
    with pytest.raises(ValueError):
        key_join(left, right, [("k", "q")], "left_outer", hot=hot)


def test_a_changed_list_is_refused(spark, tmp_path):
    place = f"{tmp_path}/keys"
    first = [((1, "a"), 3, 1)]
    assert pinned_hot_keys(spark, place, first) == first
    assert pinned_hot_keys(spark, place) == first
    assert pinned_hot_keys(spark, place, first) == first
    with pytest.raises(ValueError, match="other hot keys"):
        pinned_hot_keys(spark, place, [((2, "a"), 3, 1)])


def test_bins_of_distant_times(spark):
    times = [datetime(1, 1, 1), datetime(1969, 12, 31, 23, 59, 59, 999999), datetime(9999, 12, 31)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    micro = timedelta(microseconds=1)
    day = timedelta(days=1)
    for lower, upper in ((timedelta(0), micro), (-day, day), (timedelta(0), timedelta(0))):
        width = max((upper - lower) // micro, 1) * 4
        expected = [(t - datetime(1970, 1, 1)) // micro // width for t in times]
        got = [r[0] for r in df.select(time_bin("t", lower, upper)).collect()]
        assert got == expected


def test_hot_key_in_one_bin_is_spread_and_stays_whole(spark):
    """A third of the rows have one key and nearly one time."""
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 7).alias("t"),
        F.col("id").alias("i"),
    )
    right = spark.createDataFrame([(-1, 1), (4, 2)], "q bigint, j int").withColumn(
        "u", F.timestamp_seconds(F.lit(1_700_000_003))
    )
    hot = hot_keys(left, right, [("k", "q")], 100, "left_outer")
    assert hot == [((-1,), 10, 1)]
    span = (timedelta(seconds=-60), timedelta(seconds=60))
    joined = interval_join(left, right, [("k", "q")], "t", "u", *span, "left_outer", hot=hot)
    assert joined.count() == 3000 and joined.where("j = 1").count() == 1000
    assert joined.where("j = 2").count() == 1
    assert "_cell_l" in plan_of(joined)
    two = [("k", "q"), ("i", "j")]
    twice = interval_join(left, right, two, "t", "u", *span, "inner", hot=[((-1, 1), 2, 1), ((4, 2), 2, 2)])
    assert twice.count() == left.where("(k = -1 and i = 1) or (k = 4 and i = 2)").count()


def test_null_times_and_keys(spark):
    a = spark.createDataFrame([(1, None), (None, DAWN), (2, DAWN)], "k int, t timestamp")
    b = spark.createDataFrame([(1, DAWN), (None, DAWN), (2, None)], "q int, u timestamp")
    got = interval_join(a, b, [("k", "q")], "t", "u", timedelta(0), timedelta(1), "left_outer")
    assert got.where("q is null").count() == 3 and got.count() == 3


def test_key_join_on_streams(spark, ticks, tmp_path):
    left = ticks().select(F.col("value").alias("a"), "timestamp")
    right = ticks().select((F.col("value") % 50).alias("b"), F.col("value").alias("c"))
    got = settle(key_join(left, right, [("a", "b")], hot=[((7,), 3, 2)]), tmp_path)
    assert got.count() == 200 and got.where("a <> b").count() == 0


def test_refused_arguments(spark, ticks):
    left, right = ticks().select("value"), ticks().select(F.col("value").alias("v2"))
    with pytest.raises(ValueError):
        key_join(left, right, [("value", "v2")], "left_outer")
    with pytest.raises(ValueError):
        key_join(left, right, [("value", "v2")], "cross")
    with pytest.raises(ValueError):
        interval_join(
            ticks(), ticks().toDF("t2", "v2"), [("value", "v2")], "timestamp", "t2",
            timedelta(1), timedelta(0),
        )
    with pytest.raises(ValueError):
        interval_join(
            ticks(), ticks().toDF("t2", "v2"), [("value", "v2")], "timestamp", "t2",
            timedelta(0), timedelta(1), "left_outer",
        )


def test_late_row_is_dropped_once_the_watermark_is_old(spark, tmp_path):
    """Rows far behind the watermark of the batch before last no longer join."""
    schema = "k int, side string, ts timestamp"

    def land(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(
            f"{tmp_path}/in"
        )

    def run():
        def side(name, prefix):
            stream = append_stream(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema)
            return stream.where(F.col("side") == name).select(
                F.col("k").alias(f"{prefix}_k"), F.col("ts").alias(f"{prefix}_ts")
            )

        joined = interval_join(
            side("l", "l"), side("r", "r"), [("l_k", "r_k")], "l_ts", "r_ts",
            timedelta(0), timedelta(seconds=10), "inner", "1 minute", "1 minute",
        )
        finish(start(joined, f"{tmp_path}/checkpoint", f"{tmp_path}/out"))

    hour = timedelta(hours=1)
    land((1, "l", DAWN), (1, "r", DAWN))
    run()
    land((2, "l", DAWN + hour), (2, "r", DAWN + hour))
    run()
    land((3, "l", DAWN + 2 * hour), (3, "r", DAWN + 2 * hour))
    run()
    land((9, "l", DAWN), (9, "r", DAWN))
    run()
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    assert sorted(r["l_k"] for r in got) == [1, 2, 3]


@pytest.mark.parametrize("hot", [[], [((0,), 3, 1)]])
def test_many_restarts_give_the_rows_of_one_run(spark, tmp_path, hot):
    """Input lands in five parts by time; each run restores its state from the checkpoint."""
    everything = spark.range(1200).select(
        (F.col("id") % 5 % 4).alias("k"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 7).alias("ts"),
        (F.xxhash64("id") % 3 == 0).alias("is_left"),
        F.col("id").alias("n"),
    )
    span = timedelta(seconds=-10), timedelta(seconds=25)

    def sides(rows):
        left = rows.where("is_left").select(*[F.col(c).alias(f"l_{c}") for c in ("k", "ts", "n")])
        right = rows.where("not is_left").select(*[F.col(c).alias(f"r_{c}") for c in ("k", "ts", "n")])
        return left, right

    def joined(rows):
        keys = [("l_k", "r_k")]
        return interval_join(
            *sides(rows), keys, "l_ts", "r_ts", *span, "left_outer", "20 seconds", "40 seconds", hot=hot
        )

    for part in range(5):
        mine = everything.where(F.col("n").between(240 * part, 240 * part + 239))
        mine.coalesce(2).write.mode("append").parquet(f"{tmp_path}/in")
        stream = append_stream(spark, f"{tmp_path}/in", everything.schema)
        finish(start(joined(stream), f"{tmp_path}/checkpoint", f"{tmp_path}/out"))

    left, right = sides(everything)
    newest_left = left.agg(F.max("l_ts")).first()[0] - timedelta(seconds=20)
    newest_right = right.agg(F.max("r_ts")).first()[0] - timedelta(seconds=40)
    limit = min(newest_left, newest_right) - span[1]
    expected = joined(everything).where(F.col("r_n").isNotNull() | (F.col("l_ts") < F.lit(limit)))
    got = spark.read.schema(expected.schema).parquet(f"{tmp_path}/out")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, expected.collect()))
    assert got.where("r_n is null").count() > 0


@pytest.mark.parametrize("rows_per_task", [40, 100, 700, 5000])
def test_hot_keys_are_all_that_have_more_rows(spark, rows_per_task):
    """Many keys just above and below the bound, and one with a third of the rows."""
    sizes = {k: 30 + k for k in range(90)} | {1000: 3000}
    rows = [(k, f"n{k}") for k, n in sizes.items() for _ in range(n)] + [(None, "x")] * 900
    left = spark.createDataFrame(rows, "a int, b string").repartition(7)
    right = spark.createDataFrame([(1, "n1"), (5000, "z")], "c int, d string")
    found = hot_keys(left, right, [("a", "c"), ("b", "d")], rows_per_task)
    want = [((k, f"n{k}"), -(-n // rows_per_task), 1) for k, n in sizes.items() if n > rows_per_task]
    assert found == sorted(want, key=lambda w: repr(w[0]))


@pytest.mark.parametrize("how", ["inner", "left_outer"])
@pytest.mark.parametrize("hot", [[], [((0,), 3, 2)]])
def test_totals_of_partners(spark, how, hot):
    left = [(i, 0 if i % 2 else i) for i in range(20)] + [(99, None)]
    right = [(i, 0 if i % 3 else i) for i in range(30)] * 2 + [(7, None), (None, 4)]
    a = spark.createDataFrame(left, "i int, k int")
    b = spark.createDataFrame(right, "j int, q int")
    hot = [(k, x, 1) if how == "left_outer" else (k, x, y) for k, x, y in hot]
    totals = {"n": F.count("*"), "all": F.sum("j")}
    joined = key_join(a, b, [("k", "q")], how, hot, totals=totals)
    got = joined.groupBy("i", "k").agg(F.sum("n").alias("n"), F.sum("all").alias("all")).collect()
    expected = []
    for i, k in left:
        mine = [j for j, q in right if k is not None and q == k]
        if mine or how == "left_outer":
            known = [j for j in mine if j is not None]
            expected.append((i, k, len(mine) or None, sum(known) if known else None))
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


def test_totals_need_tables_without_times(spark, ticks):
    stream = ticks().select(F.col("value").alias("a"))
    rows = spark.range(3).withColumnRenamed("id", "b")
    with pytest.raises(ValueError, match="totals"):
        key_join(stream, rows, [("a", "b")], totals={"n": F.count("*")})


def test_key_hot_on_both_sides_builds_no_pairs(spark, tmp_path, monkeypatch):
    spark.range(3000).withColumnRenamed("id", "o_orderkey").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(5000).withColumnRenamed("id", "c_custkey").write.parquet(f"{tmp_path}/customer.parquet")
    seen = []

    def spy(*args, **named):
        seen.append(key_join(*args, **named))
        return seen[-1]

    monkeypatch.setattr(queries, "key_join", spy)
    got = {r["o_orderkey"]: (r["n"], r["sum_custkey"]) for r in queries.join_hot_both(spark, str(tmp_path)).collect()}
    partners = range(0, 5000, 50)
    expected = {i: (1, i) for i in range(3000) if i % 3 and i % 50}
    expected |= {i: (len(partners), sum(partners)) for i in range(0, 3000, 3)}
    assert got == expected
    assert seen[0].count() < 10 * 3000  # there are 100,000 pairs of the hot key
