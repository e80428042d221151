"""Exact nearest binary codes by multi-index hashing with growing radii.

A code, of one or more 64-bit words, is cut into segments. Two codes at distance d differ by at most d // segments bits in
some segment, so every code within segments * (r + 1) - 1 bits of a query shows up when each segment is
looked up with all values up to r bits away. Round r adds the values exactly r bits away, and only for
queries whose k-th neighbour so far is farther than what the rounds before it cover.

Equal codes are one entry with their k smallest ids; no answer needs more of them. Equal queries are
one query.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from sluiceworks.llm.tables import partitions, release, stored

WORD = 64
LITERAL_BITS = 16  # masks of so many bits are listed in the plan, at most 12,870 of them


def sign_code(vector: str) -> Column:
    """The signs of all components as bits, in an array of 64-bit words; null components are 0.

    A null or empty vector is one word of zeros.
    """
    bit = f"CASE WHEN get({vector}, w * {WORD} + i) > 0 THEN 1L ELSE 0L END"
    word = f"aggregate(sequence(0, {WORD - 1}), 0L, (a, i) -> a | shiftleft({bit}, i))"
    last = f"greatest((size({vector}) - 1) div {WORD}, 0)"  # the size of null is -1 or null
    last = f"coalesce(int({last}), 0)"
    return F.expr(f"transform(sequence(0, {last}), w -> {word})")


def flips(width: int, r: int) -> list[int]:
    """All values of ``width`` bits with r of them set."""
    return [sum(1 << i for i in c) for c in combinations(range(width), r)]


def _listed(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _with_masks(probes: DataFrame, width: int, r: int) -> DataFrame:
    """Each row with every ``mask`` of ``width`` bits with r of them set.

    Wide masks are put together in the tasks from two halves, so neither the plan nor a row holds
    all of them.
    """
    if width <= LITERAL_BITS:
        return probes.withColumn("mask", F.explode(_listed(flips(width, r))))
    half = width // 2
    parts = None
    for low in range(max(0, r - half), min(r, half) + 1):
        lows, highs = flips(half, low), flips(half, r - low)
        part = probes.withColumn("low", F.explode(_listed(lows))).withColumn("high", F.explode(_listed(highs)))
        part = part.withColumn("mask", F.expr(f"low | shiftleft(high, {half})")).drop("low", "high")
        parts = part if parts is None else parts.unionAll(part)
    return parts


def _segment(code: str, s: int, width: int) -> Column:
    word, shift = divmod(s * width, WORD)
    return F.expr(f"shiftrightunsigned({code}.w{word}, {shift}) & {(1 << width) - 1}L")


def _words(code: Column, n: int) -> Column:
    """A code as a struct of n words; those it lacks are 0."""
    return F.struct(*[F.coalesce(F.get(code, F.lit(i)), F.lit(0).cast("long")).alias(f"w{i}") for i in range(n)])


def _hit(words: int) -> str:
    code = ",".join(f"w{i}:long" for i in range(words))
    return f"struct<distance:int,least:long,members:int,code:struct<{code}>>"


def nearest(codes: DataFrame, queries: DataFrame, k: int, width: int | None = None) -> DataFrame:
    """query_id, rank, id, distance: the k nearest of ``codes`` (id, code) to each of ``queries``.

    ``queries`` has query_id and code. Neighbours are ranked by Hamming distance, then id; a query
    that is among the codes finds itself. With fewer than k codes all are returned. A code is a number
    or an array of them, 64 bits each; of codes of several lengths the shorter ones go on with zeros.
    ``width`` is the number of bits of a segment, a divisor of 64 up to 32; the result is the same with
    any. Left out, it is the one nearest to log2 of the number of codes, so that a value has about
    one. Rows without id or code are left out, repeated rows count once, queries without code get no neighbours,
    repeated queries are answered each. Empty tables give an empty result. Columns other than these
    aren't read.
    """
    if width and (WORD % width or width > WORD // 2):
        raise ValueError(f"{width} is no divisor of {WORD} up to {WORD // 2}")
    spark = codes.sparkSession
    codes, queries = (
        df if isinstance(df.schema["code"].dataType, ArrayType) else df.withColumn("code", F.array("code"))
        for df in (codes.where("code IS NOT NULL"), queries.where("code IS NOT NULL"))
    )
    sizes = codes.select("code").unionAll(queries.select("code"))
    words = max(1, sizes.agg(F.max(F.size("code"))).first()[0] or 1)
    bits, hit = WORD * words, _hit(words)
    apart = " + ".join(f"bit_count(query.w{i} ^ code.w{i})" for i in range(words))
    real = codes.where("id IS NOT NULL").select("id", _words(F.col("code"), words).alias("code")).distinct()
    place = F.row_number().over(Window.partitionBy("code").orderBy("id"))
    entries = (
        real.withColumn("place", place)
        .where(F.col("place") <= k)
        .groupBy("code")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"))
    )
    entries = stored(spark, entries, "codes")
    size = entries.agg(F.count("*").alias("codes"), F.sum(F.size("ids")).alias("members")).first()
    total = size["members"] or 0
    width = width or min((4, 8, 16, 32), key=lambda w: abs(w - math.log2(max(2, size["codes"]))))
    segments = bits // width
    index = entries.select(
        "code",
        F.col("ids")[0].alias("least"),
        F.size("ids").alias("members"),
        F.posexplode(F.array(*[_segment("code", s, width) for s in range(segments)])).alias(
            "segment", "value"
        ),
    )
    index = stored(spark, index, "segments")
    asked = queries.select("query_id", _words(F.col("code"), words).alias("code"))
    open_ = asked.select(F.col("code").alias("query")).distinct()
    nothing = F.expr(f"cast(array() as array<{hit}>)")
    open_ = stored(spark, open_.select("query", F.lit(bits).alias("bound"), nothing.alias("found")), "open")
    done = []
    for r in range(width + 1):
        if open_.isEmpty():
            break
        # a query has thousands of probes, which its size doesn't show: deal them out beforehand,
        # and never broadcast them
        own = F.array(*[_segment("query", s, width) for s in range(segments)])
        dealt = open_.repartition(partitions(spark), "query").select(
            "query", "bound", F.posexplode(own).alias("segment", "own")
        )
        probes = _with_masks(dealt, width, r).select(
            "query", "bound", "segment", F.expr("own ^ mask").alias("value")
        )
        # nothing beyond the k-th entry so far can get into the answer
        hits = (
            probes.hint("merge")
            .join(index, ["segment", "value"])
            .withColumn("distance", F.expr(apart))
            .where("distance <= bound")
            .select("query", F.struct("distance", "least", "members", "code").alias("hit"))
        )
        # the k nearest entries hold the k nearest members
        before = open_.select("query", F.explode("found").alias("hit"))
        rank = F.row_number().over(Window.partitionBy("query").orderBy("hit"))
        best = (
            hits.union(before)
            .distinct()
            .withColumn("rank", rank)
            .where(F.col("rank") <= k)
            .groupBy("query")
            .agg(F.sort_array(F.collect_list("hit")).alias("found"))
        )
        covered = segments * (r + 1) - 1
        near = F.expr(f"filter(found, h -> h.distance <= {covered})")
        members = F.aggregate(near, F.lit(0), lambda a, h: a + h["members"])
        after = stored(
            spark,
            open_.select("query")
            .join(best, "query", "left")
            .withColumn("found", F.coalesce("found", nothing))
            .withColumn("bound", F.coalesce(F.get("found", F.lit(k - 1))["distance"], F.lit(bits)))
            .withColumn("sure", members >= min(k, total)),
            "round",
        )
        done.append(after.where("sure").drop("sure"))
        open_ = after.where("NOT sure").drop("sure")
        release(spark)
    if not done:
        return spark.createDataFrame([], "query_id long, rank int, id long, distance int")
    answers = done[0]
    for more in done[1:]:
        answers = answers.union(more)
    hits = answers.select("query", F.explode("found").alias("hit")).select(
        "query", F.col("hit.code").alias("code"), F.col("hit.distance").alias("distance")
    )
    each = hits.join(entries, "code").select("query", "distance", F.explode("ids").alias("id"))
    order = F.row_number().over(Window.partitionBy("query").orderBy("distance", "id"))
    top = each.withColumn("rank", order).where(F.col("rank") <= k)
    return asked.join(top, asked["code"] == top["query"]).select("query_id", "rank", "id", "distance")
