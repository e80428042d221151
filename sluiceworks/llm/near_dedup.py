"""Near duplicates by one-permutation MinHash with optimal densification.

1. Every text becomes its set of word shingles. One hash of each shingle serves all bins: the top
   bits choose the bin, the smallest value of a bin is its sketch. An empty bin takes the sketch of
   the first non-empty bin on its own pseudo-random walk over all bins, the same walk for every text.
2. Texts with equal sets form a class, so a group of copies is one member from here on.
3. Bins are joined into bands. Members that share a band's value form a bucket.
4. A bucket gives a star: an edge from its first member to each other one, so n - 1 pairs. Pairs whose
   sizes rule a link out are left away. Every other edge is confirmed on the full sets.
5. Confirmed links are followed to components. Where a bucket still holds several, its first member
   may have been a poor centre. The members of such buckets are entered again, under the rarest of
   the shingles that several components have, as many as a link can't do without. These buckets get
   stars too, with eight times the centres each round, over members of different components that
   can be linked by the sizes of their sets and of what they share. So no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluiceworks.llm.arrow_words import Chunk, WordReader, mix
from sluiceworks.llm.tables import modest_batches, release, stored

BINS_BITS = 7
BINS = 1 << BINS_BITS
ROWS = 4  # bins of a band
BANDS = BINS // ROWS
SHINGLE = 5
PERCENT = 85
MEMBERS_PER_TASK = 2048  # members that one task compares with a centre, see confirm()


def shingle_sets(chunk: Chunk, k: int) -> Iterator[np.ndarray]:
    """For each document its sorted distinct shingle hashes; a shorter text is one shingle."""
    grams, whole = chunk.grams(k)
    for a, b in zip(chunk.bounds[:-1].tolist(), chunk.bounds[1:].tolist(), strict=True):
        if b - a >= k:
            s = np.sort(grams[a : b - k + 1])
            keep = np.ones(len(s), dtype=bool)
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            yield s[keep]
        elif b > a:
            h = np.full(1, b - a, dtype=np.uint64)
            for i in range(a, b):
                h = mix(h * np.uint64(0x9E3779B97F4A7C15) + chunk.hashes[i : i + 1])
            yield h
        else:
            yield grams[:0]


def walks() -> np.ndarray:
    """Row i: the order in which bin i looks for a non-empty bin."""
    rng = np.random.default_rng(77)
    return np.argsort(rng.random((BINS, BINS)), axis=1)


def sketch(s: np.ndarray, walk: np.ndarray) -> np.ndarray:
    """The densified bins of a non-empty sorted set."""
    shift = np.uint64(64 - BINS_BITS)
    floor = np.arange(BINS, dtype=np.uint64) << shift
    first = np.searchsorted(s, floor)
    value = s[np.minimum(first, len(s) - 1)]
    full = (first < len(s)) & (value >> shift == np.arange(BINS, dtype=np.uint64))
    if not full.all():
        empty = np.flatnonzero(~full)
        tried = full[walk[empty]]
        value[empty] = value[walk[empty, tried.argmax(axis=1)]]
    return value


def band_keys(value: np.ndarray) -> np.ndarray:
    rows = value.reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, i])
    return key


def set_key(s: np.ndarray) -> tuple[int, int]:
    """Two hashes of a set."""
    with np.errstate(over="ignore"):
        a, b = s.sum(dtype=np.uint64), mix(s ^ np.uint64(0xA5A5A5A55A5A5A5A)).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


def _sketches(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, walk = WordReader(lower=True), walks()
        for batch in batches:
            ids = batch.column(0)
            for chunk in reader.chunks(batch.column(1)):
                size, one, two, bands = [], [], [], []
                for s in shingle_sets(chunk, k):
                    x, y = set_key(s)
                    size.append(len(s))
                    one.append(x)
                    two.append(y)
                    bands.append(band_keys(sketch(s, walk)).view(np.int64) if len(s) else [])
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(chunk.first, len(chunk)),
                        pa.array(size, pa.int64()),
                        pa.array(one, pa.int64()),
                        pa.array(two, pa.int64()),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n_shingles", "key1", "key2", "bands"],
                )

    return run


def _packed_sets(k: int):
    """Texts to their sets, eight bytes a shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = WordReader(lower=True)
        for batch in batches:
            for chunk in reader.chunks(batch.column(1)):
                packed = [s.tobytes() for s in shingle_sets(chunk, k)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.first, len(chunk)), pa.array(packed, pa.binary())],
                    ["doc_id", "words"],
                )

    return run


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, component, shingle) for each shingle of packed sets."""
    for batch in batches:
        for node, words, part in zip(*batch.columns, strict=True):
            s = np.frombuffer(words.as_buffer(), np.int64)
            same = [np.full(len(s), x.as_py(), np.int64) for x in (node, part)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (*same, s)], ["node", "component", "shingle"]
            )


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common values of two sorted sets."""
    both = np.concatenate([a, b])
    both.sort()
    return int((both[1:] == both[:-1]).sum())


def _compare(percent: int):
    """Rows come sorted by star, its centre first; only the centre's sets are kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        star, centres = None, []
        for batch in batches:
            found = ([], [])
            centre, salt, member, words = (batch.column(i) for i in range(4))
            for c, z, m, w in zip(
                centre.to_pylist(), salt.to_pylist(), member.to_pylist(), words, strict=True
            ):
                if star != (c, z):
                    star, centres = (c, z), []
                s = np.frombuffer(w.as_buffer(), np.uint64)
                if m is None:
                    centres.append(s.copy())
                    continue
                for other in centres:
                    both = overlap(s, other)
                    if 100 * both >= percent * (len(s) + len(other) - both):
                        found[0].append(c)
                        found[1].append(m)
                        break
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in found], ["centre", "member"]
            )

    return run


def confirm(sets: DataFrame, edges: DataFrame, percent: int) -> DataFrame:
    """The edges (centre, member) whose full sets (doc_id, words) are similar enough.

    An edge comes once for each row that ``sets`` has of its member.

    A star is split into salts of about MEMBERS_PER_TASK members, counted beforehand, and its
    centre's set goes to each of them.
    """
    sizes = edges.groupBy("centre").agg(F.ceil(F.count("*") / MEMBERS_PER_TASK).alias("salts"))
    salted = edges.join(sizes, "centre").withColumn(
        "salt", F.pmod(F.xxhash64("member"), F.col("salts")).cast("int")
    )
    takes = salted.select(
        F.col("member").alias("doc_id"), "centre", "salt", F.col("member").alias("as_member")
    ).unionByName(
        sizes.select(
            F.col("centre").alias("doc_id"),
            "centre",
            F.explode(F.sequence(F.lit(0), (F.col("salts") - 1).cast("int"))).alias("salt"),
            F.lit(None).cast("long").alias("as_member"),
        )
    )
    dealt = (
        takes.join(sets, "doc_id")
        .select("centre", "salt", "as_member", "words")
        .repartition("centre", "salt")
        .sortWithinPartitions("centre", "salt", F.col("as_member").asc_nulls_first())
    )
    return dealt.mapInArrow(_compare(percent), "centre long, member long")


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, component): each linked node with the smallest node it can reach.

    Alternating large and small stars; every round at least halves the distance to the root.
    The links are pairs (centre, member), read from files; they may repeat.
    """
    edges = links.select(F.col("centre").alias("a"), F.col("member").alias("b")).where("a <> b")
    while True:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = (
            both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        )
        down = large.where("a <> b").select(
            F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
        ).distinct()
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            down.join(least, "u")
            .select(F.col("v").alias("a"), F.col("m").alias("b"))
            .union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
            .where("a <> b")
            .distinct()
        )
        after = stored(spark, small, "stars")
        # done when each node points at one root and no root points further
        ends = F.explode(
            F.array(
                F.struct(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("root")),
                F.struct(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("root")),
            )
        )
        open_ = (
            after.select(ends.alias("end"))
            .groupBy("end.node")
            .agg(F.sum("end.out").alias("out"), F.max("end.root").alias("root"))
            .where("out > 1 OR out = 1 AND root = 1")
        )
        edges = after
        if open_.isEmpty():
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _fit(a: Column, b: Column, percent: int) -> Column:
    """Whether sets of these sizes can be similar enough."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _rare_entries(sets: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(bucket, node, n_shingles, shared): nodes by the rarest shingles they share.

    Only shingles that occur in several components of ``nodes`` (node, n_shingles, component) can
    be common to two of them. A link needs ``percent`` of a node's shingles, so of two linked nodes
    each has, among its (such shingles - needed + 1) rarest in one order for all, one that the other
    has there too. ``shared`` is what a node has from this one on: where it is the first that two
    nodes share, they share no more than that. Components only merge later, so this stays true.
    """
    named = nodes.select(F.col("node").alias("doc_id"), "component")
    rows = sets.join(named, "doc_id").select("doc_id", "words", "component")
    rows = rows.mapInArrow(_unpacked, "node long, component long, shingle long")
    across = (
        rows.groupBy("shingle")
        .agg(
            F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("df")
        )
        .where("low <> high")
        .select("shingle", "df")
    )
    own = Window.partitionBy("node")
    ranked = (
        rows.select("node", "shingle")
        .join(across, "shingle")
        .withColumn("shared", F.count("*").over(own))
        .withColumn("rank", F.row_number().over(own.orderBy("df", "shingle")))
    )
    needed = F.ceil(F.col("n_shingles") * percent / 100)
    return (
        ranked.join(nodes.select("node", "n_shingles"), "node")
        .where(F.col("rank") <= F.col("shared") - needed + 1)
        .select(
            F.col("shingle").alias("bucket"),
            "node",
            "n_shingles",
            (F.col("shared") - F.col("rank") + 1).alias("shared"),
        )
    )


def _possible(shared: Column, a: Column, b: Column, percent: int) -> Column:
    """Whether sets of sizes a and b with at most this many common shingles can be linked."""
    return shared * 100 >= (a + b - shared) * percent


def _open_members(
    spark: SparkSession, left: DataFrame, labels: DataFrame, percent: int
) -> DataFrame:
    """Members, with their component, of the buckets that hold more than one component.

    A member that can't be linked even to the smallest member of its bucket goes.
    """
    named = left.drop("component").join(labels, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    several = (
        named.groupBy("bucket")
        .agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.min("n_shingles").alias("smallest"),
        )
        .where("low <> high")
        .select("bucket", "smallest")
    )
    found = named.join(several, "bucket")
    if "shared" in left.columns:
        # the smallest it can be linked to is no smaller than what the two can share
        size = F.greatest("smallest", F.ceil(F.col("n_shingles") * percent / 100))
        found = found.where(_possible(F.col("shared"), F.col("n_shingles"), size, percent))
    return stored(spark, found.drop("smallest"), "open")


def _next_stars(
    spark: SparkSession, left: DataFrame, tried: DataFrame, centres: int, percent: int
) -> tuple[DataFrame, DataFrame]:
    """(pairs not tried before, members that weren't centres yet).

    The centres of a bucket are its smallest members; each is paired with the larger members of
    other components.
    """
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy("node"))
    stars = left.withColumn("rank", rank).where(F.col("rank") <= centres).drop("rank")
    stars = stored(spark, stars, "centres")
    c = stars.select(
        "bucket",
        F.col("node").alias("centre"),
        F.col("n_shingles").alias("n_centre"),
        F.col("component").alias("c_centre"),
        F.col("shared").alias("s_centre"),
    )
    common = F.least("shared", "s_centre")
    pairs = (
        left.join(c, "bucket")
        .where("node > centre AND component <> c_centre")
        .where(_possible(common, F.col("n_shingles"), F.col("n_centre"), percent))
        .select("centre", F.col("node").alias("member"))
        .distinct()
        .join(tried, ["centre", "member"], "left_anti")
    )
    pairs = stored(spark, pairs, "pairs")
    return pairs, left.join(stars.select("bucket", "node"), ["bucket", "node"], "left_anti")


def near_duplicates(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs`` (doc_id, text, ...).

    Words are runs of anything but ASCII white space, with A-Z lowered. Documents are linked if
    100 * common shingles >= percent * all shingles of the two; component_id is the smallest doc_id
    that links lead to, itself included, and kept says that it is the row's own. A text without
    words, an empty and a null text have no shingles and no links. Repeated rows stay as they
    came; rows that share a doc_id are one document to the links. A row without doc_id has no
    component, takes no part and is kept. An empty table gives an empty result. Columns other
    than doc_id and text aren't read.
    """
    spark = docs.sparkSession
    modest_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    kind = "doc_id long, n_shingles long, key1 long, key2 long, bands array<long>"
    sketches = stored(spark, docs.mapInArrow(_sketches(k), kind), "sketches")
    key = ["n_shingles", "key1", "key2"]
    real = sketches.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stored(
        spark, real.groupBy(*key).agg(F.min("doc_id").alias("node"), F.count("*").alias("size")), "classes"
    )
    # the bands of a class are those of any of its rows
    bands = real.groupBy(*key).agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"))
    entries = bands.select("node", "n_shingles", F.explode("bands").alias("bucket"))
    firsts = entries.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("centre"))
    left = stored(
        spark,
        entries.join(firsts.where("n > 1").drop("n"), "bucket").where("node <> centre"),
        "members",
    )
    release(spark)
    sizes = classes.select(F.col("node").alias("centre"), F.col("n_shingles").alias("n_centre"))
    tried = stored(
        spark,
        left.select("centre", F.col("node").alias("member"), "n_shingles")
        .distinct()
        .join(sizes, "centre")
        .where(_fit(F.col("n_shingles"), F.col("n_centre"), percent))
        .select("centre", "member")
        .distinct(),
        "tried",
    )
    nodes = left.select("node").union(left.select("centre")).distinct()
    sets = stored(
        spark,
        docs.join(nodes.withColumnRenamed("node", "doc_id"), "doc_id").mapInArrow(
            _packed_sets(k), "doc_id long, words binary"
        ),
        "sets",
    )
    release(spark)
    links = stored(spark, confirm(sets, tried, percent), "confirmed")
    labels = stored(spark, components(spark, links), "labels")
    left = _open_members(spark, left.drop("centre"), labels, percent)
    nodes = left.select("node", "n_shingles", "component").distinct()
    left, centres = stored(spark, _rare_entries(sets, nodes, percent), "rare"), 2
    while True:
        left = _open_members(spark, left, labels, percent)
        if left.isEmpty():
            break
        pairs, left = _next_stars(spark, left, tried, centres, percent)
        if not pairs.isEmpty():
            new = stored(spark, confirm(sets, pairs, percent), "confirmed")
            tried = tried.union(pairs)
            if not new.isEmpty():
                # what was reached before is a star by now
                known = labels.select(F.col("component").alias("centre"), F.col("node").alias("member"))
                labels = stored(spark, components(spark, known.union(new)), "labels")
            release(spark)
        centres *= 8
    named = (
        classes.join(labels, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
        .where("size > 1 OR component <> node")
        .select(*key, "component")
    )
    out = sketches.drop("bands").join(named, key, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
