"""Removal of passages that an earlier document has, by sharded Aho-Corasick automata.

A window is ``n`` consecutive words. Of the GRAM-word sequences inside a window the one with the
smallest hash is its anchor, so equal windows have equal anchors, and neighbouring windows mostly
share one.

1. Anchors that only one document has are set aside: no window at them recurs.
2. The stretches of text around the other anchors are cut out. Equal stretches become one row with
   the smallest and largest doc_id, so a passage that a third of all documents share is one row a
   task before it is shuffled.
3. Stretches meet by anchor. A run of anchors is a shard. Windows in several documents are confirmed;
   those that follow each other and have the same first document make up a passage. The shard's
   passages are compiled into one automaton over word numbers, all stretches of the shard stream
   through it, and every occurrence gets the passage's first document. An anchor with
   more than MOST_STRETCHES different stretches is left out of this and its windows become
   stretches with anchors of their own, so no shard grows with the number of documents.
4. Occurrences go back to the documents, which drop the words that windows of earlier documents cover.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from sluiceworks.llm.arrow_words import Chunk, WordReader, sliding_min, text_bytes
from sluiceworks.llm.tables import modest_batches, release, stored, unused

WINDOW = 13
GRAM = 5
MOST_WINDOWS = 64  # windows of one stretch; a longer run is cut into several
MOST_STRETCHES = 4096
SHARD_STRETCHES = 500  # the library scans the branches of a node one by one
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def window_anchors(chunk: Chunk, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchor of the window at each word, and whether there is such a window."""
    grams, _ = chunk.grams(GRAM)
    size = np.diff(chunk.bounds)
    left = np.repeat(chunk.bounds[1:], size) - np.arange(len(grams))
    return sliding_min(grams, n - GRAM + 1).view(np.int64), left >= n


def _anchors(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = WordReader()
        for batch in batches:
            ids, prints = (batch.column(i).to_numpy() for i in (0, 2))
            for chunk in reader.chunks(batch.column(1)):
                anchors, whole = window_anchors(chunk, n)
                row = np.repeat(np.arange(len(chunk)), np.diff(chunk.bounds))[whole]
                anchors = anchors[whole]
                order = np.lexsort((anchors, row))
                row, anchors = row[order], anchors[order]
                new = np.ones(len(row), dtype=bool)
                new[1:] = (row[1:] != row[:-1]) | (anchors[1:] != anchors[:-1])
                row = row[new] + chunk.first
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchors[new]), pa.array(ids[row]), pa.array(prints[row])],
                    ["anchor", "doc_id", "print"],
                )

    return run


def stretches(chunk: Chunk, wanted: list[np.ndarray], n: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(document, anchor, first word, words joined by one space) around the wanted anchors."""
    anchors, whole = window_anchors(chunk, n)
    for d, (a, b) in enumerate(zip(chunk.bounds[:-1].tolist(), chunk.bounds[1:].tolist(), strict=True)):
        if b - a < n or not len(wanted[d]):
            continue
        own = anchors[a : b - n + 1]
        hit = np.isin(own, wanted[d])
        change = np.ones(len(own), dtype=bool)
        change[1:] = own[1:] != own[:-1]
        begin = np.flatnonzero(change)
        end = np.append(begin[1:], len(own))
        for i, j in zip(begin[hit[begin]].tolist(), end[hit[begin]].tolist(), strict=True):
            for x in range(i, j, MOST_WINDOWS):
                last = min(x + MOST_WINDOWS, j) + n - 2  # last word of the last window
                text = chunk.data[chunk.starts[a + x] : chunk.ends[a + last]].tobytes()
                yield d, int(own[i]), x, b" ".join(text.split())


def _stretches(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = WordReader()
        for batch in batches:
            ids, prints, hits = batch.column(0), batch.column(2), batch.column(3)
            for chunk in reader.chunks(batch.column(1)):
                wanted = [hits[chunk.first + d].values.to_numpy() for d in range(len(chunk))]
                found = list(stretches(chunk, wanted, n))
                row = pa.array([chunk.first + f[0] for f in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(row),
                        prints.take(row),
                        pa.array([f[1] for f in found], pa.int64()),
                        pa.array([f[2] for f in found], pa.int64()),
                        pa.array([f[3] for f in found], pa.binary()),
                    ],
                    ["doc_id", "print", "anchor", "pos", "words"],
                )

    return run


def _single_windows(n: int):
    """Stretches cut into their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words = row["words"].split(b" ")
                k = len(words) - n + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["doc_id"]] * k, pa.int64()),
                        pa.array([row["print"]] * k, pa.int64()),
                        pa.array([row["pos"] + i for i in range(k)], pa.int64()),
                        pa.array([b" ".join(words[i : i + n]) for i in range(k)], pa.binary()),
                    ],
                    ["doc_id", "print", "pos", "words"],
                )

    return run


def occurrences(shard: list[tuple[bytes, int, int]], n: int) -> list[list[int | None]]:
    """For each stretch (words, smallest and largest doc_id) the first document of each window.

    None stands for a window that only one document has.
    """
    numbers: dict[bytes, int] = {}
    spelled = [
        tuple([numbers.setdefault(w, len(numbers)) for w in words.split(b" ")]) for words, _, _ in shard
    ]
    seen: dict[tuple[int, ...], list[int]] = {}
    for key, (_, low, high) in zip(spelled, shard, strict=True):
        for i in range(len(key) - n + 1):
            at = seen.setdefault(key[i : i + n], [low, high])
            at[0] = min(at[0], low)
            at[1] = max(at[1], high)
    phrases = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    passages: dict[tuple[int, ...], int] = {}
    runs: list[tuple[int, int]] = []  # windows and first document of each passage
    for key in spelled:
        ends = [seen[key[i : i + n]] for i in range(len(key) - n + 1)]
        i = 0
        while i < len(ends):
            low, high = ends[i]
            j = i + 1
            while j < len(ends) and ends[j][0] == low and (ends[j][1] > low) == (high > low):
                j += 1
            passage = key[i : j + n - 1]
            if low < high and passage not in passages:
                passages[passage] = len(runs)
                phrases.add_word(passage, len(runs))
                runs.append((j - i, low))
            i = j
    if runs:
        phrases.make_automaton()
    out: list[list[int | None]] = []
    for key in spelled:
        found: list[int | None] = [None] * (len(key) - n + 1)
        if runs:
            for end, phrase in phrases.iter(key):
                windows, low = runs[phrase]
                last = end - n + 2
                found[last - windows : last] = [low] * windows
        out.append(found)
    return out


def _located(n: int):
    """Rows come sorted by anchor; whole anchors make up a shard."""

    def answer(shard: list[tuple], n: int) -> pa.RecordBatch:
        found = occurrences([r[2:] for r in shard], n)
        keep = [
            (r[0], r[1], f)
            for r, f in zip(shard, found, strict=True)
            if any(x is not None and x < r[4] for x in f)
        ]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in keep], pa.int64()),
                pa.array([k[1] for k in keep], pa.int64()),
                pa.array([k[2] for k in keep], pa.list_(pa.int64())),
            ],
            ["anchor", "stretch", "firsts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if len(shard) >= SHARD_STRETCHES and shard[-1][0] != row[0]:
                    yield answer(shard, n)
                    shard = []
                shard.append(row)
        if shard:
            yield answer(shard, n)

    return run


def without(text: bytes, starts: list[int], n: int) -> tuple[bytes, int]:
    """The text without the words of the windows at these words, and how many words went."""
    spans = [m.span() for m in WORD.finditer(text)]
    gone = bytearray(len(spans))
    for s in starts:
        gone[s : s + n] = b"\1" * n
    kept, at, i = [], 0, 0
    while i < len(spans):
        if not gone[i]:
            i += 1
            continue
        kept.append(text[at : spans[i][0]])
        while i < len(spans) and gone[i]:
            i += 1
        at = spans[i][0] if i < len(spans) else len(text)
    kept.append(text[at:])
    return b"".join(kept), sum(gone)


def _removed(n: int, text_at: int, names: tuple[str, str]):
    """The last column has the covers; it gives way to the numbers of words and of removed words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(text_at)
            offsets, data = text_bytes(column)
            texts, words, removed = [], [], []
            for i, starts in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                text, gone = data[offsets[i] : offsets[i + 1]].tobytes(), 0
                words.append(len(text.split()))
                if starts:
                    text, gone = without(text, starts, n)
                texts.append(text if column[i].is_valid else None)
                removed.append(gone)
            columns = batch.columns[:-1]
            columns[text_at] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(words, pa.int64()), pa.array(removed, pa.int64())],
                [*batch.schema.names[:-1], *names],
            )

    return run


def remove_repeats(docs: DataFrame, n: int = WINDOW) -> DataFrame:
    """The columns of ``docs`` (doc_id, text, ...), then n_words and n_removed.

    Words are runs of anything but ASCII white space. A word goes if a window of ``n`` words that
    covers it also starts in a document with a smaller doc_id; windows are judged on the texts as
    they came. ``text`` is what is left, with the white space before each kept run. A null text
    stays null, with 0 words. A text of fewer than ``n`` words, and a row without doc_id, stays
    whole and removes nothing. Repeated rows stay as they came: rows of one doc_id never remove
    words from each other. An empty table gives an empty result. Other columns are handed on; if
    one has the name of a new column, the new one's gets an underscore.
    """
    if n < GRAM:
        raise ValueError(f"a window has at least {GRAM} words")
    spark = docs.sparkSession
    modest_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    real = texts.where("doc_id IS NOT NULL AND text IS NOT NULL").withColumn(
        "print", F.xxhash64("text")
    )
    anchors = real.mapInArrow(_anchors(n), "anchor long, doc_id long, print long")
    counted = anchors.groupBy("anchor").agg(F.count("*").alias("n"))
    recurring = stored(spark, counted.where("n > 1").select("anchor"), "anchors")
    release(spark)
    hits = anchors.join(recurring, "anchor").groupBy("doc_id", "print").agg(
        F.collect_list("anchor").alias("hits")
    )
    pieces = real.join(hits, ["doc_id", "print"]).select("doc_id", "text", "print", "hits").mapInArrow(
        _stretches(n), "doc_id long, print long, anchor long, pos long, words binary"
    )
    pieces = stored(spark, pieces.withColumn("stretch", F.xxhash64("words")), "stretches")
    release(spark)

    grouped = ["anchor", "stretch"]
    ends = [F.min("doc_id").alias("low"), F.max("doc_id").alias("high")]
    rows = stored(
        spark, pieces.groupBy(*grouped).agg(F.first("words").alias("words"), *ends), "distinct"
    )
    counted = rows.groupBy("anchor").agg(F.count("*").alias("n"))
    crowded = stored(
        spark, counted.where(F.col("n") > MOST_STRETCHES).select("anchor"), "crowded"
    )
    if not crowded.isEmpty():
        single = pieces.join(crowded, "anchor").select("doc_id", "print", "pos", "words").mapInArrow(
            _single_windows(n), "doc_id long, print long, pos long, words binary"
        )
        single = single.withColumn("stretch", F.xxhash64("words")).withColumn(
            "anchor", F.xxhash64(F.lit("window"), "words")
        )
        pieces = pieces.join(crowded, "anchor", "left_anti").unionByName(single)
        rows = rows.join(crowded, "anchor", "left_anti").unionByName(
            single.groupBy(*grouped).agg(F.first("words").alias("words"), *ends)
        )
    located = (
        rows.select("anchor", "stretch", "words", "low", "high")
        .repartition("anchor")
        .sortWithinPartitions("anchor", "low")
        .mapInArrow(_located(n), "anchor long, stretch long, firsts array<long>")
    )
    covers = (
        pieces.drop("words")
        .join(located, grouped)
        .select(
            "doc_id",
            "print",
            F.expr(
                "filter(transform(firsts, (x, i) -> IF(x < doc_id, pos + i, null)), x -> x IS NOT NULL)"
            ).alias("starts"),
        )
        .where("size(starts) > 0")
        .groupBy("doc_id", "print")
        .agg(F.flatten(F.collect_list("starts")).alias("starts"))
    )
    covers = stored(spark, covers, "covers")
    release(spark)
    of, starts = unused(docs, "_of"), unused(docs, "_starts")
    covers = covers.select(F.struct("doc_id", "print").alias(of), F.col("starts").alias(starts))
    own = F.struct(docs["doc_id"].cast("long"), F.xxhash64(docs["text"]))
    both = docs.join(covers, own == covers[of], "left").select(
        *[docs[c] for c in docs.columns], covers[starts]
    )
    new = unused(docs, "n_words"), unused(docs, "n_removed")
    kind = StructType([*docs.schema.fields, *[StructField(c, LongType()) for c in new]])
    return both.mapInArrow(_removed(n, docs.columns.index("text"), new), kind)
