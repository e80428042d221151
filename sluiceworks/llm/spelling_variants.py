"""Words and their spelling variants, found over an index of grams of variable length.

1. A dictionary of the grams that are frequent in the words, of 2 characters up. The index leaves lists
   of such grams out: a gram that is in the dictionary is made longer instead.
2. A word, between two marks, is decomposed at each of its places: the gram there grows until it is
   not in the dictionary or has LONGEST characters. Where a gram ends depends on its own characters
   only, so an edit affects just the grams that span it.
3. The most grams that any one edit affects bounds, for each word, how many of its grams a word one
   edit away may lack. In one order of all grams, rarest first, the two share one of the first
   (bound + 1) of each. Only these lists are merged; places differ by what the edit inserts.
4. Candidates are verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceworks.llm.tables import release, stored

SHORTEST = 2
LONGEST = 4
MAX_GRAMS = 1 << 17  # grams that are broadcast at most
MIN_CHARS = 6
MIN_COUNT = 5
RATIO = 5  # a form has so many times the occurrences of its variant
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIRST, LAST = "\x02", "\x03"  # marks before and after a word


def letter_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, run) for each longest stretch of letters in the texts of ``docs``, A-Z lowered.

    Letters are A-Z, a-z and U+00C0 to U+00FF. A null or empty text has none.
    """
    runs = F.regexp_extract_all(
        F.translate(F.col("text").cast("string"), UPPER, LOWER), F.lit("([a-zÀ-ÿ]+)")
    )
    return docs.select("doc_id", F.explode(runs).alias("run"))


def word_counts(words: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words (word) with at least so many code points and occurrences."""
    long = words.where(F.char_length("word") >= min_chars)
    return long.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def _marked() -> Column:
    return F.concat(F.lit(FIRST), F.col("word"), F.lit(LAST))


def frequent_grams(words: DataFrame, max_grams: int = MAX_GRAMS) -> dict[str, int]:
    """The grams, up to LONGEST characters, with more than one in ``max_grams`` of all occurrences."""

    def grams(n: int) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.char_length("word") + 3 - n, F.lit(1)))
        return F.transform(places, lambda i: F.substr(F.col("s"), i, F.lit(n)))

    every = F.flatten(F.array(*[grams(n) for n in range(SHORTEST, LONGEST + 1)]))
    rows = words.select("word", _marked().alias("s")).select(F.explode(every).alias("gram"))
    counts = stored(words.sparkSession, rows.groupBy("gram").agg(F.count("*").alias("n")), "grams")
    total = counts.agg(F.sum("n")).first()[0] or 0
    found = counts.where(F.col("n") > F.lit(total // max_grams)).collect()  # fewer than max_grams
    return {r["gram"]: r["n"] for r in found}


def decompose(word: str, frequent: dict[str, int]) -> tuple[list[tuple[str, int]], int]:
    """(grams with their places in the marked word, the most of them that one edit affects)."""
    s = FIRST + word + LAST
    grams, affected = [], [0] * (len(s) + 1)
    for i in range(len(s) - 1):
        end = i + SHORTEST
        while end - i < LONGEST and end < len(s) and s[i:end] in frequent:
            end += 1
        grams.append((s[i:end], i))
        affected[i] += 1
        affected[end] -= 1
    most = now = 0
    for e in range(len(s) - 1):  # the marks stay, so no edit is at the last one
        now += affected[e]
        if e and now > most:
            most = now
    return grams, most


def prefix(word: str, frequent: dict[str, int]) -> list[tuple[str, int]]:
    """The grams of a word of which a word one edit away shares one."""
    grams, bound = decompose(word, frequent)
    grams.sort(key=lambda g: (frequent.get(g[0], 0), g))
    return grams[: bound + 1]


def _prefixes(frequent: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            taken, grams, places = [], [], []
            for k, word in enumerate(batch.column(0).to_pylist()):
                for gram, place in prefix(word, frequent):
                    taken.append(k)
                    grams.append(gram)
                    places.append(place)
            rows = batch.take(pa.array(taken, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(grams, pa.string()), pa.array(places, pa.int32())],
                ["word", "n", "gram", "place"],
            )

    return run


def near_pairs(words: DataFrame, max_grams: int = MAX_GRAMS) -> DataFrame:
    """(a, n_a, b, n_b), once for each two words (word, n) that one edit parts.

    ``a`` is the shorter or, at the same length, the smaller one. Words are distinct and have at
    least LONGEST code points.
    """
    grams = words.mapInArrow(
        _prefixes(frequent_grams(words, max_grams)), "word string, n long, gram string, place int"
    )
    size = F.char_length("word")

    def keyed(place: Column, length: Column) -> DataFrame:
        key = F.xxhash64("gram", place, length)
        return grams.select(key.alias("key"), "word", "n")

    place = F.col("place")
    lists = keyed(place, size)
    # a replaced character keeps length and places; an inserted one may be before the gram or after it
    at = F.explode(
        F.array(
            F.xxhash64("gram", place, size),
            F.xxhash64("gram", place, size + 1),
            F.xxhash64("gram", place + 1, size + 1),
        )
    )
    probes = grams.select(at.alias("key"), F.col("word").alias("a"), F.col("n").alias("n_a"))
    lists = lists.withColumnsRenamed({"word": "b", "n": "n_b"})
    ordered = (F.char_length("a") < F.char_length("b")) | (F.col("a") < F.col("b"))
    met = probes.join(lists, "key").where(ordered & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "n_a", "b", "n_b").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms (word, form) followed to their end. Each has more occurrences than the last."""
    spark = forms.sparkSession
    roots = forms.withColumnRenamed("form", "root")
    while True:
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = roots.join(on, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        step = stored(spark, step, "roots")
        roots = step.drop("moved")
        if step.where("moved").isEmpty():
            return roots


def group_variants(words: DataFrame, ratio: int = RATIO, max_grams: int = MAX_GRAMS) -> DataFrame:
    """word, form, root, n, n_near, form_n for each of ``words`` (word, n, ...).

    Two words are near if one inserted, deleted or replaced code point parts them; ``n_near`` counts
    them. The form of a word is the near word with the largest n, of these the smallest, if it has at
    least ``ratio`` (over 1) times the word's n; otherwise form and form_n are null. ``root`` is the end
    of the forms of forms, the word itself if it has none. Rows without word are left out, rows
    with the same word are one, with the sum of their n; a null n is 0. Words of fewer than LONGEST code
    points, the empty one too, are near nothing. An empty table gives an empty result. Other columns
    aren't read.
    """
    if ratio < 2:
        raise ValueError("forms must be more frequent than their variants")
    spark = words.sparkSession
    named = words.select(F.col("word").cast("string"), F.col("n").cast("long")).where("word IS NOT NULL")
    words = stored(spark, named.groupBy("word").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")), "words")
    release(spark)
    pairs = stored(
        spark, near_pairs(words.where(F.char_length("word") >= LONGEST), max_grams), "near"
    )
    release(spark)
    both = pairs.select(F.col("a").alias("word"), F.struct((-F.col("n_b")).alias("m"), F.col("b").alias("w")).alias("near"))
    both = both.unionAll(
        pairs.select(F.col("b").alias("word"), F.struct((-F.col("n_a")).alias("m"), F.col("a").alias("w")).alias("near"))
    )
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min("near").alias("best"))
    is_form = -F.col("best.m") >= ratio * F.col("n")
    named = stored(
        spark,
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(is_form, F.col("best.w")).alias("form"),
            F.when(is_form, -F.col("best.m")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(named.where("form IS NOT NULL").select("word", "form"))
    return named.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
