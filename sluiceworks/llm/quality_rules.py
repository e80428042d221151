"""Quality rules whose cutoffs follow from the corpus, by language and source.

Each text is measured with column functions only. The measures go into quantile sketches: counts of
log-linear buckets (64 exact ones, then 32 for each doubling, so a value is known to 1/32), which are
sums and so merge in any order, within tasks before the shuffle and between tasks after it. From a
group's sketch come its quartiles, from these its fences, and the fences are joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceworks.llm.tables import stored

SPACE = r"[\x20\x09-\x0D]+"
RUN = 5  # words of a repeated window
LEAST_WORDS = 10
MOST_REPEATED = 20  # percent of words in repeated windows
WIDTH = 6  # spreads between a quartile and its fence
MOST_GROUPS = 50_000  # groups whose fences go to every task, about 10 MB; more are joined by shuffles
# per measure: the least spread between the quartiles, and whether low values fail too
MEASURES = {"length": (100, True), "symbols": (10, False), "repeats": (25, False)}
WIDEN = 6000  # a text of n words may exceed a fence on word length by WIDEN / sqrt(n)


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the five counts of each text.

    ``n_repeat_words`` counts words in windows of RUN words that occur twice or more. Only texts in
    which two windows have equal hashes are looked at in full: their windows are sorted, those with
    an equal neighbour taken by position, and the words under them counted once each.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(F.col("doc_id").cast("long"), "lang", "source", text.alias("text"))
    words = base.withColumn("words", F.expr(f"filter(split(text, r'{SPACE}'), w -> w <> '')"))
    lines = r"filter(split(text, r'\n'), l -> l rlike r'[^\x20\x09-\x0D]')"
    look = ", ".join(f"words[i + {j}]" for j in range(RUN))
    starts = f"sequence(0, size(words) - {RUN})"
    counted = words.select(
        "doc_id",
        "lang",
        "source",
        "words",
        F.expr("size(words)").cast("long").alias("n_words"),
        F.length(F.translate("text", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.expr(f"transform(array({lines}), l -> size(l) - size(array_distinct(l)))[0]")
        .cast("long")
        .alias("n_dup_lines"),
        F.expr(
            f"CASE WHEN size(words) >= {RUN} THEN "
            f"transform(array(transform({starts}, i -> xxhash64({look}))), "
            "h -> size(array_distinct(h)) < size(h))[0] ELSE false END"
        ).alias("repeats"),
    )
    repeated = f"""
        CASE WHEN repeats THEN aggregate(
            transform(
                array(sort_array(transform({starts},
                    i -> struct(array_join(slice(words, i + 1, {RUN}), ' ') AS run, i AS at)))),
                s -> sort_array(filter(
                    transform(s, (x, j) -> IF(
                        (j > 0 AND s[greatest(j - 1, 0)].run = x.run)
                        OR (j + 1 < size(s) AND s[least(j + 1, size(s) - 1)].run = x.run), x.at, -1)),
                    p -> p >= 0)))[0],
            struct(0L AS n, cast(-{RUN} AS int) AS last),
            (a, p) -> struct(a.n + least({RUN}, p - a.last) AS n, p AS last),
            a -> a.n) ELSE 0L END
    """
    return counted.select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.expr(repeated).alias("n_repeat_words"),
    )


def bucket(v: Column) -> Column:
    """Number of the bucket of a whole number from 0 on."""
    shift = F.greatest(F.length(F.bin(v)) - 6, F.lit(0))
    return (shift * 32).cast("long") + F.floor(v / F.pow(F.lit(2.0), shift)).cast("long")


def bucket_floor(b: Column) -> Column:
    """Smallest value of a bucket."""
    shift = F.greatest(F.floor(b / 32) - 1, F.lit(0))
    return ((b - shift * 32) * F.pow(F.lit(2.0), shift)).cast("long")


def fences(rows: DataFrame) -> DataFrame:
    """(key, fences) for each group: a struct with low and high of each measure.

    ``rows`` has key and a column for each of MEASURES.
    """
    each = F.explode(
        F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in MEASURES])
    )
    sketch = (
        rows.select("key", each.alias("m"))
        .groupBy("key", "m.measure", bucket(F.col("m.value")).alias("bucket"))
        .agg(F.count("*").alias("n"))
    )
    # a sketch has some hundred buckets at most, whatever the number of texts
    merged = sketch.groupBy("key", "measure").agg(
        F.sum("n").alias("n"), F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("buckets")
    )
    quartiles = merged.select("key", "measure", *[_quantile(q).alias(f"q{q}") for q in (1, 3)])
    spread = F.greatest(
        F.col("q3") - F.col("q1"),
        F.element_at(
            F.create_map(*[F.lit(x) for m, (s, _) in MEASURES.items() for x in (m, s)]), F.col("measure")
        ),
    )
    each = quartiles.select(
        "key",
        "measure",
        F.struct(
            (F.col("q1") - WIDTH * spread).alias("low"), (F.col("q3") + WIDTH * spread).alias("high")
        ).alias("fence"),
    )
    return each.groupBy("key").agg(
        *[F.max(F.when(F.col("measure") == m, F.col("fence"))).alias(m + "_fence") for m in MEASURES]
    )


def _quantile(quarters: int) -> Column:
    """Floor of the first bucket up to which that many quarters of the values lie."""
    found = F.expr(
        f"""aggregate(buckets, struct(0L AS seen, -1L AS at),
            (a, b) -> struct(a.seen + b.n AS seen,
                             IF(a.at < 0 AND 4 * (a.seen + b.n) >= {quarters} * n, b.bucket, a.at) AS at),
            a -> a.at)"""
    )
    return bucket_floor(found)


def judge(docs: DataFrame) -> DataFrame:
    """The five counts of each text of ``docs`` (doc_id, text, lang, source, ...), base_failed, kept.

    A text fails the base if it has under LEAST_WORDS words or over MOST_REPEATED percent of them in
    repeated windows. The others of a language and source make up a group; nulls count as a value.
    A text is kept unless it fails the base or lies beyond a fence of its group, on word length by
    more than a text of its size does by chance. A null text is an empty one and fails. Rows
    without doc_id and repeated rows are judged like any other. An empty table gives an empty
    result. Columns other than these four aren't read.
    """
    rows = stored(docs.sparkSession, measures(docs), "measures")
    rows = rows.withColumn("key", F.struct("lang", "source")).withColumn(
        "base_failed",
        (F.col("n_words") < LEAST_WORDS)
        | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")),
    )
    for name, value in {
        "length": "1000 * word_chars div greatest(n_words, 1)",
        "symbols": "1000 * n_symbols div greatest(word_chars, 1)",
        "repeats": "1000 * n_repeat_words div greatest(n_words, 1)",
    }.items():
        rows = rows.withColumn(name, F.expr(value))
    limits = fences(rows.where("NOT base_failed")).withColumnRenamed("key", "group")
    limits = stored(docs.sparkSession, limits, "fences")
    if limits.count() <= MOST_GROUPS:  # then a large group's texts stay where they are
        limits = F.broadcast(limits)
    joined = rows.join(limits, rows["key"] == limits["group"], "left")
    beyond = F.lit(False)
    for m, (_, both) in MEASURES.items():
        value, fence = F.col(m), F.col(m + "_fence")
        over = F.greatest(value - fence["high"], F.lit(0))
        if both:
            over = F.greatest(over, fence["low"] - value)
            beyond = beyond | (over * over * F.col("n_words") > WIDEN * WIDEN)
        else:
            beyond = beyond | (over > 0)
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~F.coalesce(beyond, F.lit(False))).alias("kept"),
    )
