"""Personal data: patterns for the plain forms, and contexts learned from them for the others.

1. One pass finds every plain form (the seeds) and every weak form: something that looks like an
   identifier but fails a rule, as a phone number without its "+". Each comes with its patterns: the
   one to three tokens (words, numbers, signs) before it, as far as there is a word in them, alone and
   with the token after it. A secret, a long run of letters and digits, has no plain form: those that
   a name like "token" is set to are its seeds.
2. A pattern's confidence for a kind is the share of seeds and accepted forms among the distinct
   forms of the kind that follow it. A weak form's score follows from the confidence of its patterns,
   of those that end with the same word the best. Forms whose score reaches ACCEPT are accepted and
   count in the next round, so patterns without any seed are found from them: if numbers
   after "tel:" are accepted and stand after "mobil:" too, so are the others after "mobil:". Scores only
   grow, and the rounds end when no form is new.
3. A pattern counts only if its last word belongs to the kind: CONFIDENT of the word's uses, or LIFT
   times as many as of any word, stand before such a form. So "the" is none, however many numbers
   follow it, and "phone" is one, however often it is used without a number.
4. An accepted form is personal data wherever it stands.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceworks.llm.tables import modest_batches, stored

BASE = ("email", "ip", "card", "phone")  # kinds with plain forms
KINDS = (*BASE, "secret")
ACCEPT = 0.5  # score of a weak instance
CONFIDENT = 0.3  # confidence from which a pattern counts
SEEDS = 3  # distinct seeds and accepted forms that a pattern needs
LIFT = 10.0  # times that forms follow a word more often than words on average

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# up to four parts: where fewer stand together, none of them can begin four
QUAD = re.compile(r"[0-9]+(?:\.[0-9]+(?:\.[0-9]+(?:\.[0-9]+)?)?)?")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WEAK = {
    "email": re.compile(
        r"[A-Za-z0-9._%+-]{1,64}(?:@|\(at\)|\[at\])[A-Za-z0-9-]{1,64}"
        r"(?:(?:\.|\(dot\)|\[dot\])[A-Za-z0-9-]{1,64}){0,8}"
    ),
    "ip": re.compile(r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![0-9A-Za-z:])"),
    "card": re.compile(r"(?<![0-9A-Za-z])[0-9](?:[\x20-]?[0-9]){11,18}(?![0-9A-Za-z])"),
    "phone": re.compile(r"(?<![0-9A-Za-z+])\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,14}(?![0-9A-Za-z])"),
    "secret": re.compile(
        r"(?<![A-Za-z0-9_/+-])(?=[A-Za-z_/+-]*[0-9])(?=[0-9_/+-]*[A-Za-z])[A-Za-z0-9_/+-]{16,}"
    ),
}
# names of secrets, with the sign that sets them
SECRET = re.compile(r"(?:token|secret|password|passwd|pwd|key) (?:=|:)(?: [\"'])?")
MARKS = re.compile(r"[0-9@]")
ALPHA = re.compile(r"[^\W\d_]+")
TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]|_+")
PATTERN_TOKENS = 3
MOST_COUNTED = 200_000  # words that a task counts before it hands them on

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the address pattern in one pass, whatever the length of the runs."""
    end, at = 0, text.find("@")
    while at >= 0:
        begin = end + len(text[end:at].rstrip(LOCAL))
        rest = DOMAIN.match(text, at + 1) if begin < at else None
        if rest:
            yield begin, rest.end()
            end = rest.end()
        else:
            end = at + 1  # no later match can begin before this sign
        at = text.find("@", end)


def plain_spans(text: str) -> list[Span]:
    """Seeds, by start and kind."""
    if not MARKS.search(text):
        return []
    found: list[Span] = [(a, 0, b) for a, b in _emails(text)]
    for m in QUAD.finditer(text):
        parts = m[0].split(".")
        if len(parts) == 4 and all(int(p[-4:]) <= 255 and not p[:-4].strip("0") for p in parts):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def weak_spans(text: str, plain: list[Span]) -> list[Span]:
    """Weak forms that touch no seed; ``plain`` is sorted."""
    if not MARKS.search(text) and "(at)" not in text and "[at]" not in text:
        return []
    begins = [a for a, _, _ in plain]
    ends = list(accumulate((b for _, _, b in plain), max))  # the furthest end up to each
    out = []
    for kind, name in enumerate(KINDS):
        if kind == 0 and not any(x in text for x in ("@", "(at)", "[at]")):
            continue
        for m in WEAK[name].finditer(text):
            before = bisect_left(begins, m.end())
            if not before or ends[before - 1] <= m.start():
                out.append((m.start(), kind, m.end()))
    return out


class Contexts:
    """The tokens of a text, and what stands around places in it."""

    def __init__(self, text: str):
        self.text = text
        self.tokens = list(TOKEN.finditer(text))
        self.begins = [m.start() for m in self.tokens]
        self.lines = [m.start() for m in re.finditer("\n", text)]

    def at(self, start: int, end: int) -> tuple[str | None, list[str]]:
        """The last word before a form on its line and the form's patterns, lower case.

        Patterns are the last one to PATTERN_TOKENS tokens, from the one on that holds the word, each
        without and with the next token on the line; without a word in them there are none. A number
        in them is written as 0.
        """
        line = bisect_left(self.lines, start)
        line_begin = self.lines[line - 1] + 1 if line else 0
        line_end = bisect_left(self.lines, end)
        line_end = self.lines[line_end] if line_end < len(self.lines) else len(self.text)
        last = bisect_left(self.begins, start)
        tokens = []
        for m in self.tokens[max(0, last - PATTERN_TOKENS) : last]:
            if m.start() >= line_begin:
                tokens.append(self._written(m[0] if m.end() <= start else m[0][: start - m.start()]))
        for at in range(len(tokens) - 1, -1, -1):
            if ALPHA.match(tokens[at]):
                break
        else:
            return None, []
        patterns = [" ".join(tokens[i:]) for i in range(at, -1, -1)]
        after = bisect_left(self.begins, end)
        if after < len(self.tokens) and self.tokens[after].end() <= line_end:
            following = self._written(self.tokens[after][0])
            patterns += [f"{p} _ {following}" for p in patterns]
        return tokens[at], patterns

    @staticmethod
    def _written(token: str) -> str:
        return "0" if token[0].isdigit() else token.lower()


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


SPAN = "struct<start:long,kind:int,end:long>"
SCAN = (
    "doc_id long, print long, counts array<long>, base string, mentions array<struct<kind:int,"
    "start:long,end:long,seed:boolean,context:string,patterns:array<string>,instance:string>>"
)


def mentions_of(text: str, plain: list[Span]) -> Iterator[tuple]:
    """(kind, start, end, seed, context, patterns, instance) of each form in a text."""
    weak = weak_spans(text, plain)
    if not plain and not weak:
        return
    around = Contexts(text)
    for known, spans in ((True, plain), (False, weak)):
        for a, k, b in spans:
            word, patterns = around.at(a, b)
            named = k == len(BASE) and any(SECRET.fullmatch(p) for p in patterns)
            yield k, a, b, known or named, word, patterns, text[a:b]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("kind", "start", "end", "seed", "context", "patterns", "instance")
    text, list_ = pa.string(), pa.list_(pa.string())
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.bool_(), text, list_, text)
    for batch in batches:
        counts, base, sizes = [], [], [0]
        columns: list[list] = [[] for _ in names]
        for value in batch.column(1):
            own = value.as_py() or ""
            plain = plain_spans(own)
            n = Counter(k for _, k, _ in plain)
            counts.append([n[k] for k in range(len(BASE))])
            base.append(written(plain))
            for mention in mentions_of(own, plain):
                for column, x in zip(columns, mention, strict=True):
                    column.append(x)
            sizes.append(len(columns[0]))
        parts = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        mentions = pa.StructArray.from_arrays(parts, names)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(2),
                pa.array(counts, pa.list_(pa.int64())),
                pa.array(base, pa.string()),
                pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), mentions),
            ],
            ["doc_id", "print", "counts", "base", "mentions"],
        )


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each word occurs, and null for all of them, summed within a task."""
    seen: Counter[str] = Counter()

    def answer() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([*seen, None], pa.string()),
                pa.array([*seen.values(), sum(seen.values())], pa.int64()),
            ],
            ["context", "n"],
        )

    for batch in batches:
        for value in batch.column(0):
            seen.update(ALPHA.findall((value.as_py() or "").lower()))
            if len(seen) > MOST_COUNTED:
                yield answer()
                seen.clear()
    yield answer()


def accepted(spark: SparkSession, docs: DataFrame, mentions: DataFrame) -> DataFrame:
    """(kind, instance) of the weak forms that their contexts make personal data.

    ``mentions`` has kind, seed, context, patterns and instance; ``docs`` has the texts.
    """
    words = mentions.where("context IS NOT NULL")
    edges = words.select("kind", "seed", "context", F.explode("patterns").alias("pattern"), "instance")
    edges = edges.groupBy("kind", "context", "pattern", "instance").agg(F.max("seed").alias("seed"))
    edges = stored(spark, edges, "edges")
    # others can never have SEEDS accepted forms, or have nothing to find
    patterns = (
        edges.groupBy("kind", "context", "pattern")
        .agg(F.count("*").alias("forms"), F.count_if(~F.col("seed")).alias("weak"))
        .where((F.col("forms") >= SEEDS) & (F.col("weak") > 0))
        .drop("weak")
    )
    patterns = stored(spark, patterns, "patterns")
    uses = words.groupBy("kind", "context").agg(F.count("*").alias("before"))
    uses = stored(spark, uses, "uses")
    totals = docs.select("text").mapInArrow(_counted, "word string, n long")
    totals = totals.groupBy("word").agg(F.sum("n").alias("n"))
    asked = patterns.select("context").distinct().unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS context"))
    totals = totals.join(asked, F.col("word").eqNullSafe(F.col("context"))).select("context", "n")
    totals = stored(spark, totals, "totals")
    every = totals.where("context IS NULL").first()
    kinds = uses.groupBy("kind").agg(F.sum("before").alias("n")).collect()
    usual = F.lit(None).cast("double")
    for r in kinds:  # one of KINDS each
        usual = F.when(F.col("kind") == r["kind"], r["n"] / every["n"]).otherwise(usual)
    share = F.col("before") / F.col("n")
    own = uses.join(totals, "context").where((share >= CONFIDENT) | (share >= LIFT * usual))
    patterns = patterns.join(own.select("kind", "context"), ["kind", "context"], "left_semi")
    graph = edges.join(patterns, ["kind", "context", "pattern"])
    graph = stored(spark, graph, "graph")
    found, size = graph.select("kind", "instance").limit(0), 0
    while True:
        taken = found.withColumn("taken", F.lit(True))
        counted = F.col("seed") | F.coalesce("taken", F.lit(False))
        confidence = (
            graph.join(taken, ["kind", "instance"], "left")
            .groupBy("kind", "context", "pattern", "forms")
            .agg(F.count_if(counted).alias("known"))
            .withColumn("conf", F.col("known") / F.col("forms"))
            .where((F.col("known") >= SEEDS) & (F.col("conf") >= CONFIDENT))
            .select("kind", "pattern", "conf")
        )
        # 1 - product of (1 - confidence); a confidence of 1 is taken as nearly 1
        doubt = F.sum(F.log(F.greatest(1 - F.col("conf"), F.lit(1e-9))))
        found = stored(
            spark,
            graph.where("NOT seed")
            .join(confidence, ["kind", "pattern"])
            .groupBy("kind", "instance", "context")
            .agg(F.max("conf").alias("conf"))
            .groupBy("kind", "instance")
            .agg((1 - F.exp(doubt)).alias("score"))
            .where(F.col("score") >= ACCEPT)
            .select("kind", "instance"),
            "found",
        )
        before, size = size, found.count()
        if size == before:  # no form is new, as none goes
            break
    # a secret set by name somewhere is one wherever it stands
    named = mentions.where("seed").where(F.col("kind") == len(BASE)).select("kind", "instance")
    return found.union(named).distinct()


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, print, counts, base, spans for each row of ``docs`` (doc_id, text, ...).

    ``counts`` has the number of plain forms of each of BASE, ``base`` writes them as
    kind:start:end (code points, end exclusive) by start and kind, ``spans`` writes these, the secrets
    and the accepted weak forms, by start and KINDS. ``print`` is xxhash64 of the text. A null text is an empty one and has
    none; so a text without digits and "@". A null doc_id is returned as it is. Repeated rows give
    repeated rows. Without seeds nothing is learned. An empty table gives an empty result. Columns
    other than doc_id and text aren't read.
    """
    spark = docs.sparkSession
    modest_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    scan = rows.withColumn("print", F.xxhash64("text")).mapInArrow(_scan, SCAN)
    scan = stored(spark, scan.withColumn("row", F.monotonically_increasing_id()), "scan")
    mentions = scan.select("row", F.explode("mentions").alias("m")).select("row", "m.*")
    found = accepted(spark, rows, mentions)
    more = (
        mentions.where("NOT seed")
        .join(found, ["kind", "instance"])
        .groupBy("row")
        .agg(F.collect_set(F.struct("start", "kind", "end")).alias("more"))
    )
    names = F.array(*[F.lit(k) for k in KINDS])
    plain = F.transform(
        F.filter("mentions", lambda m: m.seed), lambda m: F.struct(m.start, m.kind, m.end)
    )
    added = F.coalesce("more", F.array().cast(f"array<{SPAN}>"))
    every = F.array_sort(F.concat(plain, added))
    text = F.transform(
        every,
        lambda s: F.concat_ws(
            ":", F.element_at(names, s["kind"] + 1), *[s[c].cast("string") for c in ("start", "end")]
        ),
    )
    return scan.join(more, "row", "left").select(
        "doc_id", "print", "counts", "base", F.array_join(text, ",").alias("spans")
    )


def mask(text: str | None, spans: str | None) -> str | None:
    """The text with each span replaced by its kind in angle brackets; overlapping ones by one."""
    if not text or not spans:
        return text
    parts, at = [], 0
    for kind, a, b in (s.split(":") for s in spans.split(",")):
        if int(a) >= at:
            parts.append(f"{text[at : int(a)]}<{kind}>")
        at = max(at, int(b))
    return "".join(parts) + text[at:]
