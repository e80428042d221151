"""A small convolutional network over bytes that tells good texts from bad ones.

A text's bytes are cut into overlapping chunks that cover all of it. Learned filters run over each
chunk; the largest answer of each filter describes the chunk, a hidden layer reads these, and its mean
over the chunks gives one probability. Training and scoring are numpy: the weights are a few
kilobytes, learned on the driver from a bounded sample, and go to the tasks with the function.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from sluiceworks.llm.arrow_words import text_bytes
from sluiceworks.llm.tables import modest_batches

CHUNK = 256  # bytes
STEP = 191  # from one chunk to the next; odd, so that chunks begin at all places modulo GROUP
GROUP = 4  # a filter sees two neighbouring groups of bytes and moves on by one
EMBED = 8
FILTERS = 32
HIDDEN = 16
PAD = 256  # the byte beyond a text's end
AGAIN = 257
LAGS = range(2, 33)
SAMPLE_ROWS = 1200  # labelled texts of each class that are learned from
SAMPLE_BYTES = 16_384  # bytes of a text that are learned from; of a longer one, stretches all over it
STRETCH = 1024
STEPS = 800
BATCH = 32  # half of each class
CUT = 0.3
BLOCK_BYTES = 1 << 18
HELD_OUT = 5


def chunks(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes of each chunk, first chunk of each text); an empty text has one chunk of padding.

    A code is the byte, and AGAIN more where it begins four bytes that began at one of the LAGS
    places before as well (of the fourth byte the low five bits count): filters over bytes alone can't
    tell that a word comes again and again.
    """
    size = np.diff(offsets)
    count = 1 + np.maximum(0, -(-(size - CHUNK) // STEP))
    first = np.concatenate([[0], np.cumsum(count)])
    text = np.repeat(np.arange(len(size)), count)
    begin = offsets[:-1][text] + (np.arange(first[-1]) - first[text]) * STEP
    place = begin[:, None] + np.arange(CHUNK)
    inside = place < offsets[1:][text][:, None]
    codes = np.full(place.shape, PAD, dtype=np.int16)
    codes[inside] = data[place[inside]]
    wide = codes.astype(np.uint32)
    four = wide[:, :-3] | wide[:, 1:-2] << 9 | wide[:, 2:-1] << 18 | (wide[:, 3:] & 31) << 27
    again = np.zeros(four.shape, dtype=bool)
    for lag in LAGS:
        again[:, lag:] |= four[:, lag:] == four[:, :-lag]
    codes[:, :-3][again & (codes[:, :-3] != PAD)] += AGAIN
    return codes, first


@dataclass
class ByteCnn:
    """Weights, and how sure the training sample makes us of each class (``shift``)."""

    embed: np.ndarray
    filters: np.ndarray  # (GROUP * EMBED, 2 * FILTERS): the answers to a filter's two groups
    bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    shift: float = 0.0
    constant: float | None = None

    @classmethod
    def start(cls, seed: int = 11) -> ByteCnn:
        rng = np.random.default_rng(seed)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        embed = normal(PAD + AGAIN, EMBED, scale=0.5)
        embed[PAD] = 0
        return cls(
            embed,
            normal(GROUP * EMBED, 2 * FILTERS, scale=0.25),
            np.zeros(FILTERS, np.float32),
            normal(FILTERS, HIDDEN, scale=0.25),
            np.full(HIDDEN, 0.1, np.float32),
            normal(HIDDEN, scale=0.25),
            np.zeros(1, np.float32),
        )

    def weights(self) -> list[np.ndarray]:
        return [
            self.embed, self.filters, self.bias, self.hidden, self.hidden_bias, self.out, self.out_bias
        ]

    def forward(self, codes: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        groups = self.embed[codes].reshape(-1, GROUP * EMBED)
        both = (groups @ self.filters).reshape(len(codes), CHUNK // GROUP, 2 * FILTERS)
        answers = both[:, :-1, :FILTERS] + both[:, 1:, FILTERS:]
        top = answers.max(axis=1)
        pooled = np.maximum(top + self.bias, 0)
        read = np.maximum(pooled @ self.hidden + self.hidden_bias, 0)
        mean = np.add.reduceat(read, first[:-1], axis=0) / np.diff(first)[:, None]
        return {
            "groups": groups, "answers": answers, "pooled": pooled, "read": read, "mean": mean,
            "logit": mean @ self.out + self.out_bias[0],
        }

    def gradients(
        self, codes: np.ndarray, first: np.ndarray, wanted: np.ndarray
    ) -> list[np.ndarray]:
        """Of the mean cross entropy."""
        f = self.forward(codes, first)
        error = (1 / (1 + np.exp(-f["logit"])) - wanted) / len(wanted)
        error = error.astype(np.float32)
        count = np.diff(first)
        text = np.repeat(np.arange(len(count)), count)
        read = (error / count)[text][:, None] * self.out * (f["read"] > 0)
        pooled = read @ self.hidden.T * (f["pooled"] > 0)
        at = f["answers"].argmax(axis=1)[:, None, :]
        both = np.zeros((len(codes), CHUNK // GROUP, 2 * FILTERS), np.float32)
        np.put_along_axis(both[:, :, :FILTERS], at, pooled[:, None, :], axis=1)
        np.put_along_axis(both[:, :, FILTERS:], at + 1, pooled[:, None, :], axis=1)
        both = both.reshape(-1, 2 * FILTERS)
        bytes_ = (both @ self.filters.T).reshape(-1, EMBED)
        flat = codes.reshape(-1)
        embed = np.stack(
            [np.bincount(flat, bytes_[:, j], PAD + AGAIN) for j in range(EMBED)], axis=1
        ).astype(np.float32)
        embed[PAD] = 0
        return [
            embed, f["groups"].T @ both, pooled.sum(axis=0), f["pooled"].T @ read, read.sum(axis=0),
            error @ f["mean"], error.sum(keepdims=True),
        ]

    def score(self, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each text, worked on in blocks of whole texts."""
        n = len(offsets) - 1
        if self.constant is not None:
            return np.full(n, self.constant)
        out, a = np.zeros(n), 0
        while a < n:
            b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + BLOCK_BYTES, side="right")) - 1)
            logit = self._logits(offsets[a : b + 1] - offsets[a], data[offsets[a] : offsets[b]])
            out[a:b] = 1 / (1 + np.exp(-np.clip(logit + self.shift, -500, 500)))
            a = b
        return out

    def _logits(self, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
        if len(offsets) > 2 or offsets[-1] <= 2 * BLOCK_BYTES:
            return self.forward(*chunks(offsets, data))["logit"]
        # one long text: the mean over its chunks, part by part
        total, count, step = np.zeros(HIDDEN), 0, BLOCK_BYTES // STEP * STEP
        for begin in range(0, max(1, len(data) - CHUNK + STEP), step):
            part = data[begin : begin + step - STEP + CHUNK]
            f = self.forward(*chunks(np.array([0, len(part)]), part))
            total += f["read"].sum(axis=0, dtype=np.float64)
            count += len(f["read"])
        return np.atleast_1d(total / count @ self.out + self.out_bias[0])


def train(texts: list[bytes], labels: list[int], rates: tuple[float, float], seed: int = 5) -> ByteCnn:
    """Learn from texts and their 0/1 labels.

    ``rates`` are the shares of the classes among all labelled rows; the sample may have others.
    With one class only, the score is that class for every text; without any rows it is 0.5.
    """
    model = ByteCnn.start()
    if len(set(labels)) < 2:
        model.constant = float(labels[0]) if labels else 0.5
        return model
    wanted = np.array(labels, dtype=np.float32)
    rng = np.random.default_rng(seed)
    # short good texts are rare, so a piece of each good text is learned from too
    good = [t for t, label in zip(texts, labels, strict=True) if label]
    begins = [int(rng.integers(0, max(1, len(t) - 16))) for t in good]
    texts = texts + [t[b : b + int(rng.integers(8, 256))] for t, b in zip(good, begins, strict=True)]
    wanted = np.append(wanted, np.ones(len(texts) - len(wanted), np.float32))
    weights = model.weights()
    mean = [np.zeros_like(w) for w in weights]
    square = [np.zeros_like(w) for w in weights]
    classes = [np.flatnonzero(wanted == c) for c in (0, 1)]
    for step in range(1, STEPS + 1):
        rows = np.concatenate([rng.choice(c, BATCH // 2) for c in classes])
        own = [texts[i] for i in rows]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in own])])
        data = np.frombuffer(b"".join(own), np.uint8)
        slopes = model.gradients(*chunks(offsets, data), wanted[rows])
        rate = 0.004 * (1 - (step - 1) / STEPS)
        for w, g, m, s in zip(weights, slopes, mean, square, strict=True):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    low, high = rates
    model.shift = float(np.log(max(high, 1e-6) / max(low, 1e-6)))  # batches hold as many of each
    return model


def held_out(doc_id: str) -> Column:
    """The rows that training never sees: crc32 of the doc_id as text divisible by HELD_OUT."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % HELD_OUT == 0


def excerpt(text: str, most: int) -> Column:
    """The bytes of a text, or of one longer than ``most`` stretches evenly spread over all of it."""
    data, n = F.col(text).cast("binary"), max(2, most // STRETCH)
    size = F.octet_length(text)
    begins = [F.lit(1) + (F.lit(i) * (size - STRETCH) / (n - 1)).cast("int") for i in range(n)]
    spread = F.concat(*[F.substr(data, b, F.lit(STRETCH)) for b in begins])
    return F.when(size <= most, data).otherwise(spread)


def learn(
    docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES
) -> ByteCnn:
    """Train on at most ``rows`` texts of each class of ``labels`` (doc_id, quality).

    The sample is the rows with the smallest hashes among those that aren't held out; texts may have
    any length, of the longer ones an excerpt of ``sample_bytes`` is learned. Of rows that share a doc_id
    the one with the smallest excerpt is taken. A doc_id with both labels counts for neither.
    """
    known = (
        labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
        .where(~held_out("doc_id"))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
        .where("low = high")
        .select("doc_id", F.col("low").alias("quality"))
    )
    count = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    total = max(1, sum(count.values()))
    texts = docs.where("text IS NOT NULL").select(F.col("doc_id").cast("long"), "text")
    fit = known.join(texts.select("doc_id").distinct(), "doc_id")
    picked = None
    for quality in (0, 1):
        part = fit.where(F.col("quality") == quality).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        picked = part if picked is None else picked.union(part)
    # at most 2 * rows pairs of numbers
    ids = docs.sparkSession.createDataFrame(picked.collect(), "doc_id long, quality int")
    picked = texts.join(F.broadcast(ids), "doc_id").select("doc_id", "quality", excerpt("text", sample_bytes).alias("x"))
    found = picked.groupBy("doc_id", "quality").agg(F.min("x").alias("x")).orderBy("doc_id").collect()
    rates = (count.get(0, 0) / total, count.get(1, 0) / total)
    return train([bytes(r["x"]) for r in found], [r["quality"] for r in found], rates)


def _scored(model: ByteCnn, text: int, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score(*text_bytes(batch.column(text)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores)], [*batch.schema.names, name]
            )

    return run


def add_score(docs: DataFrame, labels: DataFrame, name: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with the score of its text as one more column; see score_quality."""
    modest_batches(docs.sparkSession)
    model = learn(docs, labels, rows)
    kind = StructType([*docs.schema.fields, StructField(name, DoubleType())])
    return docs.mapInArrow(_scored(model, docs.columns.index("text"), name), kind)


def score_quality(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, score for each row of ``docs`` (doc_id, text, ...); a high score is a good text.

    The score depends on the text's bytes alone. Null and empty texts get the score of padding. A
    null doc_id is returned as it is; so are repeated rows. Without usable labels every score is
    0.5, with labels of one class that class. An empty table gives an empty result. Columns other
    than doc_id and text of ``docs`` and doc_id and quality of ``labels`` aren't read.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return add_score(texts, labels, "score", rows)
