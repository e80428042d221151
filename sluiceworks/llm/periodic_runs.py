"""Runs: stretches of words that repeat with a period, and texts with all but one period taken out.

A run of period q is a stretch of equalities between the words i and i + q. It covers whole steps of a
grid, wide for long periods and narrow for short ones, so all periods together have n log n grid points.
Each point where the two words are equal is extended to both sides by longest common extensions (LCE):

1. A difference cover modulo V has, for any two places, a common shift below V that takes both of them to
   sampled places. So an LCE compares fewer than V words until the two are synchronised.
2. Only the suffixes at sampled places are sorted, as sequences of blocks of V words, by prefix doubling.
   Neighbours in that order get the number of blocks they share.
3. A sparse table of these numbers has the smallest of any range, which is what two synchronised suffixes
   share. Fewer than V words are compared after that.

Tables are built for the texts that need them only: most candidates end before they are synchronised.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceworks.llm.arrow_words import WordReader, mix
from sluiceworks.llm.tables import modest_batches

V = 13
COVER = (0, 1, 3, 9)  # every difference modulo 13 is one of two of these
LEAST = 6
EXPONENT = 4
POINTS = 1 << 19  # grid points looked at together

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
KIND = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, text string"


def _shifts() -> np.ndarray:
    """Row a, column b: the least shift that takes places a and b modulo V into the cover."""
    inside = np.isin(np.arange(2 * V) % V, COVER)
    a, b = np.indices((V, V))
    out = np.full((V, V), V)
    for d in range(V - 1, -1, -1):
        out[inside[a + d] & inside[b + d]] = d
    return out


SHIFT = _shifts()


class Extensions:
    """Longest common extensions to the right of places in a sequence of word codes."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        ends = mix(np.arange(1, 3 * V + 1, dtype=np.uint64) + np.uint64(n << 8))  # like no other place
        self.n, self.words = n, np.concatenate([words, ends])
        self.rank: np.ndarray | None = None

    def _same(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(equal words from i and j on, up to ``most``; whether it got that far)."""
        length = np.zeros(len(i), np.int64)
        alive = np.arange(len(i))
        for t in range(V):
            alive = alive[most[alive] > t]
            alive = alive[self.words[i[alive] + t] == self.words[j[alive] + t]]
            if not len(alive):
                break
            length[alive] = t + 1
        return length, length == most

    def near(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(LCE up to the synchronised places, whether these were reached)."""
        return self._same(i, j, SHIFT[i % V, j % V])

    def beyond(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """LCE of pairs of places that are synchronised: ``i`` and ``j`` are sampled."""
        if self.rank is None:
            self._sort()
        a, b = self.rank[self.at[i]], self.rank[self.at[j]]
        low, high = np.minimum(a, b), np.maximum(a, b)  # the shares of low+1..high
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        blocks = np.minimum(
            self.table[level, low + 1], self.table[level, high - (1 << level) + 1]
        ).astype(np.int64)
        i, j = i + V * blocks, j + V * blocks
        return V * blocks + self._same(i, j, np.full(len(i), V))[0]

    def _sort(self) -> None:
        places = np.arange(self.n + 1)
        places = places[np.isin(places % V, COVER)]
        m = len(places)
        self.at = np.full(self.n + 1, -1, np.int64)
        self.at[places] = np.arange(m)
        block = np.full(m, V, np.uint64)
        for t in range(V):
            block = mix(block * np.uint64(0x9E3779B97F4A7C15) + self.words[places + t])
        after = places + V
        step = np.full(m + 1, m, np.int64)  # the sampled place that 2**level blocks later is; m: none
        step[:m][after <= self.n] = self.at[after[after <= self.n]]
        ranks, steps = [], []
        rank = np.append(np.unique(block, return_inverse=True)[1] + 1, 0)
        while True:
            ranks.append(rank.astype(np.int32))
            steps.append(step.astype(np.int32))
            if rank[:m].max() == m:
                break
            key = rank[:m] * (m + 1) + rank[step[:m]]
            rank = np.append(np.unique(key, return_inverse=True)[1] + 1, 0)
            step = step[step]
        self.rank = rank[:m] - 1
        order = np.argsort(self.rank)
        a, b = order[:-1].copy(), order[1:].copy()
        shared = np.zeros(m, np.int32)
        for level in range(len(ranks) - 1, -1, -1):
            same = (ranks[level][a] == ranks[level][b]) & (a < m) & (b < m)
            shared[1:][same] += 1 << level
            a[same], b[same] = steps[level][a[same]], steps[level][b[same]]
        rows = [shared]
        width = 1
        while 2 * width <= m:
            least = rows[-1].copy()
            np.minimum(least[:-width], rows[-1][width:], out=least[:-width])
            rows.append(least)
            width *= 2
        self.table = np.stack(rows)


def _grid(n: int, least: int, exponent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (place, period) of the grid of all periods, some POINTS of them at once."""
    period = np.arange(1, n // exponent + 1)
    step = np.maximum(least, exponent * period) - period
    points = (n - period - 1) // step + 1
    total = np.cumsum(points)
    first = 0
    while first < len(period):
        done = total[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(total, done + POINTS, side="right")))
        own = points[first:last]
        q = np.repeat(period[first:last], own)
        k = np.arange(len(q)) - np.repeat(np.cumsum(own) - own, own)
        yield k * np.repeat(step[first:last], own), q
        first = last


def runs_of(words: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> np.ndarray:
    """Rows (start, period, length) of all runs of a sequence of word codes, sorted.

    A run has at least ``least`` words and ``exponent`` periods, can't be extended to either side, and
    its period is its smallest.
    """
    n = len(words)
    found = []
    right, left = None, None
    for i, q in _grid(n, least, exponent):
        hit = np.flatnonzero(words[i] == words[i + q])
        if not len(hit):
            continue
        if right is None:
            right, left = Extensions(words), Extensions(words[::-1])
        i, q = i[hit], q[hit]
        needed = np.maximum(least, exponent * q) - q
        ahead, open_ahead = right.near(i, i + q)
        back, open_back = left.near(n - i, n - i - q)
        may = open_ahead | open_back | (ahead + back >= needed)
        i, q, needed, ahead, back = i[may], q[may], needed[may], ahead[may], back[may]
        more = np.flatnonzero(open_ahead[may])
        if len(more):
            from_ = i[more] + ahead[more]
            ahead[more] += right.beyond(from_, from_ + q[more])
        # what is behind matters only if it can still be enough
        more = np.flatnonzero(open_back[may])
        if len(more):
            from_ = n - i[more] + back[more]
            back[more] += left.beyond(from_, from_ - q[more])
        whole = ahead + back >= needed
        start, end = (i - back)[whole], (i + q + ahead)[whole]
        found.append(np.unique(np.stack([start, end, q[whole]], axis=1), axis=0))
    if not found:
        return np.zeros((0, 3), np.int64)
    rows = np.unique(np.concatenate(found), axis=0)
    # a stretch has its smallest period first; the others are multiples of it
    first = np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1))[: len(rows)]
    rows = rows[first]
    rows = np.stack([rows[:, 0], rows[:, 2], rows[:, 1] - rows[:, 0]], axis=1)
    return rows[np.lexsort((rows[:, 1], rows[:, 0]))]


def repeated_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Of each of n words whether a run covers it after its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 1], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 2], -1)
    return np.cumsum(edge[:-1]) > 0


def _scan(least: int, exponent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = WordReader()
        for batch in batches:
            for chunk in reader.chunks(batch.column(1)):
                n_words, sizes, all_runs, texts = [], [0], [], []
                for a, b in zip(chunk.bounds[:-1].tolist(), chunk.bounds[1:].tolist(), strict=True):
                    runs = runs_of(chunk.hashes[a:b], least, exponent)
                    data = chunk.data[chunk.starts[a] : chunk.ends[b - 1]].tobytes() if b > a else b""
                    words = data.split()
                    if len(runs):
                        kept = np.flatnonzero(~repeated_words(b - a, runs))
                        words = [words[k] for k in kept.tolist()]
                    n_words.append(b - a)
                    sizes.append(sizes[-1] + len(runs))
                    all_runs.append(runs)
                    texts.append(b" ".join(words))
                rows = np.concatenate(all_runs)
                parts = [pa.array(rows[:, k]) for k in (0, 2, 1)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(chunk.first, len(chunk)),
                        pa.array(n_words, pa.int64()),
                        pa.ListArray.from_arrays(
                            pa.array(sizes, pa.int32()), pa.StructArray.from_arrays(parts, fields=list(RUN))
                        ),
                        pa.array(texts, pa.binary()).cast(pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "text"],
                )

    return run


def find_runs(docs: DataFrame, least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """doc_id, n_words, runs, text for each row of ``docs`` (doc_id, text, ...).

    Words are runs of anything but ASCII white space, numbered from 0. ``runs`` has (start, length,
    period) of every stretch of at least ``least`` words and ``exponent`` of its smallest periods that
    no word beside it continues, by start, then period. ``text`` is the words that no run covers after
    its first period, joined by one space. A null, an empty text and one without words have no words
    and no runs, and give an empty text. Each row is looked at by itself, so repeated rows and rows
    without doc_id stay as they came. An empty table gives an empty result. Columns other than doc_id
    and text aren't read. Two words are equal if their 64-bit hashes are.
    """
    modest_batches(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return own.mapInArrow(_scan(least, exponent), KIND)
