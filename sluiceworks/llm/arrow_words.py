"""Words of whole texts as numpy arrays, straight from the bytes of an Arrow string column.

A batch is worked on in chunks of whole documents of about ``CHUNK_BYTES``; only a longer
document makes a longer chunk. Two words count as equal if their 64-bit hashes are equal.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_rng = np.random.default_rng(20240607)
BYTE_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
BASE = int(_rng.integers(1 << 62, 1 << 63)) | 5
NOT_SPACE = np.ones(256, dtype=bool)  # ASCII white space parts words
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over all output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE to the 0..n and the same of its inverse, modulo 2**64."""
    inverse = pow(BASE, -1, 1 << 64)
    out = []
    for base in (BASE, inverse):
        steps = np.full(n + 1, base, dtype=np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


@dataclass
class Chunk:
    """Words of consecutive documents. ``bounds[d]:bounds[d+1]`` are the words of document d."""

    first: int  # index of the first document in its batch
    data: np.ndarray  # bytes of all documents
    hashes: np.ndarray
    starts: np.ndarray  # byte range of each word in data
    ends: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the k words from each word on, and whether they lie in one document."""
        n = len(self.hashes)
        size = np.diff(self.bounds)
        left = np.repeat(self.bounds[1:], size) - np.arange(n)  # words to the document's end
        whole = left >= k
        padded = np.concatenate([self.hashes, np.zeros(k, np.uint64)])
        h = np.full(n, k, dtype=np.uint64)
        for i in range(k):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + padded[i : i + n])
        return h, whole


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; a null is an empty text."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, where, content = column.buffers()
    offsets = np.frombuffer(where, kind)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(content, np.uint8) if content is not None else np.zeros(0, np.uint8)
    return offsets.astype(np.int64), data


class WordReader:
    """Cuts string columns into chunks; keeps the tables of powers between them."""

    def __init__(
        self, lower: bool = False, chunk_bytes: int = CHUNK_BYTES, inside: np.ndarray = NOT_SPACE
    ):
        """``lower`` lowers A-Z; ``inside`` says of each byte, once lowered, if it is part of a word."""
        self.lower, self.inside = lower, inside
        self.chunk_bytes = chunk_bytes
        self.power, self.inverse = powers(2 * chunk_bytes)

    def chunks(self, column: pa.Array) -> Iterator[Chunk]:
        offsets, data = text_bytes(column)
        n, a = len(offsets) - 1, 0
        while a < n:
            most = offsets[a] + self.chunk_bytes
            b = max(a + 1, int(np.searchsorted(offsets, most, side="right")) - 1)
            yield self._chunk(a, offsets[a : b + 1] - offsets[a], data[offsets[a] : offsets[b]])
            a = b

    def _chunk(self, first: int, offsets: np.ndarray, data: np.ndarray) -> Chunk:
        if self.lower:
            upper = (data >= 65) & (data <= 90)
            data = data + (upper.astype(np.uint8) << 5)
        n = len(data)
        if n >= len(self.power):
            self.power, self.inverse = powers(n)
        inside = self.inside[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        closes = inside.copy()
        closes[:-1] &= ~inside[1:]
        edge = offsets[1:-1]
        edge = edge[(edge > 0) & (edge < n)]
        begins[edge] = inside[edge]
        closes[edge - 1] = inside[edge - 1]
        starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(BYTE_CODE[data] * self.power[:n], out=total[1:])
        hashes = mix((total[ends] - total[starts]) * self.inverse[starts])
        return Chunk(first, data, hashes, starts, ends, np.searchsorted(starts, offsets))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of the ``width`` values from each place on (fewer at the end)."""
    out, done = x.copy(), 1
    while done < width:
        step = min(done, width - done)
        if step >= len(out):
            out = np.minimum.accumulate(out[::-1])[::-1]
            break
        out[:-step] = np.minimum(out[:-step], out[step:])
        done += step
    return out
