"""Packing of documents into sequences, neighbours on a space-filling curve together.

A document is a vector of hashed words, projected to DIMS dimensions by random signs drawn from the
hashes themselves. Its place on the Hilbert curve through that space is its sort key: documents with
many words in common come close to each other. Spark deals the documents by ranges of the key, a large
group of copies to several, and sorts each; a partition fills its sequences in that order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceworks.llm.arrow_words import WordReader, mix
from sluiceworks.llm.bpe_pieces import PieceEncoder
from sluiceworks.llm.tables import modest_batches, partitions

DIMS = 4
BITS = 15  # of each dimension; the key has DIMS * BITS
LENGTH = 1024
LEAST_ROWS = 1000  # documents of a range on average, so that its one unfilled sequence is little
BOUND_ROWS = 20_000  # documents whose keys set the bounds of the ranges, drawn from all
MOST_IDS = 1 << 20  # about as many are held before they are handed on
PLACES = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset"]
KIND = ", ".join(f"{c} long" for c in PLACES) + ", ids binary"

KEYED = "doc_id long, text string, key long, part int"


def project(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Grid place (documents x DIMS) of documents given by their words' hashes."""
    size = np.diff(bounds)
    out = np.zeros((len(size), DIMS))
    for j in range(DIMS):
        part = ((words >> np.uint64(16 * j)) & np.uint64(0xFFFF)).astype(np.float64) - 32767.5
        total = np.concatenate([[0.0], np.cumsum(part)])
        out[:, j] = total[bounds[1:]] - total[bounds[:-1]]
    # mean of uniform values: standard deviation 2**16 / sqrt(12 n)
    scaled = out / (np.sqrt(np.maximum(size, 1) / 12)[:, None] * 2**16)
    # the logistic curve is close to the normal distribution's: about evenly spread places
    even = 1 / (1 + np.exp(-1.702 * scaled))
    return np.minimum((even * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)


def hilbert_key(places: np.ndarray) -> np.ndarray:
    """Position of each grid place along the Hilbert curve.

    Gray-code walk from the highest bit down: where a coordinate's bit is set the first
    coordinate's lower bits are flipped, elsewhere they are swapped with that coordinate's.
    """
    x = places.T.astype(np.int64).copy()
    n = len(x)
    for b in range(BITS - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(n):
            up = (x[i] >> b) & 1 == 1
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(up, low, 0) ^ swap
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(BITS - 1, 0, -1):
        turn ^= np.where((x[n - 1] >> b) & 1 == 1, (1 << b) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(BITS - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def parts_of(keys: np.ndarray, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The range of the sorted bounds that each key lies in.

    A key that is a bound several times over, as that of a large group of copies, may go to any
    of the ranges that it bounds; the ids decide.
    """
    low, high = np.searchsorted(bounds, keys, "left"), np.searchsorted(bounds, keys, "right")
    return low + (mix(ids.astype(np.uint64)) % (high - low + 1).astype(np.uint64)).astype(np.int64)


def _keyed(bounds: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = WordReader(lower=True)
        for batch in batches:
            ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            for chunk in reader.chunks(batch.column(1)):
                key = hilbert_key(project(chunk.hashes, chunk.bounds))
                rows = batch.slice(chunk.first, len(chunk))
                part = parts_of(key, ids[chunk.first : chunk.first + len(chunk)], bounds)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(key), pa.array(part.astype(np.int32))],
                    ["doc_id", "text", "key", "part"],
                )

    return run


def pieces(n: int, offset: int, length: int) -> list[tuple[int, int, int, int]]:
    """(start, length, sequences further, offset) of n ids that begin at an offset of a sequence."""
    out, start, step = [], 0, 0
    while start < n:
        take = min(length - offset, n - start)
        out.append((start, take, step, offset))
        start, offset = start + take, offset + take
        if offset == length:
            step, offset = step + 1, 0
    return out


def _batch(rows: list[tuple], ids: list[np.ndarray]) -> pa.RecordBatch:
    """Pieces by PLACES and their ids, which follow each other without a gap."""
    places = [pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [[]] * len(PLACES))]
    data = np.concatenate(ids) if ids else np.zeros(0, "<u4")
    ends = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([4 * row[2] for row in rows], out=ends[1:])
    packed = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(data)])
    return pa.RecordBatch.from_arrays([*places, packed], [*PLACES, "ids"])


def _packed(path: str, end_id: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder.of_worker(path)
        sequence, offset = TaskContext.get().partitionId() << 40, 0
        for batch in batches:
            out: list[tuple] = []
            held: list[np.ndarray] = []
            n_held = 0
            own = encoder.column(batch.column(1))
            for doc_id, found in zip(batch.column(0).to_pylist(), own, strict=True):
                ids = np.append(found, end_id).astype("<u4")
                for start, take, step, at in pieces(len(ids), offset, length):
                    out.append((doc_id, start, take, len(ids), sequence + step, at))
                done = offset + len(ids)
                sequence, offset = sequence + done // length, done % length
                held.append(ids)
                n_held += len(ids)
                if n_held >= MOST_IDS:
                    yield _batch(out, held)
                    out, held, n_held = [], [], 0
            yield _batch(out, held)

    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, length: int = LENGTH) -> DataFrame:
    """Pieces of documents (doc_id, text, ...) in sequences of at most ``length`` tokens.

    A document is its ids and ``end_id``; it is cut where a sequence is full, so only the last
    sequence of each partition is not. A piece has doc_id, start (the document's ids before it),
    length, ids_crc32, doc_tokens, sequence_id, offset (its first token's place there) and ids, its
    tokens as little-endian 32-bit numbers; ids_crc32 is the CRC of these bytes. The ids of a
    sequence's pieces, by offset, are the sequence. Null and empty texts are just the end id; so is
    each repeated row a document of its own. A null doc_id is packed like any other. An empty table
    gives no pieces. ``tokenizer`` is the path of a file of the tokenizers library on every executor.
    Columns other than doc_id and text aren't read.
    """
    modest_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    total = rows.count()
    n = max(1, min(partitions(docs.sparkSession), total // LEAST_ROWS))
    some = rows if total <= BOUND_ROWS else rows.sample(BOUND_ROWS / total, seed=3)
    shares = [i / n for i in range(1, n)] or [0.5]
    keys = some.mapInArrow(_keyed(np.zeros(0, np.int64)), KEYED)
    weight = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 64  # ranges of equal work
    ends = keys.agg(F.percentile("key", shares, weight)).first()[0]
    bounds = np.sort(np.array(ends or [], np.int64))
    keyed = rows.mapInArrow(_keyed(bounds), KEYED)
    curve = keyed.repartitionById(n, F.col("part")).sortWithinPartitions(
        "key", "doc_id", F.xxhash64("text")
    )
    filled = curve.select("doc_id", "text").mapInArrow(_packed(tokenizer, end_id, length), KIND)
    return filled.select(*PLACES[:3], F.crc32("ids").alias("ids_crc32"), *PLACES[3:], "ids")
