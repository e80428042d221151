"""Token ids in files of fixed-width bits.

A file has the ids bit-packed in blocks of BLOCK ids (lowest bit first, each id in just the bits
that the vocabulary needs), the block offsets, an index of the documents and a footer:

    blocks                                                    ceil(ids of the block * bits / 8) bytes
    block offsets                                             blocks + 1 integers of 64 bits
    index                       doc_id, first id in the file (64 bits each), 1 if doc_id is null (8)
    magic, bits, ids of a block, documents, ids, place of the offsets, place of the index   FOOTER

All numbers are little-endian. Any stretch of ids is read by its blocks' offsets and unpacked at once
with numpy. Documents follow each other by doc_id within a file and from file to file.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluiceworks.llm.bpe_pieces import PieceEncoder
from sluiceworks.llm.tables import modest_batches, partitions, stored
from sluiceworks.storage import file_system, scratch_dir

MAGIC = b"SLUICE01"
FOOTER = "<8sIIQQQQ"
FOOTER_BYTES = struct.calcsize(FOOTER)
BLOCK = 65_536  # a multiple of 8, so blocks end with a byte
READ_IDS = 1 << 20  # ids read at once
FILE_IDS = 1 << 26  # a file ends with the document that reaches so many ids,
FILE_DOCS = 1 << 20  # or so many documents, whose index is held until then


def width(size: int) -> int:
    """Bits that ids below ``size`` need."""
    return max(1, (size - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    each = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(each.astype(np.uint8).reshape(-1), bitorder="little").tobytes()


def unpack_bits(packed: bytes, bits: int, n: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(packed, f"<u{bits // 8}", n).astype("<u4")
    each = np.unpackbits(np.frombuffer(packed, np.uint8), count=n * bits, bitorder="little")
    weights = np.left_shift(np.uint32(1), np.arange(bits, dtype=np.uint32))
    return (each.reshape(n, bits).astype("<u4") * weights).sum(axis=1, dtype="<u4")


class TokenWriter:
    """Writes one file; ids come document by document."""

    def __init__(self, path: str, size: int):
        fs, name = file_system(path)
        fs.create_dir(os.path.dirname(name), recursive=True)
        self.bits = width(size)
        self.out = fs.open_output_stream(name)
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = 0
        self.offsets = [0]
        self.doc_ids: list[int | None] = []
        self.firsts: list[int] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.firsts.append(self.n_ids)
        self.n_ids += len(ids)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= BLOCK:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        every = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        end = len(every) if last else len(every) // BLOCK * BLOCK
        for a in range(0, end, BLOCK):
            packed = pack_bits(every[a : min(a + BLOCK, end)], self.bits)
            self.out.write(packed)
            self.offsets.append(self.offsets[-1] + len(packed))
        self.waiting, self.n_waiting = [every[end:]], len(every) - end

    def close(self) -> None:
        self._flush(True)
        index = self.offsets[-1] + 8 * len(self.offsets)
        self.out.write(np.array(self.offsets, "<u8").tobytes())
        self.out.write(np.array([d or 0 for d in self.doc_ids], "<i8").tobytes())
        self.out.write(np.array(self.firsts, "<u8").tobytes())
        self.out.write(np.array([d is None for d in self.doc_ids], np.uint8).tobytes())
        sizes = (MAGIC, self.bits, BLOCK, len(self.doc_ids), self.n_ids, self.offsets[-1], index)
        self.out.write(struct.pack(FOOTER, *sizes))
        self.out.close()


class TokenFile:
    """Random access to a file that TokenWriter wrote."""

    def __init__(self, path: str):
        fs, name = file_system(path)
        self.file = fs.open_input_file(name)
        end = self.file.size() - FOOTER_BYTES
        magic, self.bits, self.block, docs, self.n_ids, offsets, index = struct.unpack(
            FOOTER, self.file.read_at(FOOTER_BYTES, end)
        )
        if magic != MAGIC:
            raise ValueError(f"{path} is no token file")
        self.offsets = np.frombuffer(self.file.read_at(index - offsets, offsets), "<u8")
        whole = self.file.read_at(end - index, index)
        self.doc_ids = np.frombuffer(whole, "<i8", docs)
        self.firsts = np.append(np.frombuffer(whole, "<u8", docs, 8 * docs), np.uint64(self.n_ids))
        self.null = np.frombuffer(whole, np.uint8, docs, 16 * docs).astype(bool)

    def ids(self, start: int, n: int) -> np.ndarray:
        """The n ids from a place on."""
        if not n:
            return np.zeros(0, "<u4")
        a, b = start // self.block, -(-(start + n) // self.block)
        begin, end = int(self.offsets[a]), int(self.offsets[b])
        packed = self.file.read_at(end - begin, begin)
        there = min(self.n_ids, b * self.block) - a * self.block
        return unpack_bits(packed, self.bits, there)[start - a * self.block :][:n]

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """(doc_id, ids) of each document, about READ_IDS ids read at once."""
        firsts, a = self.firsts.astype(np.int64), 0
        while a < len(self.doc_ids):
            b = max(a + 1, int(np.searchsorted(firsts, firsts[a] + READ_IDS, side="right")) - 1)
            b = min(b, len(self.doc_ids))
            ids = self.ids(int(firsts[a]), int(firsts[b] - firsts[a]))
            for d in range(a, b):
                doc_id = None if self.null[d] else int(self.doc_ids[d])
                yield doc_id, ids[firsts[d] - firsts[a] : firsts[d + 1] - firsts[a]]
            a = b

    def close(self) -> None:
        self.file.close()


def _written(folder: str, tokenizer: str, end_id: int, file_ids: int, file_docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, piece, out = TaskContext.get().partitionId(), 0, None
        encoder = PieceEncoder.of_worker(tokenizer)

        def closed() -> pa.RecordBatch:
            out.close()
            sizes = [[part], [piece], [path], [len(out.doc_ids)], [out.n_ids]]
            return pa.RecordBatch.from_arrays(
                [pa.array(c) for c in sizes], ["part", "piece", "path", "n_docs", "n_tokens"]
            )

        for batch in batches:
            texts = (t.as_py() for t in batch.column(1))
            for doc_id, packed in zip(batch.column(0).to_pylist(), encoder.encode(texts), strict=True):
                if out is None:
                    # a name for each attempt; only that of the attempt that counts gets into the list
                    path = f"{folder}/part-{part:06d}-{piece:06d}-{uuid.uuid4().hex}.bits"
                    out = TokenWriter(path, max(encoder.size, end_id + 1))
                out.add(doc_id, np.append(np.frombuffer(packed, encoder.dtype), end_id).astype("<u4"))
                if out.n_ids >= file_ids or len(out.doc_ids) >= file_docs:
                    yield closed()
                    out, piece = None, piece + 1
        if out:
            yield closed()

    return run


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    file_ids: int = FILE_IDS,
    file_docs: int = FILE_DOCS,
) -> DataFrame:
    """Write the ids of ``docs`` (doc_id, text, ...), each with ``end_id``, as files in ``folder``.

    Returns the list of the files: their number, path, n_docs, n_tokens and start, the ids in all files
    before. Documents are dealt by ranges of doc_id, sorted, a task each; a task begins a new file
    when one has ``file_ids`` ids or ``file_docs`` documents. Null doc_ids come first, and rows of one doc_id follow each other. Null and empty texts are just the end id. An
    empty table makes no files. The folder must be one that all executors share.
    """
    modest_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    n = partitions(docs.sparkSession)
    # quantiles of the ids alone, so that no text is read twice; n numbers at most
    shares = [i / n for i in range(1, n)] or [0.5]
    found = rows.agg(F.percentile_approx("doc_id", shares, 100 * n)).first()[0]
    bounds = F.array(*[F.lit(b).cast("long") for b in sorted(set(found or []))])
    part = F.coalesce(F.size(F.filter(bounds, lambda b: b < F.col("doc_id"))), F.lit(0))
    dealt = rows.repartitionById(n, part.cast("int")).sortWithinPartitions(
        "doc_id", F.xxhash64("text")
    )
    files = dealt.mapInArrow(
        _written(folder, tokenizer, end_id, file_ids, file_docs),
        "part long, piece long, path string, n_docs long, n_tokens long",
    )
    # a row for each file
    order = Window.orderBy("part", "piece")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return stored(docs.sparkSession, files, "token-files").select(
        (F.row_number().over(order) - 1).alias("number"),
        "path",
        "n_docs",
        "n_tokens",
        F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start"),
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            file, out = TokenFile(path), []
            for doc_id, ids in file.documents():
                out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
                start += len(ids)
                if len(out) == 10_000:
                    yield _rows(out)
                    out = []
            file.close()
            yield _rows(out)


def _rows(out: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*out, strict=True)) or [[]] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "n_tokens", "ids_crc32"]
    )


def read_digests(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document in files that write_tokens() listed.

    A null doc_id comes back as one; repeated rows are documents of their own. An empty list gives an
    empty result.
    """
    # the list is short but its files are not: a task for each, which Spark must not join
    dealt = files.repartitionById(max(1, files.count()), F.col("number"))
    return dealt.select("path", "start").mapInArrow(_digests, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_folder(spark: SparkSession) -> str:
    """A new folder in the place that all executors share."""
    return scratch_dir(spark, "tokens")
