"""Byte-pair encoding of words along a trie, and decoding.

Merges never make the encoding of a prefix depend on what follows, once its last token is fixed: the
tokens of a prefix are those of a shorter prefix and one more token, the last. That token is the one
that ends the prefix and that merging leaves alone beside the shorter prefix's own last token. So a
trie node needs only its last token, found from nodes above it, and words with a common prefix share
that work. Here a depth-first walk over the trie is a walk over the sorted distinct words of a block:
the states of the path stay on a stack, and a word adds the nodes that its predecessor lacks.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceworks.llm.bpe_pieces import (
    BLOCK_CHARS,
    BYTE_LEVEL,
    ENDINGS,
    MOST_KEPT,
    UNKNOWN,
    byte_signs,
    worker_memory,
)
from sluiceworks.llm.tables import modest_batches

ANY_TEXT = regex.compile(
    rf"{ENDINGS}| ?\p{{L}}+| ?\p{{N}}+| ?[^\s\p{{L}}\p{{N}}]+|\s+(?!\S)|\s+"
)


class TrieEncoder:
    """A byte-level vocabulary with merges, from a file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        signs = byte_signs()
        model = spec["model"]
        self.ids = {bytes(signs[c] for c in t): i for t, i in model["vocab"].items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes: dict[int, bytes] = {i: t for t, i in self.ids.items()}
        self.bytes |= {i: t.encode() for t, i in self.added.items()}
        self.longest = max(map(len, self.ids))
        self.rank: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}  # of each token that a merge makes
        for n, pair in enumerate(model["merges"]):
            a, b = (bytes(signs[c] for c in t) for t in (pair if isinstance(pair, list) else pair.split(" ")))
            own = self.ids[a], self.ids[b]
            self.rank[own] = n
            self.halves[self.ids[a + b]] = own
        self.size = max(self.bytes) + 1
        self.never = len(self.rank)
        self.edges: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.stable: dict[int, bool] = {}
        self.cut_added = (
            re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
            if self.added
            else None
        )
        self.known: dict[str, bytes] = {}  # words asked for last
        self.before: dict[str, bytes] = {}

    @classmethod
    def of_worker(cls, path: str) -> TrieEncoder:
        """The one that this Python worker keeps for its tasks."""
        memory = worker_memory()
        if ("trie", path) not in memory:
            memory["trie", path] = cls(path)
        return memory["trie", path]

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens that stand at one end of a token while it is merged together, each with the
        rank of the merge that takes it up; the token itself is never taken up."""
        found = self.edges.get((token, side))
        if found is None:
            found, until = [], self.never
            while True:
                found.append((token, until))
                if token not in self.halves:
                    break
                until = self.rank[self.halves[token]]
                token = self.halves[token][side]
            self.edges[found[0][0], side] = found
        return found

    def stay(self, a: int, b: int) -> bool:
        """Whether merging leaves these two tokens as they are when they stand side by side.

        It doesn't if, while they grow, two tokens meet at their border that a merge joins before
        either is taken up. Of equal merges the one further left comes first.
        """
        key = a * self.size + b
        found = self.stable.get(key)
        if found is None:
            found, rank, firsts = True, self.rank, self._edge(b, 0)
            for x, until_x in self._edge(a, 1):
                for y, until_y in firsts:
                    n = rank.get((x, y), self.never)
                    if n < until_x and n <= until_y:
                        found = False
            self.stable[key] = found
        return found

    def walk(self, words: list[bytes]) -> Iterator[list[int]]:
        """Tokens of each of the sorted distinct words."""
        ids, stay, longest = self.ids, self.stay, self.longest
        path: list[int] = []  # last token of each prefix of the word before
        before = b""
        for word in words:
            same, most = 0, min(len(word), len(before))
            while same < most and word[same] == before[same]:
                same += 1
            del path[same:]
            for end in range(same + 1, len(word) + 1):
                for begin in range(max(0, end - longest), end):
                    token = ids.get(word[begin:end])
                    if token is not None and (begin == 0 or stay(path[begin - 1], token)):
                        path.append(token)
                        break
            before = word
            out, end = [], len(word)
            while end:
                out.append(path[end - 1])
                end -= len(self.bytes[out[-1]])
            yield out[::-1]

    def _pieces(self, text: str) -> list[str]:
        return (ANY_TEXT if UNKNOWN.search(text) else BYTE_LEVEL).findall(text)

    def _block(self, texts: list[str]) -> Iterator[bytes]:
        parts = [self.cut_added.split(t) if self.cut_added else [t] for t in texts]
        cut = [[p if p in self.added else self._pieces(p) for p in own] for own in parts]
        if len(self.known) > MOST_KEPT:
            self.before, self.known = self.known, {}
        if len(self.stable) > 2 * MOST_KEPT:
            self.stable.clear()
        new: set[str] = set()
        for own in cut:
            for p in own:
                if isinstance(p, list):
                    new.update(p)
        new = {p for p in new if p not in self.known}
        self.known.update((p, self.before[p]) for p in new if p in self.before)
        missing = sorted((p.encode(), p) for p in new if p not in self.known)
        for (_, p), found in zip(missing, self.walk([b for b, _ in missing]), strict=True):
            self.known[p] = array("I", found).tobytes()
        look = self.known.__getitem__
        for own in cut:
            yield b"".join(
                b"".join(map(look, p)) if isinstance(p, list) else np.uint32(self.added[p]).tobytes()
                for p in own
            )

    def encode(self, texts: Iterator[str | None]) -> Iterator[bytes]:
        """The ids of each text (null: empty) as little-endian unsigned 32-bit integers."""
        block, chars = [], 0
        for t in texts:
            block.append(t or "")
            chars += len(block[-1])
            if chars >= 2 * BLOCK_CHARS:
                yield from self._block(block)
                block, chars = [], 0
        yield from self._block(block)

    def decode(self, packed: bytes) -> str:
        table = self.bytes
        ids = np.frombuffer(packed, "<u4").tolist()
        return b"".join([table[i] for i in ids]).decode("utf-8", errors="replace")


def _encoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TrieEncoder.of_worker(path)
        for batch in batches:
            ids = list(encoder.encode(t.as_py() for t in batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return run


def _decoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TrieEncoder.of_worker(path)
        for batch in batches:
            texts = [encoder.decode(ids.as_py() or b"") for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "text"]
            )

    return run


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, ids for each row of ``docs`` (doc_id, text, ...).

    ``ids`` holds little-endian unsigned 32-bit integers, those that the tokenizers library gives
    without special tokens; an added token spelled in a text is that token. A null or empty text has
    none. Null doc_ids and repeated rows are returned as they are, an empty table gives an empty
    result. ``tokenizer`` is the path of a byte-level file on every executor. Columns other than
    doc_id and text aren't read.
    """
    modest_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(_encoded(tokenizer), "doc_id long, ids binary")


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, ids, text for each row of what encode() returns; null ids are an empty text."""
    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(_decoded(tokenizer), "doc_id long, ids binary, text string")
