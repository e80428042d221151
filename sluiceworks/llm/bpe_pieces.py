"""Ids of whole texts from the tokenizers library, which sees each distinct piece once in a while.

A byte-pair tokenizer first cuts a text into pieces (words, numbers, runs of signs or white space)
and encodes each by itself with its model. Texts whose characters all lie in a range where the
pieces are known are cut here, and the model's answers for distinct pieces are remembered and strung
together. Any other text, and one that spells an added token, goes to the library whole. Both ways
give the same ids. Columns of texts for a byte-level tokenizer are cut all at once, from their bytes.
"""

from __future__ import annotations

import json
import re
import sys
import types
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from sluiceworks.llm.arrow_words import text_bytes

# Latin letters up to U+024F, digits and number signs, common punctuation. Left out, so that such
# texts go whole: controls that not every library counts as white space, and the capital dotted I,
# whose lower case is two characters.
LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
UNKNOWN = re.compile("[^\t-\r\x20-\x7e\xa0-įı-ɏ‐-‧]")
ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
# the library tries the endings first; what comes before them here begins with other characters
BYTE_LEVEL = re.compile(
    rf" ?[{LETTERS}]+| ?[{NUMBERS}]+|{ENDINGS}| ?[^\s{LETTERS}{NUMBERS}]+|\s+(?!\S)|\s+"
)
WORD_LEVEL = re.compile(rf"{ENDINGS}|[{LETTERS}]+|[{NUMBERS}]|[^\s{LETTERS}{NUMBERS}]+")
MOST_KEPT = 150_000  # words asked for last; as many of before are kept too
BLOCK_CHARS = 1 << 20
COLUMN_BYTES = 1 << 21  # texts of a column that are cut at once
OTHER, LETTER, NUMBER, WHITE, STRANGE = range(5)  # classes of characters; STRANGE are the UNKNOWN


def class_of(char: str) -> int:
    for pattern, kind in ((UNKNOWN, STRANGE), (f"[{LETTERS}]", LETTER), (f"[{NUMBERS}]", NUMBER), (r"\s", WHITE)):
        if re.match(pattern, char):
            return kind
    return OTHER


# by the byte, and by the low bits of the two bytes that make a character; longer ones are mostly strange
ONE_BYTE = np.array([class_of(chr(c)) if c < 0x80 else STRANGE for c in range(0x100)], np.uint8)
TWO_BYTES = np.array([class_of(chr(c)) if c >= 0x80 else STRANGE for c in range(0x800)], np.uint8)


def classes(data: np.ndarray) -> np.ndarray:
    """The class of the character that each byte of valid UTF-8 belongs to."""
    kind = ONE_BYTE[data]
    lead = np.flatnonzero(data >= 0xC0)
    two = lead[data[lead] < 0xE0]
    place = (data[two].astype(np.int64) & 0x1F) << 6 | (data[two + 1] & 0x3F)
    kind[two] = kind[two + 1] = TWO_BYTES[place]
    three = lead[data[lead] == 0xE2]
    last = data[three + 2]
    three = three[(data[three + 1] == 0x80) & (last >= 0x90) & (last <= 0xA7)]  # U+2010 to U+2027
    for i in range(3):
        kind[three + i] = OTHER
    return kind


def piece_starts(data: np.ndarray, kind: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether a piece of BYTE_LEVEL begins at each byte of texts in known classes.

    ``offsets`` are the texts' ends and beginnings in ``data``, ``kind`` its classes.
    """
    first = np.zeros(len(data) + 3, dtype=bool)  # of a text; what is behind the last one is no text's
    first[offsets] = True
    first[len(data) :] = True
    start = first[: len(data)].copy()
    start[1:] |= kind[1:] != kind[:-1]
    # the last white space before something begins a piece, a blank that of what follows
    white = kind == WHITE
    after = np.flatnonzero(white[:-1] & ~white[1:]) + 1
    after = after[~first[after]]
    last = after - 1
    last -= data[last] >= 0x80
    start[last] = True
    start[after[data[last] == 0x20]] = False
    # endings: an apostrophe at a piece's start takes one or two letters
    quote = np.flatnonzero((data == 0x27) & start)
    quote = quote[~first[quote + 1]]
    one, two = data[quote + 1], np.append(data, [0, 0])[quote + 2]
    two = np.where(first[quote + 2], 0, two)
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = np.zeros(len(quote), dtype=bool)
    for a, b in (b"re", b"ve", b"ll"):
        long |= (one == a) & (two == b)
    start[quote[short | long] + 1] = False
    start[quote[long] + 2] = False
    rest = np.concatenate([quote[short] + 2, quote[long] + 3])
    start[rest[rest < len(data)]] = True
    return start


def byte_signs() -> dict[str, int]:
    """The printable sign that stands for each byte in a byte-level vocabulary."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class Remembered(dict):
    """Answers of a function; of the rarely asked ones only as many as there is room for.

    What was asked for since the last turn is kept over the next one.
    """

    def __init__(self, answer: Callable[[str], bytes], most: int):
        self.answer, self.most, self.before = answer, most, {}

    def __missing__(self, key: str) -> bytes:
        found = self.before.get(key)
        if found is None:
            found = self.answer(key)
        if len(self) >= self.most:
            self.before = self.copy()
            self.clear()
        self[key] = found
        return found


def worker_memory() -> dict:
    """A dict that lives as long as the Python worker, which runs one task after another."""
    name = "_sluiceworks_worker_memory"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


class PieceEncoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.size = self.library.get_vocab_size(with_added_tokens=True)
        code = "H" if self.size <= 1 << 16 else "I"
        self.dtype = np.dtype(code)
        self.added = [t["content"] for t in spec["added_tokens"]]
        self.cut, self.lower = None, False
        plain = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        if spec["normalizer"] is None and spec["pre_tokenizer"] == plain:
            self.cut = BYTE_LEVEL
        elif spec["normalizer"] and self._word_level(spec):
            self.cut, self.lower = WORD_LEVEL, True
        if self.cut:
            self.model, self.code = self.library.model, code
            self.signs = {byte: sign for sign, byte in byte_signs().items()}
            # all pieces of a byte-level tokenizer are kept here
            self.pieces = Remembered(self._piece, MOST_KEPT if self.lower else 2 * MOST_KEPT)
            self.words = Remembered(self._word, MOST_KEPT)

    @classmethod
    def of_worker(cls, path: str) -> PieceEncoder:
        """The one that this Python worker keeps for its tasks."""
        memory = worker_memory()
        if ("pieces", path) not in memory:
            memory["pieces", path] = cls(path)
        return memory["pieces", path]

    def _piece(self, piece: str) -> bytes:
        spaced = piece[0] == " "
        word = piece[1:] if spaced else piece
        if word.isalpha() and word.isascii():  # its letters stand for themselves
            spelled = self.signs[0x20] + word if spaced else word
        else:
            spelled = piece.encode().decode("latin-1").translate(self.signs)
        return array(self.code, [t.id for t in self.model.tokenize(spelled)]).tobytes()

    def _word(self, word: str) -> bytes:
        """The ids of a word between white space, which may be several pieces."""
        if word.isalpha():  # one piece
            return self._piece(word)
        found = self.cut.findall(word)
        return b"".join([self.words[p] if p.isalpha() else self.pieces[p] for p in found])

    @staticmethod
    def _word_level(spec: dict) -> bool:
        steps = spec["normalizer"].get("normalizers", [])
        cut = (spec["pre_tokenizer"].get("pretokenizers") or [{}])[0]
        return (
            [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
            and cut.get("type") == "Split"
            and cut.get("invert") is True
            and cut.get("pattern") == {"Regex": ENDINGS + r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}
        )

    def one(self, text: str) -> bytes:
        """The ids of a text as integers of ``dtype``."""
        if self.cut is None or UNKNOWN.search(text) or any(t in text for t in self.added):
            ids = self.library.encode(text, add_special_tokens=False).ids
            return np.array(ids, dtype=self.dtype).tobytes()
        if self.lower:  # white space parts words and is dropped
            return b"".join(map(self.words.__getitem__, text.lower().split()))
        return b"".join(map(self.pieces.__getitem__, self.cut.findall(text)))

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text; a null is an empty text."""
        for text in texts:
            yield self.one(text or "")

    def column(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text of a string column; a null is an empty text."""
        if self.cut is not BYTE_LEVEL:
            for packed in self.encode(t.as_py() for t in texts):
                yield np.frombuffer(packed, self.dtype)
            return
        texts.validate(full=True)
        texts = texts.fill_null("")
        offsets, data = text_bytes(texts)
        a = 0
        while a < len(texts):
            most = offsets[a] + COLUMN_BYTES
            b = max(a + 1, int(np.searchsorted(offsets, most, side="right")) - 1)
            own = data[offsets[a] : offsets[b]]
            ids, ends, whole = self._cut_at_once(texts[a:b], offsets[a : b + 1] - offsets[a], own)
            for i in range(b - a):
                if whole[i]:
                    yield np.frombuffer(self.one(texts[a + i].as_py()), self.dtype)
                else:
                    yield ids[ends[i] : ends[i + 1]]
            a = b

    def _cut_at_once(
        self, texts: pa.Array, offsets: np.ndarray, data: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, where each text's begin and end, and which have none: they go whole."""
        kind = classes(data)
        start = piece_starts(data, kind, offsets)
        whole = np.zeros(len(texts), dtype=bool)
        whole[np.searchsorted(offsets, np.flatnonzero(kind == STRANGE), side="right") - 1] = True
        content = data.tobytes()
        for token in self.added:
            if token.encode() in content:
                whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(whole):  # one piece, which is null
            start[offsets[i] + 1 : offsets[i + 1]] = False
        begins = np.flatnonzero(start)
        bounds = np.searchsorted(begins, offsets)
        ends = np.append(begins, len(data)).astype(np.int32)
        valid = np.ones(len(begins), dtype=bool)
        valid[bounds[:-1][whole]] = False
        mask = pa.py_buffer(np.packbits(valid, bitorder="little"))
        every = pa.Array.from_buffers(
            pa.string(), len(begins), [mask, pa.py_buffer(ends), pa.py_buffer(content)]
        ).dictionary_encode()
        distinct = every.dictionary.to_numpy(zero_copy_only=False)
        found = [*map(self.pieces.__getitem__, distinct), b""]
        which = every.indices.fill_null(len(distinct)).to_numpy(zero_copy_only=False)
        ids = np.frombuffer(b"".join(found), self.dtype)
        size = np.fromiter(map(len, found), np.int64, len(found)) // self.dtype.itemsize
        each = size[which]  # ids of a piece
        done = np.concatenate([[0], np.cumsum(each)])
        place = np.repeat((np.cumsum(size) - size)[which] - done[:-1], each)
        place += np.arange(len(place))
        return ids[place], done[bounds], whole
