"""Whole texts to token ids with the tokenizers library, each distinct piece once.

Encoding a text in the library costs microseconds a token, yet most words of a
corpus repeat. A text is cut where no token can cross, the library encodes the
pieces it has not seen lately, and the rest comes from a bounded cache. The ids
equal those of ``Tokenizer.encode(text, add_special_tokens=False)``.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

# Entries of each cache, and the longest piece that is kept.
CACHED = 300_000
LONGEST = 48

# White space besides the space, tab, line feed and carriage return.
_ODD_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0  -     　]")
_BEFORE_WORD = re.compile(r"(?= \S)")
# Characters that normalisation leaves alone, but for their case.
_PLAIN = re.compile("[\x21-\x7e\xa1-\xac\xae-\xff]+")
_PRINTED = re.compile("[\x20-\x7e\xa1-\xff\n]*")

# What the two vocabularies split texts by before merging.
_BYTE_LEVEL = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
_WORD_LEVEL = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


def byte_letters() -> dict[int, str]:
    """The character that stands for each byte: itself where it prints, else one from 256 on."""
    printing = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printing)]
    return {b: chr(b) for b in printing} | {b: chr(256 + i) for i, b in enumerate(others)}


class _Kept(dict):
    """A dictionary that makes what is missing.

    When it is full, its entries become the old generation and those still in
    use come back from there, so frequent pieces stay.
    """

    def __init__(self, make):
        super().__init__()
        self.make = make
        self.old = {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= LONGEST:
            if len(self) >= CACHED:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class _Closed(_Kept):
    """Pieces that end in one of ``marks`` after a letter are put together from both parts.

    So are, with ``line`` as the ids of a line feed, those that hold single line feeds: no
    token of the byte vocabulary crosses one that has no white space beside it. ``lines``
    looks up what follows them, by default these pieces themselves.
    """

    def __init__(self, make, marks: dict[str, bytes], line: bytes | None = None, lines: _Kept | None = None):
        super().__init__(make)
        self.marks, self.line = marks, line
        self.lines = self if lines is None else lines

    def __missing__(self, key):
        mark = self.marks.get(key[-1:])
        if mark is not None and key[:-1].isalpha():
            return self[key[:-1]] + mark
        if self.line is not None and "\n" in key:
            head, *rest = key.split("\n")
            if head and all(rest) and not any(a[-1].isspace() or b[0].isspace() for a, b in pairwise([head, *rest])):
                return self.line.join([self[head], *map(self.lines.__getitem__, rest)])
        return super().__missing__(key)


class Encoder:
    """Texts to little-endian unsigned 32-bit ids, as bytes."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.byte_level = spec["normalizer"] is None
        self.tokenize = self.tokenizer.model.tokenize
        self.letters = byte_letters()
        self.packed = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        marks = {m: self._library(m) for m in ".,;:!?)"}
        line = self._library("\n") if self.byte_level else None
        self.first = _Closed(self._piece, marks, line)
        self.later = _Closed(self._later, marks, line, self.first)

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        for content in self.special:
            if content in text:
                return self._library(text)
        if self.byte_level:
            return self._encode_bytes(text)
        if _ODD_SPACE.search(text):
            return self._library(text)
        return b"".join(map(self.first.__getitem__, text.split()))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """:meth:`encode` of each text. Of the word vocabulary each distinct word of them is looked up once."""
        if self.byte_level:
            return [self.encode(text) for text in texts]
        plain = [text if self._splits(text) else "" for text in texts]
        split = pc.ascii_split_whitespace(pa.array(plain, pa.large_string()))
        words = split.flatten().dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = pa.array(map(self.first.__getitem__, distinct), pa.large_binary()).take(words.indices)
        # The ids of a text lie one word after the other.
        places = np.frombuffer(ids.buffers()[1], np.int64)[: len(ids) + 1]
        cuts = places[split.offsets.to_numpy()].tolist()
        data = ids.buffers()[2].to_pybytes() if len(ids) else b""
        made = [data[a:b] for a, b in zip(cuts, cuts[1:])]
        return [found or self.encode(text) for found, text in zip(made, texts)]

    def _splits(self, text: str) -> bool:
        """Whether the ids of ``text`` are those of its words."""
        return not any(content in text for content in self.special) and not _ODD_SPACE.search(text)

    def _encode_bytes(self, text: str) -> bytes:
        # A space begins a token unless white space stands on both sides of it.
        if (
            "  " in text
            or "\n " in text
            or "\t " in text
            or "\r " in text
            or text[-1] == " "
            or _ODD_SPACE.search(text)
        ):
            return b"".join(map(self.first.__getitem__, _BEFORE_WORD.split(text)))
        head, *rest = text.split(" ")
        start = self.first[head] if head else b""
        return start + b"".join(map(self.later.__getitem__, rest))

    def _later(self, piece: str) -> bytes:
        if piece.isalpha() and len(piece) < 1000:
            if piece.isascii():
                return self._ids("\u0120" + piece)
            if max(piece) <= "\xff":
                return self._merge(" " + piece)
        return self._piece(" " + piece)

    def _piece(self, piece: str) -> bytes:
        if len(piece) > 1000:
            return self._library(piece)
        if self.byte_level:
            if not _PRINTED.fullmatch(piece):
                return self._library(piece)
            return b"".join(map(self._merge, _BYTE_LEVEL.findall(piece)))
        if piece.isalpha() and max(piece) <= "\xff":
            # One word of one kind of character; its capitals share the ids of the small letters.
            low = piece.lower()
            if low != piece:
                return self.first[low]
            return self._ids(low) if low.isascii() else self._merge(low)
        if not _PLAIN.fullmatch(piece):
            return self._library(piece)
        return b"".join(map(self._merge, _WORD_LEVEL.findall(piece.lower())))

    def _merge(self, word: str) -> bytes:
        letters = self.letters
        return self._ids("".join([letters[b] for b in word.encode()]))

    def _ids(self, word: str) -> bytes:
        packed = self.packed
        return b"".join([packed[t.id] for t in self.tokenize(word)])

    def _library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each file and Python process."""
    return Encoder(path)
