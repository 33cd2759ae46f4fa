"""Byte-pair encoding as a streaming transducer, and decoding as a state machine.

The encoder takes a text in chunks of any size. It splits it into words by
character classes, and merges the bytes of a word while they arrive: how far
unseen bytes can change tokens to their left follows from the merge list alone
(see :func:`lookahead`), so a token that ends further from the edge is stable
and leaves. What is held back is bounded by that number and not by the text.

The decoder turns ids into text as they come; the bytes of an unfinished
character wait for the next id, and bytes that are no UTF-8 become U+FFFD, as
in the tokenizers library.

Missing texts are empty ones: no ids, and the empty text back. Rows without
``doc_id``, repeated rows and empty tables need no care, since every row is
worked on alone. Other columns are left out, whatever their names.
"""

from __future__ import annotations

import codecs
import heapq
import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlake.llm.common import SLICE
from creditlake.llm.encoding import byte_letters

# Words kept with their ids, and the longest of them in characters.
CACHED = 300_000
LONGEST = 48

# Characters that are fed to the splitter at a time, and bytes of one word to the merger.
CHUNK = 1 << 12
BLOCK = 1 << 10

# Fixed value: how the vocabulary's texts are split before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_WORDS = regex.compile(SPLIT)
_KINDS = [regex.compile(p) for p in (r"\p{L}+", r"\p{N}+", r"[^\s\p{L}\p{N}]+")]
_SPACE = regex.compile(r"\s+")


class Merges:
    """The merge list of a vocabulary file: ranks of pairs of ids, bytes of ids, special contents."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        back = {c: b for b, c in byte_letters().items()}
        vocabulary = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes = {i: bytes([back[c] for c in text]) for text, i in vocabulary.items()}
        self.bytes |= {i: text.encode() for text, i in self.special.items()}
        self.single = [vocabulary[c] for _, c in sorted(byte_letters().items())]
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            self.pairs[vocabulary[a], vocabulary[b]] = (rank, vocabulary[a + b])

    @property
    def lookahead(self) -> int:
        """Bytes to the left of an edge that unseen bytes can still change.

        Suppose two runs see the same bytes but for what follows the edge. They
        differ first by a merge ``(p, q)`` across the edge, which takes ``p``;
        the difference then moves left only by a merge ``(p', q')`` of a later
        rank whose ``q'`` begins with what now stands at the border, so ``p``
        is on the left spine of ``q'``. The longest such chain of rising ranks,
        in bytes of the left parts, is found in one pass over the merges.
        """
        reach: dict[int, int] = {}
        left: dict[int, int] = {}
        longest = 0
        for (p, q), (_, made) in self.pairs.items():
            before, node = 0, q
            while node is not None:
                before = max(before, reach.get(node, 0))
                node = left.get(node)
            far = before + len(self.bytes[p])
            reach[p] = max(reach.get(p, 0), far)
            left.setdefault(made, p)
            longest = max(longest, far)
        return longest


def merge(merges: Merges, data: bytes) -> list[int]:
    """The ids of one word: the pair of lowest rank first, leftmost among equals."""
    ids = [merges.single[b] for b in data]
    if len(ids) > 64:
        return _merge_long(merges, ids)
    pairs = merges.pairs
    while len(ids) > 1:
        best, at = None, -1
        for i in range(len(ids) - 1):
            found = pairs.get((ids[i], ids[i + 1]))
            if found is not None and (best is None or found[0] < best[0]):
                best, at = found, i
        if best is None:
            break
        ids[at : at + 2] = [best[1]]
    return ids


def _merge_long(merges: Merges, ids: list[int]) -> list[int]:
    """The same with a queue of pairs, for words of many bytes."""
    pairs, n = merges.pairs, len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    queue = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n and (found := pairs.get((ids[i], ids[j]))) is not None:
            heapq.heappush(queue, (found[0], i, ids[i], ids[j], found[1]))

    for i in range(n - 1):
        offer(i)
    while queue:
        _, i, a, b, made = heapq.heappop(queue)
        j = after[i]
        if ids[i] != a or j >= n or ids[j] != b:
            continue
        ids[i], ids[j] = made, -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [i for i in ids if i >= 0]


class WordStream:
    """Merges one word while its bytes arrive; ``out`` gets ids once they are stable."""

    def __init__(self, merges: Merges, lookahead: int, out: Callable[[list[int]], None]):
        self.merges, self.lookahead, self.out = merges, lookahead, out
        self.held = b""

    def feed(self, data: bytes) -> None:
        self.held += data
        # The start is a token's start whatever comes, so only the end is open.
        while len(self.held) > 2 * self.lookahead + BLOCK:
            window = self.held[: 2 * self.lookahead + BLOCK]
            ids, end, stable = merge(self.merges, window), 0, len(window) - self.lookahead
            done = []
            for i in ids:
                end += len(self.merges.bytes[i])
                if end > stable:
                    end -= len(self.merges.bytes[i])
                    break
                done.append(i)
            self.out(done)
            self.held = self.held[end:]

    def close(self) -> None:
        if self.held:
            self.out(merge(self.merges, self.held))
        self.held = b""


class Transducer:
    """Texts in, ids out, word by word: ``feed`` chunks, then ``close``.

    ``words`` gets every finished short word as a string; ``out`` gets the ids
    of words that are too long to wait for.
    """

    def __init__(self, merges: Merges, lookahead: int, words, out):
        self.merges, self.words = merges, words
        self.stream = WordStream(merges, lookahead, out)
        self.held = ""
        # The class of the word that is streaming, if one is.
        self.open: regex.Pattern | None = None

    def feed(self, chunk: str) -> None:
        self.held += chunk
        self._run(False)

    def close(self) -> None:
        self._run(True)

    def _run(self, last: bool) -> None:
        text, at = self.held, 0
        if self.open is not None:
            at = self._go_on(text, last)
            if self.open is not None:
                self.held = text[at:]
                return
        if not last:
            # All words end before the last space that begins one.
            edge = text.rfind(" ")
            while edge > at and (edge + 1 >= len(text) or text[edge + 1].isspace()):
                edge = text.rfind(" ", at, edge)
            if edge > at:
                self.words(_WORDS.findall(text[at:edge]))
                at = edge
            if len(text) - at > CHUNK:
                at = self._open(text, at)
            self.held = text[at:]
            return
        if at < len(text):
            self.words(_WORDS.findall(text[at:] if at else text))
        self.held = ""

    def _open(self, text: str, at: int) -> int:
        """Words of a long stretch without cuts; the last one starts to stream."""
        for match in _WORDS.finditer(text, at):
            if match.end() < len(text) - 3:
                self.words([match.group()])
                at = match.end()
                continue
            word = match.group()
            if word[0] == "'" and len(word) < 4:
                # Perhaps the start of a contraction.
                return at
            body = word[1:] if word[0] == " " else word
            for kind in _KINDS:
                if kind.fullmatch(body):
                    self.open = kind
                    self.stream.feed(word.encode())
                    return match.end()
            if len(word) > 1 and _SPACE.fullmatch(word):
                self.open = _SPACE
                self.stream.feed(word[:-1].encode())
                return match.end() - 1
            return at
        return at

    def _go_on(self, text: str, last: bool) -> int:
        match = self.open.match(text)
        end = match.end() if match else 0
        if self.open is _SPACE:
            # The last space of a run begins the next word, unless the text ends.
            if end == len(text):
                if last:
                    self.stream.feed(text.encode())
                    self._end()
                    return end
                self.stream.feed(text[: end - 1].encode())
                return max(0, end - 1)
            self.stream.feed(text[: end - 1].encode())
            self._end()
            return end - 1
        self.stream.feed(text[:end].encode())
        if end < len(text) or last:
            self._end()
        return end

    def _end(self) -> None:
        self.stream.close()
        self.open = None



class Coder:
    """Whole texts to ids through the transducer.

    The ids of words that have left it lately are kept, so that it merges each of
    these once. ``streamed`` counts the bytes that went through the merger.
    """

    def __init__(self, path: str):
        self.merges = Merges(path)
        self.lookahead = self.merges.lookahead
        self.kept: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.streamed = 0
        self.ids: list[int] = []
        self.merger = WordStream(self.merges, self.lookahead, self.ids.extend)
        contents = sorted(self.merges.special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, contents))) if contents else None

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a text."""
        out: list[bytes] = []
        at = 0
        for found in self.special.finditer(text) if self.special else ():
            self._plain(text, at, found.start(), out)
            out.append(_packed([self.merges.special[found.group()]]))
            at = found.end()
        self._plain(text, at, len(text), out)
        return b"".join(out)

    def _plain(self, text: str, begin: int, end: int, out: list[bytes]) -> None:
        def words(found: list[str]) -> None:
            out.extend(map(self._word, found))

        stream = Transducer(self.merges, self.lookahead, words, lambda ids: out.append(_packed(ids)))
        for at in range(begin, end, CHUNK):
            stream.feed(text[at : min(at + CHUNK, end)])
        stream.close()

    def _word(self, word: str) -> bytes:
        ids = self.kept.get(word)
        if ids is None:
            ids = self.old.get(word) or self._streamed(word.encode())
            if len(word) <= LONGEST:
                if len(self.kept) >= CACHED:
                    self.old, self.kept = self.kept, {}
                self.kept[word] = ids
        return ids


    def _streamed(self, data: bytes) -> bytes:
        """The ids of a whole word, as they leave the merger."""
        self.streamed += len(data)
        self.ids.clear()
        for at in range(0, len(data), BLOCK):
            self.merger.feed(data[at : at + BLOCK])
        self.merger.close()
        return _packed(self.ids)


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


class Decoder:
    """Ids to text, a few at a time; special tokens give their content."""

    def __init__(self, merges: Merges):
        self.bytes = [merges.bytes[i] for i in range(len(merges.bytes))]
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int]) -> str:
        table = self.bytes
        return self.state.decode(b"".join([table[i] for i in ids]))

    def close(self) -> str:
        rest = self.state.decode(b"", final=True)
        self.state.reset()
        return rest


@lru_cache(maxsize=1)
def _coder(path: str) -> Coder:
    return Coder(path)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every row of ``docs`` (``doc_id``, ``text``)."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _coder(path).encode
        for batch in batches:
            for begin in range(0, batch.num_rows, SLICE):
                part = batch.slice(begin, SLICE)
                packed = [encode(text) for text in part.column(1).to_pylist()]
                values = pa.array(np.frombuffer(b"".join(packed), "<i4"))
                offsets = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])])
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
                yield pa.RecordBatch.from_arrays([part.column(0), ids], ["doc_id", "ids"])

    return rows.mapInArrow(run, "doc_id bigint, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``ids`` and the ``text`` they stand for, of every row of ``encoded``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(_coder(path).merges)
        for batch in batches:
            for begin in range(0, batch.num_rows, SLICE):
                part = batch.slice(begin, SLICE)
                texts = []
                for ids in part.column(1):
                    values = ids.values.to_numpy()
                    text = [decoder.feed(values[at : at + CHUNK].tolist()) for at in range(0, len(values), CHUNK)]
                    texts.append("".join([*text, decoder.close()]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string())], ["doc_id", "ids", "text"]
                )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids array<int>, text string")
