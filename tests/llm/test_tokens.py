"""Token files, packing and byte-pair encoding against the tokenizers library."""

import random
import uuid
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from creditlake.llm import bpe, packing, token_files
from creditlake.llm.encoding import Encoder

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = [
    "a", "B", "é", "İ", "ß", " ", "  ", "\n", "\t", "\r", "\x0b", "\x1c", "\xa0", "　", "'s", "'", "'ll", "1", "²", "中",
    "😀", "<|endoftext|>", "<|startoftext|>", "-", "\xad", "\x85", "the", "Σ", "...", "re", "e", "Å",
]


def fuzz(seed, n=400, size=40):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, size))) for _ in range(n)]


def library(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_encoder_equals_the_library(path):
    mine, theirs = Encoder(path), Tokenizer.from_file(path)
    for text in fuzz(1) + ["word " * 500, "x" * 5000]:
        assert np.frombuffer(mine.encode(text), "<u4").tolist() == theirs.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("chunk, block", [(1 << 16, 1 << 10), (7, 1), (1, 1)])
def test_transducer_equals_the_library(monkeypatch, chunk, block):
    monkeypatch.setattr(bpe, "CHUNK", chunk)
    monkeypatch.setattr(bpe, "BLOCK", block)
    coder, theirs = bpe.Coder(BYTES), Tokenizer.from_file(BYTES)
    rnd = random.Random(4)
    runs = ["".join(rnd.choice("abcdthein") for _ in range(3000)), " " * 900 + "\n" * 90 + "b", "'" * 50 + "re"]
    for text in fuzz(2, 300) + runs:
        ids = theirs.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == ids
        decoder = bpe.Decoder(coder.merges)
        parts = [decoder.feed(ids[i : i + 1]) for i in range(len(ids))]
        assert "".join(parts) + decoder.close() == theirs.decode(ids, skip_special_tokens=False)


def test_what_the_transducer_holds_is_bounded():
    merges = bpe.Merges(BYTES)
    stream = bpe.WordStream(merges, merges.lookahead, lambda ids: None)
    for _ in range(200):
        stream.feed(b"thein" * 100)
        assert len(stream.held) <= 2 * merges.lookahead + bpe.BLOCK + 500


def test_documents_come_back(spark, odd, odd_rows, nothing):
    encoded = bpe.encode_documents(odd, BYTES)
    rows = Counter((r["doc_id"], tuple(r["ids"]), r["text"]) for r in bpe.decode_documents(encoded, BYTES).collect())
    assert rows == Counter((i, tuple(library(BYTES, t)), t or "") for i, t in odd_rows)
    assert bpe.decode_documents(bpe.encode_documents(nothing, BYTES), BYTES).count() == 0


@pytest.fixture()
def folder(spark):
    return f"{spark.conf.get('spark.checkpoint.dir')}/{uuid.uuid4().hex}"


def test_token_files_round_trip(spark, odd, odd_rows, folder, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_BYTES", 500)
    token_files.write_token_files(odd, folder, WORDS, 1)
    rows = token_files.read_token_files(spark, folder).collect()
    rows.sort(key=lambda r: r["start"])
    known = [r["doc_id"] for r in rows if r["doc_id"] is not None]
    assert known == sorted(known)
    assert [r["doc_id"] for r in rows][:2] == [None, None]
    total = 0
    for r in rows:
        assert r["start"] == total
        total += r["n_tokens"]
    ids = Counter((r["doc_id"], tuple(np.frombuffer(bytes(r["ids"]), "<u4").tolist())) for r in rows)
    assert ids == Counter((i, (*library(WORDS, t), 1)) for i, t in odd_rows)


def test_one_document_is_read_alone(spark, odd, odd_rows, folder):
    token_files.write_token_files(odd, folder, WORDS, 1)
    for doc in (4, 52, 999):
        want = sorted([*library(WORDS, t), 1] for i, t in odd_rows if i == doc)
        assert sorted(token_files.read_document(spark, folder, doc)) == want


def test_no_documents_no_segments(spark, nothing, folder):
    token_files.write_token_files(nothing, folder, WORDS, 1)
    assert token_files.read_token_files(spark, folder).count() == 0
    assert token_files.read_document(spark, folder, 1) == []


def check_packing(rows, capacity):
    for r in rows:
        assert 0 < r["length"] <= capacity
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing(odd, odd_rows, nothing):
    rows = packing.pack(odd, BYTES, 0, 256).collect()
    check_packing(rows, 256)
    want = Counter()
    for i, t in odd_rows:
        ids = np.array([*library(BYTES, t), 0], "<u4")
        for piece, (a, b) in enumerate(packing.cuts(len(ids), 256)):
            want[i, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    assert packing.pack(nothing, BYTES, 0).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_covers_the_histogram_and_is_nearly_full(seed):
    rnd = np.random.default_rng(seed)
    capacity = int(rnd.choice([16, 100, 2048]))
    histogram = np.zeros(capacity + 1, np.int64)
    for n in np.minimum(np.exp(rnd.normal(np.log(capacity / 4), 0.8, 3000)).astype(int) + 1, capacity):
        histogram[n] += 1
    slots = packing.plan(histogram.copy(), capacity)
    ranks, places = {}, {}
    for length, first, times, sequence, offset in slots:
        ranks.setdefault(length, []).extend(range(first, first + times))
        for i in range(times):
            places.setdefault(sequence + i, []).append((offset, length))
    assert {n: sorted(r) for n, r in ranks.items()} == {int(n): list(range(histogram[n])) for n in np.flatnonzero(histogram)}
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    least = -(-int((histogram * np.arange(capacity + 1)).sum()) // capacity)
    assert len(places) <= 1.02 * least + 2


def test_packing_of_hard_cases():
    for lengths in ([], [5], [9, 9, 9], [6, 6, 6, 4, 4, 4], [10] * 7, [1] * 23):
        histogram = np.bincount(lengths, minlength=11)
        slots = packing.plan(histogram, 10)
        assert sum(s[2] for s in slots) == len(lengths)
