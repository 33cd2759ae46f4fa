"""Window packing: the plan on histograms, and whole results against the tokenizers library."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from creditlake.llm import queries
from creditlake.llm import window_packing as op

WORDS = public_tokenizers.path("word_bpe_49k.json")


def histograms():
    yield "nothing", {}
    yield "one length, no combination", {700: 101}
    yield "halves", {1024: 7, 1023: 9, 1: 30}
    yield "exact pairs", {1500: 40, 548: 40}
    yield "full windows and one token", {2048: 5, 1: 1}
    for seed in range(6):
        rnd = np.random.default_rng(seed)
        yield f"sparse {seed}", {int(n): int(rnd.integers(1, 500)) for n in rnd.integers(1, 2049, rnd.integers(2, 12))}
    for seed in range(3):
        lengths = np.minimum(np.exp(np.random.default_rng(seed).normal(6, 0.9, 30_000)).astype(int) + 1, 2048)
        yield f"dense {seed}", dict(zip(*map(np.ndarray.tolist, np.unique(lengths, return_counts=True))))


def laid(made, histogram):
    """``(sequence, offset, length)`` of all parts by a plan, piece by piece."""
    parts = []
    for n in np.flatnonzero(histogram).tolist():
        for rank in range(int(histogram[n])):
            if n == made.window:
                parts.append((rank, 0, n))
            elif rank >= made.rest[n]:
                first, begin, place = made.slots[n]
                k = int(np.searchsorted(first, rank, side="right")) - 1
                parts.append((int(begin[k]) + rank - int(first[k]), int(place[k]), n))
            else:
                row = dict(doc_id=0, start=0, length=n, ids_crc32=0, doc_tokens=n, rank=rank, ids=bytes(4 * n))
                parts += [(p["sequence_id"], p["offset"], p["length"]) for p in op._cut(made, row)]
    return parts


@pytest.mark.parametrize("name, counts", list(histograms()))
def test_every_window_is_full(name, counts):
    histogram = np.zeros(2049, np.int64)
    histogram[list(counts)] = list(counts.values())
    made = op.plan(histogram.copy(), 2048)
    held = defaultdict(list)
    for sequence, offset, n in laid(made, histogram):
        held[sequence].append((offset, n))
    total = int((histogram * np.arange(2049)).sum())
    assert sorted(held) == list(range(len(held)))
    sizes = []
    for rows in held.values():
        rows.sort()
        assert [o for o, _ in rows] == np.cumsum([0, *[n for _, n in rows[:-1]]]).tolist()
        sizes.append(sum(n for _, n in rows))
    assert sum(sizes) == total
    short = [s for s in sizes if s != 2048]
    assert all(s & (s - 1) == 0 for s in short) and len(set(short)) == len(short)
    if name == "exact pairs":
        assert not made.rest.any()
    if name.startswith("dense"):
        # Most sequences come from fitted combinations.
        assert sum(times for _, times in made.combinations) > 0.9 * (len(sizes) - histogram[2048])


def test_the_fit_is_a_least_squares_solution():
    rnd = np.random.default_rng(0)
    histogram = np.zeros(65, np.int64)
    histogram[1:64] = rnd.integers(0, 50, 63)
    found = op.combinations(histogram, 64)
    assert (found.sum(1) == 64).all()
    matrix = np.zeros((65, len(found)))
    for k, row in enumerate(found):
        np.add.at(matrix[:, k], row[row > 0], 1)
    counts = op.fit(found, histogram)
    assert (counts >= 0).all()
    # Optimality: the gradient is near zero where a count is not, and never points into the allowed region.
    gradient = matrix.T @ (matrix @ counts - histogram) / histogram.sum()
    assert gradient.min() > -0.02 and np.abs(gradient * counts).max() < 0.02 * histogram.max()


TOKENIZER = Tokenizer.from_file(WORDS)


def expected(text):
    return np.array([*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def check(docs, result, window=2048):
    rows = [r.asDict() for r in result.collect()]
    by_doc, held = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc, texts in docs.items():
        wanted = sorted((ids.tolist() for ids in map(expected, texts)))
        # Rows of one id are told apart by their parts: every part of every text appears as often as it should.
        pieces = sorted((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in by_doc[doc])
        assert sum(p[1] for p in pieces) == sum(map(len, wanted))
        for ids in wanted:
            at, data = 0, np.array(ids, "<u4")
            while at < len(ids):
                fits = [p for p in pieces if p[0] == at and p[3] == len(ids) and zlib.crc32(data[at : at + p[1]].tobytes()) == p[2]]
                assert fits
                pieces.remove(fits[0])
                at += fits[0][1]
        assert not pieces
    assert set(by_doc) == set(docs)
    for placed in held.values():
        placed.sort()
        ends = np.cumsum([n for _, n in placed]).tolist()
        assert [o for o, _ in placed] == [0, *ends[:-1]]
        assert ends[-1] == window or (ends[-1] < window and ends[-1] & (ends[-1] - 1) == 0)


@pytest.mark.parametrize("window", [2048, 64, 100])
def test_odd_rows(odd, odd_rows, window):
    docs = defaultdict(list)
    for doc, text in odd_rows:
        docs[doc].append(text)
    result = op.pack(odd, WORDS, 1, window)
    assert result.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    check(docs, result, window)


def test_nothing(nothing):
    assert op.pack(nothing, WORDS, 1).count() == 0


def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    result = queries.QUERIES["op11_window_packing"](spark, sf_dir)
    check({r["doc_id"]: [r["text"]] for r in rows}, result)
