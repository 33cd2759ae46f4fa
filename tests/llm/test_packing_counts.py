"""Numbers of sequences against plain best fit decreasing, piece by piece."""

import bisect

import numpy as np
import pytest

from creditlake.llm import packing


def best_fit_decreasing(histogram, capacity):
    spaces, sequences = [], 0
    for length in np.repeat(np.arange(capacity + 1), histogram)[::-1].tolist():
        at = bisect.bisect_left(spaces, length)
        if at == len(spaces):
            sequences += 1
            space = capacity
        else:
            space = spaces.pop(at)
        bisect.insort(spaces, space - length)
    return sequences


def histograms():
    yield "gaps", {1500: 100, 100: 500}
    yield "one length", {700: 101}
    yield "halves", {1024: 7, 1023: 9, 1: 30}
    for seed in range(8):
        rnd = np.random.default_rng(seed)
        yield f"sparse {seed}", {int(n): int(rnd.integers(1, 500)) for n in rnd.integers(1, 2048, rnd.integers(2, 12))}
    for seed in range(3):
        lengths = np.minimum(np.exp(np.random.default_rng(seed).normal(6.8, 0.3, 3000)).astype(int), 2048)
        yield f"skewed {seed}", dict(zip(*map(np.ndarray.tolist, np.unique(lengths, return_counts=True))))


@pytest.mark.parametrize("name, counts", list(histograms()))
def test_no_more_sequences_than_best_fit_decreasing(name, counts):
    histogram = np.zeros(2049, np.int64)
    histogram[list(counts)] = list(counts.values())
    slots = packing.plan(histogram.copy(), 2048)
    ranks, filled = {}, {}
    for length, first, times, sequence, offset in slots:
        ranks.setdefault(length, []).extend(range(first, first + times))
        for i in range(times):
            filled.setdefault(sequence + i, []).append((offset, length))
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(k)) for n, k in counts.items()}
    for held in filled.values():
        ends = np.cumsum([length for _, length in sorted(held)])
        assert [offset for offset, _ in sorted(held)] == [0, *ends[:-1].tolist()] and ends[-1] <= 2048
    assert len(filled) <= best_fit_decreasing(histogram, 2048)
    if name == "gaps":
        assert len(filled) == 100
