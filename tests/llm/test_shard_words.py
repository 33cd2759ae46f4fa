"""Eight characters of a shard at a time, in one step for all of a part."""

import numpy as np

from creditlake.llm.induced import AT_ONCE, _eights, _Least, _words


def test_words_end_at_their_bounds_and_at_the_end_of_the_text():
    rng = np.random.default_rng(1)
    text = rng.integers(0, 255, AT_ONCE + 50).astype(np.uint8)
    at = np.concatenate([np.arange(AT_ONCE + 50), [AT_ONCE + 50, AT_ONCE + 60]])
    bounds = np.minimum(at + rng.integers(-2, 12, len(at)), len(text))
    plain = []
    for begin, bound in zip(at.tolist(), bounds.tolist()):
        part = text[begin : max(begin, min(begin + 8, bound))].tolist()
        plain.append(int.from_bytes(bytes(part + [255] * (8 - len(part)))))
    assert _words(_eights(text), at, bounds).tolist() == plain


def test_least_of_intervals():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 201, 300).astype(np.uint8)
    begin = rng.integers(0, 300, 1000)
    end = np.minimum(begin + rng.integers(0, 300, 1000), 299)
    assert _Least(values).between(begin, end).tolist() == [values[a : b + 1].min() for a, b in zip(begin, end)]
