"""Strassen products and hard negatives against plain arithmetic."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditlake.llm import hard_negatives as op
from creditlake.llm.strassen import multiply


@pytest.mark.parametrize("shape", [(1, 1, 1), (16, 16, 16), (17, 33, 65), (64, 5, 70), (100, 64, 301), (3, 0, 4), (0, 8, 8)])
@pytest.mark.parametrize("leaf", [1, 2, 8])
def test_products(shape, leaf):
    rnd = np.random.default_rng(sum(shape))
    a, b = rnd.integers(-(2**20), 2**20, shape[:2]), rnd.integers(-(2**20), 2**20, shape[1:])
    assert (multiply(a, b, leaf) == a @ b).all()
    assert (multiply(a.astype(object), b.astype(object), leaf) == a @ b).all()


def test_entries_that_fit_are_exact_though_sums_wrap_on_the_way():
    a = np.full((4, 4), 2**61)
    b = np.array([[1, 1, 1, -1], [1, -1, 0, 1], [-1, 0, 0, 1], [-1, 0, 2, -1]])
    exact = a.astype(object) @ b.astype(object)
    assert max(abs(int(x)) for x in exact.ravel()) < 2**63
    assert (multiply(a, b, 1) == exact).all()


def brute(rows, positives=5, negatives=10, low=30, high=90, scale=256):
    def number(x):
        return int(x) * scale if abs(x) >= 2**53 else int(np.floor(x * scale))

    used = []
    for vec_id, label, vector in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        used.append((vec_id, label, tuple(map(number, vector))))
    found = []
    for a, label, v in sorted(set(r for r in used if r[0] % 3 == 0)):
        scored = [
            (-min(max(sum(x * y for x, y in zip(v, w)), -(2**63)), 2**63 - 1), i, m)
            for i, m, w in used if i != a and len(w) == len(v)
        ]
        for ps, p, _ in sorted(s for s in scored if s[2] == label)[:positives]:
            fits = sorted(s for s in scored if s[2] != label and low * -ps <= 100 * -s[0] <= high * -ps)[:negatives]
            found += [(a, p, k + 1, n, -ps, -ns) for k, (ns, n, _) in enumerate(fits)]
    return sorted(found)


def check(spark, rows, **options):
    df = spark.createDataFrame(
        [(*r, 1, 2, 3, 4) for r in rows],
        "vec_id bigint, label int, embedding array<double>, shard int, place int, vector int, asked int",
    )
    made = op.hard_negatives(df.repartition(3), F.col("vec_id") % 3 == 0, **options)
    assert made.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    expected = brute(rows)
    assert sorted(map(tuple, made.collect())) == expected
    return expected


def vectors(seed, n, size, labels, spread=1.0):
    rnd = random.Random(seed)
    return [(i, rnd.choice(labels), [rnd.choice([-1, 1, 1, 2]) * spread * rnd.choice([0.25, 0.5, 1]) for _ in range(size)]) for i in range(n)]


@pytest.mark.parametrize("tile, shard_bytes", [(4096, 64 << 20), (16, 900)])
def test_ties_one_frequent_label_and_many_shards(spark, tile, shard_bytes):
    rows = vectors(1, 240, 6, [0, 0, 0, 0, 1, 2])
    assert len(check(spark, rows, tile=tile, shard_bytes=shard_bytes)) > 1000


def test_odd_rows(spark):
    rows = [
        *vectors(2, 40, 4, [0, 1]),
        (3, 0, [1.0, 1.0, 1.0, 1.0]), (3, 0, [1.0, 1.0, 1.0, 1.0]), (5, 1, [0.5, 0.5, 0.5, 0.5]), (5, 1, [0.5, 0.5, 0.5, 0.5]),
        (None, 0, [1.0, 1.0, 1.0, 1.0]), (60, None, [1.0, 1.0, 1.0, 1.0]), (61, 1, None), (62, 1, [1.0, None, 1.0, 1.0]),
        (63, 1, [float("nan"), 1.0, 1.0, 1.0]), (64, 0, [float("inf"), 1.0, 1.0, 1.0]), (66, 0, []), (67, 0, []), (68, 1, []),
        (69, 1, [1.0, 2.0]), (70, 1, [1.0, 2.0]), (71, 0, [0.9, 1.0]), (-3, 1, [1.0, 1.0, 0.5, 1.0]),
    ]
    found = check(spark, rows)
    assert {69, 66, 3, -3} <= {f[0] for f in found}


def test_numbers_beyond_64_bits(spark):
    rows = vectors(3, 30, 3, [0, 1], spread=2.0**24) + vectors(4, 30, 3, [0, 1], spread=2.0**27)
    rows += vectors(5, 12, 3, [0, 1], spread=1e300)
    rows = [(i, label, v) for i, (_, label, v) in enumerate(rows)]
    check(spark, rows)


def test_long_vectors(spark):
    check(spark, vectors(6, 60, 3000, [0, 1]), tile=16)


def test_nothing(spark):
    check(spark, [])
    check(spark, [(0, 1, [1.0])])
