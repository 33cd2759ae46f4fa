"""Suffix trees and periodic runs against plain comparison of words."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from creditlake.llm import periodic_runs as op
from creditlake.llm import queries
from creditlake.llm.suffix_tree import SuffixTree


@pytest.mark.parametrize("seed", range(30))
def test_how_far_suffixes_agree(seed):
    rnd = random.Random(seed)
    text = [rnd.randint(1, rnd.choice([1, 2, 4, 30])) for _ in range(rnd.randint(2, 60))]
    tree = SuffixTree(text, max(text))
    n = len(text)
    pairs = [(a, b) for a in range(n + 1) for b in range(n + 1) if a != b]

    def common(a, b):
        k = 0
        while max(a, b) + k < n and text[a + k] == text[b + k]:
            k += 1
        return k

    a, b = map(np.array, zip(*pairs))
    assert tree.agree(a, b).tolist() == [common(x, y) for x, y in pairs]
    assert np.argsort(tree.rank).tolist() == sorted(range(n + 1), key=lambda i: text[i:])
    assert np.argsort(tree.falling_ranks()).tolist() == sorted(range(n + 1), key=lambda i: [-x for x in text[i:]])


def brute(words, least=24, exponent=3):
    n, found = len(words), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= least and length >= exponent * q:
                seen = words[i : i + length]
                if not any(seen[r:] == seen[:-r] for r in range(1, q)):
                    found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("seed", range(40))
def test_runs_of_random_words(seed):
    rnd = random.Random(seed)
    for _ in range(25):
        n, letters = rnd.randint(0, 120), rnd.choice([1, 2, 3, 6])
        words = [b"%d" % rnd.randint(0, letters) for _ in range(n)]
        if n and rnd.random() < 0.6:
            a = rnd.randrange(n)
            q = 1 + rnd.randrange((n - a) // 3 + 1)
            words = [words[i] if i < a else words[a + (i - a) % q] for i in range(n)]
        least, exponent = rnd.choice([3, 4, 7, 24]), rnd.choice([3, 3, 4])
        assert op.document_runs(words, least, exponent) == brute(words, least, exponent)


def test_runs_of_special_sequences():
    fibonacci, other = [b"a"], [b"a", b"b"]
    while len(other) < 600:
        fibonacci, other = other, other + fibonacci
    for words in (other, [b"x"] * 500, [b"x", b"y"] * 12, [b"x", b"y"] * 11 + [b"x"], [b"%d" % (i % 9) for i in range(400)]):
        assert op.document_runs(words) == brute(words)
    assert op.document_runs([b"a"] * 23) == [] and op.document_runs([b"a"] * 24) == [(0, 24, 1)]


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = brute(words) if len(words) < 3000 else op.document_runs([w.encode() for w in words])
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    covered = {i for s, n, q in runs for i in range(s + q, s + n)}

    def digest(made):
        return hashlib.sha256(made.encode()).hexdigest()

    return (
        doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)), digest(" ".join(w for i, w in enumerate(words) if i not in covered)),
    )


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    made = queries.QUERIES["op12_periodic_runs"](spark, sf_dir).collect()
    assert ordered(made) == ordered(expected(*r) for r in rows)
    assert sum(r["n_runs"] > 0 for r in made) >= 5


def test_odd_rows(spark, odd, odd_rows, tmp_path):
    extra = [(70, "a b c " * 20), (71, "x " * 24 + "y z " * 30), (72, "\x1c \xa0 \x85 " * 9), (80, "q " * 5), (81, None), (83, "s t u"), (None, "n " * 30)]
    more = odd.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id bigint, text string"))
    more.write.parquet(str(tmp_path / "documents.parquet"))
    made = queries.QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()
    assert ordered(made) == ordered(expected(*r) for r in [*odd_rows, *extra])
    rows = op.periodic_runs(odd).collect()
    assert len(rows) == len(odd_rows) and all(r["runs"] is not None and r["collapsed"] is not None for r in rows)


def test_nothing(nothing):
    assert op.periodic_runs(nothing).count() == 0
