"""Line dedup, quality rules, suffix dedup and SimHash against plain Python."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from creditlake.llm import components, induced, line_dedup, quality_rules, simhash, suffix_dedup
from tests.llm.conftest import prose


def kept_lines(rows):
    """Rows without later repeats of three-line windows, in the operator's order of places."""
    first, result = {}, []
    docs = sorted({(i, t) for i, t in rows if i is not None and t is not None})
    by_hash = {}
    for i, t in docs:
        by_hash.setdefault(i, []).append(t)
    for i, t in docs:
        lines = t.split("\n")
        for k in range(len(lines) - 2):
            window = tuple(lines[k : k + 3])
            if any(x.strip(" \t\n\r\x0b\x0c") for x in window):
                first.setdefault(window, []).append((i, t, k))
    gone = {}
    for places in first.values():
        for i, t, k in sorted(places)[1:]:
            gone.setdefault((i, t), set()).update((k, k + 1, k + 2))
    for i, t in rows:
        cut = gone.get((i, t), set())
        result.append((i, t if not cut else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in cut)))
    return result


def test_line_dedup(odd, odd_rows, nothing):
    out = line_dedup.dedup_lines(odd)
    assert out.columns == odd.columns
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == Counter(kept_lines(odd_rows))
    assert line_dedup.dedup_lines(nothing).count() == 0


def test_line_dedup_of_a_hot_window(spark, monkeypatch):
    rows = [(i, f"a\nb\nc\n{i}") for i in range(300)] + [(1000 + i, f"x\n{i % 5}\nz\n{i}") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for share in (0.001, 0.5, 2.0):
        monkeypatch.setattr(line_dedup, "HOT_SHARE", share)
        assert Counter(map(tuple, line_dedup.dedup_lines(df).collect())) == Counter(kept_lines(rows))


def brute_counts(text):
    text = text or ""
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text)]
    lines = [x for x in text.split("\n") if x.strip(" \t\n\r\x0b\x0c")]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + d for i, w in enumerate(windows) if often[w] > 1 for d in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_counts(odd, odd_rows, nothing):
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    rows = quality_rules.judge(odd).collect()
    got = Counter((r["doc_id"], *(r[c] for c in columns), r["base_failed"]) for r in rows)
    want = Counter()
    for i, t in odd_rows:
        c = brute_counts(t)
        want[i, *c, c[0] < 50 or 100 * c[4] > 50 * c[0]] += 1
    assert got == want
    assert all(not r["kept"] for r in rows if r["base_failed"])
    assert quality_rules.judge(nothing).count() == 0


def test_junk_is_rejected_and_prose_kept(spark):
    rnd = random.Random(5)
    rows = [(i, prose(i, rnd.randint(60, 300)), "en", f"s{i % 2}") for i in range(400)]
    junk = [(1000 + i, " ".join(w + "$$$" for w in prose(i).split()), "en", "s0") for i in range(60)]
    df = spark.createDataFrame(rows + junk, "doc_id bigint, text string, lang string, source string")
    kept = {r["doc_id"] for r in quality_rules.judge(df).filter("kept").collect()}
    assert not kept & {i for i, *_ in junk}
    assert len(kept) > 390


def test_small_groups_are_judged_together(spark):
    rows = [(i, prose(i), "en", f"s{i}") for i in range(60)] + [(100 + i, prose(i), f"l{i}", "s") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    judged = {r["doc_id"]: r for r in quality_rules.judge(df).collect()}
    assert all(judged[i]["distance"] is not None for i in range(60))
    assert all(judged[100 + i]["distance"] is None and judged[100 + i]["kept"] for i in range(5))


def test_estimate_resists_outliers(spark):
    rnd = np.random.default_rng(2)
    clean = rnd.normal(0, 1, (2000, 5)) @ np.diag([1, 0.5, 0.3, 0.2, 0.4]) + 3
    dirty = rnd.normal(40, 1, (400, 5))
    rows = [(*map(float, x), i % quality_rules.SPREAD) for i, x in enumerate(np.vstack([clean, dirty]))]
    df = spark.createDataFrame(rows, ", ".join(f"x{i} double" for i in range(5)) + ", salt int")
    df = df.selectExpr("named_struct('level', 0, 'language', '', 'origin', '') AS kin", "*")
    found = quality_rules._estimate(df).first()
    assert np.allclose([found[f"m{i}"] for i in range(5)], clean.mean(0), atol=0.15)


def brute_spans(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    result = []
    for b in data:
        spans = []
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + length
                else:
                    spans.append([i, i + length])
        result.append(spans)
    return result


@pytest.mark.parametrize("crowd, shard, block", [(30_000, 4 << 20, 1 << 19), (0, 4 << 20, 1 << 19), (30_000, 1_000, 3_000)])
def test_suffix_dedup(odd, odd_rows, monkeypatch, crowd, shard, block):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", shard)
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)
    rows = suffix_dedup.remove_repeats(odd).collect()
    want = Counter()
    for (i, t), spans in zip(odd_rows, brute_spans([t for _, t in odd_rows], suffix_dedup.LENGTH)):
        data, kept, at = (t or "").encode(), b"", 0
        for a, b in spans:
            kept, at = kept + data[at:a], b
        kept += data[at:]
        want[i, len(data), tuple(map(tuple, spans)), hashlib.sha256(kept).hexdigest()] += 1
    got = Counter(
        (r["doc_id"], r["n_bytes"], tuple((s["begin"], s["end"]) for s in r["spans"] or ()), hashlib.sha256(bytes(r["kept"])).hexdigest())
        for r in rows
    )
    assert got == want


def test_suffix_dedup_keeps_columns(odd, nothing):
    out = suffix_dedup.dedup_strings(odd)
    assert out.columns == odd.columns
    assert out.count() == odd.count()
    assert out.filter("text IS NULL").count() == odd.filter("text IS NULL").count()
    assert suffix_dedup.dedup_strings(nothing).count() == 0


@pytest.mark.parametrize("limit, in_memory", [(10**6, 10**6), (5, 10**6), (7, 3)])
def test_induced_order_and_prefixes(limit, in_memory):
    rnd = np.random.default_rng(limit + in_memory)
    for _ in range(60):
        depth = int(rnd.choice([1, 3, 8, 60, 200]))
        text = rnd.integers(1, rnd.integers(2, 6), int(rnd.integers(1, 120)))
        if rnd.random() < 0.4:
            text = np.concatenate([np.tile(text[:9], 5), text, text[: len(text) // 2]])
        full = [*text.tolist(), 0]
        places, shared = induced.suffix_array(text, depth, limit, in_memory)
        assert sorted(places.tolist()) == list(range(len(full)))
        keys = [tuple(full[i : i + depth]) for i in places]
        assert keys == sorted(keys)
        for before, after, n in zip(keys, keys[1:], shared[1:]):
            same = next((k for k, (x, y) in enumerate(zip(before, after)) if x != y), min(len(before), len(after)))
            assert n == same


def test_a_queue_comes_back_from_disk_in_order():
    queue = induced.TupleQueue(limit=3)
    for k in range(5):
        queue.push(k % 2, np.arange(k, k + 4), np.full(4, k, np.uint8))
    assert queue.file is not None
    got = np.concatenate([p for p, _ in queue.pop(0)])
    assert got.tolist() == [*range(0, 4), *range(2, 6), *range(4, 8)]
    queue.close()


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = __import__("re").findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates(odd, odd_rows, nothing):
    rows = simhash.near_duplicates(odd).collect()
    prints = [plain_fingerprint(t) for _, t in odd_rows]
    parent = list(range(len(odd_rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(odd_rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    want = Counter((doc, prints[i], least.get(root(i))) for i, (doc, _) in enumerate(odd_rows))
    assert Counter((r["doc_id"], r["fingerprint"] % (1 << 64), r["component_id"]) for r in rows) == want
    assert simhash.near_duplicates(nothing).count() == 0


def test_one_of_each_group_stays(odd, nothing):
    out = simhash.keep_first(odd)
    assert out.columns == odd.columns
    groups = {r["component_id"] for r in simhash.near_duplicates(odd.filter("doc_id IS NOT NULL")).collect()}
    ids = [r["doc_id"] for r in out.filter("doc_id IS NOT NULL").collect()]
    # Another text of an id stays beside it, in its own group.
    assert set(ids) == groups and sorted(ids) == sorted([*groups, 4])
    assert out.filter("doc_id IS NULL").count() == odd.filter("doc_id IS NULL").count()
    assert simhash.keep_first(nothing).count() == 0


@pytest.mark.parametrize("crowd", [32, 3, 0])
def test_no_link_is_lost_in_a_crowd(spark, crowd):
    rnd = random.Random(crowd)
    prints = {rnd.getrandbits(64) for _ in range(30)}
    for base in list(prints)[:3]:
        for _ in range(60):
            x = base
            for _ in range(rnd.randint(1, 5)):
                x ^= 1 << rnd.choice([rnd.randrange(64), rnd.randrange(21)])
            prints.add(x)
    signed = [x - (x >> 63 << 64) for x in prints]
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    found = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp bigint"), crowd).collect()
    assert {(min(r["a"], r["b"]), max(r["a"], r["b"])) for r in found} == want


def test_components(spark):
    pairs = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (5, 4)]
    found = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert found == {i: 0 for i in range(41)} | {k: 100 for k in range(100, 130)}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
