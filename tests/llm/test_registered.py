"""The registered queries and the pipeline, digests included, against plain Python on a small folder."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer
from xxhash import xxh64_intdigest

import corpus_pipeline
from creditlake.llm import language, queries
from creditlake.llm.common import fold, table
from tests.llm.conftest import LONG, prose
from tests.llm.test_packing_counts import best_fit_decreasing
from tests.llm.test_text import brute_counts, kept_lines

BYTES = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
WORDS = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def folder(spark, sf_dir, tmp_path_factory):
    """Given documents, odd texts and planted copies, each with an id of its own."""
    path = tmp_path_factory.mktemp("documents")
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source").limit(120).collect()
    rows = [tuple(r) for r in given]
    shared = prose(500, 120)
    odd = [None, "", " \n\t ", LONG, "x", "äöü 漢字 😀\u0000", "aaaa" * 200, "same\nthree\nlines\nsame\nthree\nlines"]
    odd += [prose(1), prose(1), prose(1) + " end", prose(2), f"{prose(3)} {shared} tail", f"head {shared} {prose(4)}"]
    rows += [(10_000 + 3 * i, t, ["en", None][i % 2], ["s", None][i % 3 == 0]) for i, t in enumerate(odd)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    df.repartition(5).write.parquet(f"{path}/documents.parquet")
    return str(path), {r[0]: r[1] for r in rows}


def ran(spark, folder, number):
    (name,) = (n for n in queries.QUERIES if n.startswith(f"op{number}_"))
    return queries.QUERIES[name](spark, folder[0]).collect()


def ids(tokenizer, text, *end):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, *end]


def crc(numbers):
    return zlib.crc32(np.array(numbers, "<u4").tobytes())


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def test_op1(spark, folder):
    start, want = 0, set()
    for doc, text in sorted(folder[1].items()):
        found = ids(WORDS, text, 1)
        want.add((doc, start, len(found), crc(found)))
        start += len(found)
    assert {(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in ran(spark, folder, 1)} == want


def packed(rows, texts, capacity=2048):
    """Holds pieces of byte-level ids against the texts."""
    by_doc, held = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_doc) == set(texts)
    histogram = np.zeros(capacity + 1, np.int64)
    for doc, text in texts.items():
        found, at = ids(BYTES, text, 0), 0
        for k, r in enumerate(sorted(by_doc[doc], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (k, at)
            assert r["ids_crc32"] == crc(found[at : at + r["length"]])
            assert r["length"] == capacity or k == 0
            histogram[r["length"]] += 1
            at += r["length"]
        assert at == len(found)
    for pieces in held.values():
        pieces.sort()
        ends = np.cumsum([n for _, n in pieces]).tolist()
        assert [o for o, _ in pieces] == [0, *ends[:-1]] and ends[-1] <= capacity
    assert len(held) <= best_fit_decreasing(histogram, capacity)


def test_op8(spark, folder):
    packed(ran(spark, folder, 8), folder[1])


def test_op9(spark, folder):
    want = set()
    for doc, text in folder[1].items():
        found = ids(BYTES, text)
        want.add((doc, len(found), sha(",".join(map(str, found))), sha(BYTES.decode(found, skip_special_tokens=False))))
    assert {tuple(r[c] for c in ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")) for r in ran(spark, folder, 9)} == want


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    if not words:
        return 0
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(texts):
    """The smallest id that each document reaches by links of two bits or fewer."""
    prints = {doc: fingerprint(text) for doc, text in texts.items()}
    root = {doc: doc for doc in texts}
    for a in sorted(texts):
        for b in sorted(texts):
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2 and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {d: low if r == high else r for d, r in root.items()}
    return prints, root


def test_op5(spark, folder):
    prints, root = groups(folder[1])
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in ran(spark, folder, 5)}
    assert got == {d: (f"{prints[d]:016x}", root[d]) for d in folder[1]}


def without_strings(texts, size=200):
    """Each text's remaining bytes, removed bytes and spans."""
    data = {doc: (text or "").encode() for doc, text in texts.items()}
    seen = Counter(d[i : i + size] for d in data.values() for i in range(len(d) - size + 1))
    out = {}
    for doc, d in data.items():
        gone = np.zeros(len(d) + 1, np.int64)
        for i in range(len(d) - size + 1):
            if seen[d[i : i + size]] > 1:
                gone[i] += 1
                gone[i + size] -= 1
        covered = gone.cumsum()[: len(d)] > 0
        spans = int((np.diff(covered.astype(int), prepend=0) == 1).sum())
        out[doc] = bytes(b for b, c in zip(d, covered) if not c), int(covered.sum()), spans
    return out


def test_op4(spark, folder):
    want = {(d, len((folder[1][d] or "").encode()), n, s, sha(left)) for d, (left, n, s) in without_strings(folder[1]).items()}
    got = {tuple(r[c] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) for r in ran(spark, folder, 4)}
    assert got == want
    assert sum(w[2] > 0 for w in want) >= 3


def test_op3(spark, folder):
    rows = {r["doc_id"]: r for r in ran(spark, folder, 3)}
    assert set(rows) == set(folder[1])
    for doc, text in folder[1].items():
        r, want = rows[doc], brute_counts(text)
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        assert tuple(r[n] for n in names) == tuple(want[: len(names)]), doc
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_op10(spark, folder):
    docs = table(spark, folder[0], "documents")
    model = language.train(language.sample(docs, fold("doc_id") != 0))
    rows = {r["doc_id"]: r for r in ran(spark, folder, 10)}
    assert set(rows) == set(folder[1])
    for doc, text in folder[1].items():
        r = rows[doc]
        assert r["held_out"] == (zlib.crc32(str(doc).encode()) % 5 == 0)
        words = language.words(text)
        if not words:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        parts = [b for w in words for b in language.subwords(w)]
        logits = (model.table[parts].sum(0) / len(parts) + model.bias) / model.temperature
        shares = np.exp(logits - logits.max()) / np.exp(logits - logits.max()).sum()
        assert r["lang_pred"] == model.labels[int(shares.argmax())]
        assert r["score"] == pytest.approx(float(shares.max()), abs=1e-6)


def test_op6(spark, folder):
    counts, docs = Counter(), {}
    for doc, text in folder[1].items():
        docs[doc] = [*re.findall(r"[^\x20\x09-\x0D]+", lowered(text)), "\n"]
        if zlib.crc32(str(doc).encode()) % 5 != 1:
            counts.update(docs[doc])
    total, kinds = sum(counts.values()), len(counts)
    for r in ran(spark, folder, 6):
        words = docs.pop(r["doc_id"])
        base = sum(np.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in words)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words), sum(counts[w] > 0 for w in words), total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] < 0
    assert not docs


def test_pipeline(spark, folder):
    """All stages but the first by plain Python, from the documents that the first keeps."""
    docs = table(spark, folder[0], "documents")
    kept = {r["doc_id"]: r["text"] for r in corpus_pipeline.identify_language(spark, docs, folder[0]).collect()}
    assert kept.items() <= folder[1].items() and len(kept) > 100
    texts = dict(kept_lines(list(kept.items())))
    root = groups(texts)[1]
    texts = {d: t for d, t in texts.items() if root[d] == d}
    texts = {d: left.decode("utf-8", "ignore") for d, (left, _, _) in without_strings(texts).items()}
    packed(corpus_pipeline.run(spark, folder[0]).collect(), texts)
