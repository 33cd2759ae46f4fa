"""Top-k search, language ID, the recurrent model and the pipeline."""

from collections import Counter
from math import floor, isfinite, log10

import numpy as np
import pytest

import corpus_pipeline
from creditlake.llm import language, lm_scoring, recurrent, topk
from creditlake.llm.common import fold
from pyspark.sql import functions as F
from tests.llm.conftest import prose


def best_of(rows, k):
    whole = [(i, [floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and isfinite(x) for x in v)]
    queries = {(i, tuple(v)) for i, v in whole if i % 3 == 0}
    result = Counter()
    for i, q in queries:
        exact = [(sum(a * b for a, b in zip(q, v)), j) for j, v in whole if j != i and len(v) == len(q)]
        scores = sorted((-max(min(score, 2**63 - 1), -(2**63)), j) for score, j in exact)
        for rank, (score, j) in enumerate(scores[:k], 1):
            result[i, rank, j, -score] += 1
    return result


@pytest.mark.parametrize("tile, block, size", [(4096, 512, 64 << 20), (3, 2, 64), (2, 1, 400)])
def test_top_k(spark, monkeypatch, tile, block, size):
    monkeypatch.setattr(topk, "TILE", tile)
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "SHARD_BYTES", size)
    rnd = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rnd.integers(-2, 3, 3) / 7]) for i in range(40)]
    rows += [(6, [1.0, 0.5, 0.25]), (6, [1.0, 0.5, 0.25]), (7, [1e12, -1e12, 3.0]), (9, [1e15, 1e14, 0.0]), (41, None), (None, [1.0, 1.0, 1.0])]
    rows += [(42, [1.0, None, 0.0]), (45, [float("nan"), 0.0, 0.0]), (48, [float("inf"), 0.0, 0.0]), (51, [1.0]), (54, [2.0]), (57, [])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id bigint, embedding array<double>, shard int, kind int").repartition(3)
    got = Counter(map(tuple, topk.top_k(df, F.col("vec_id") % 3 == 0, 4).collect()))
    assert got == best_of(rows, 4)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 3 == 0).count() == 0


def spoken(n):
    import random

    rnd = random.Random(n)
    kinds = {"en": ["the", "of", "and", "th", "ing"], "de": ["der", "und", "sch", "ei", "ich"], "fr": ["le", "que", "eau", "oi", "ç"]}
    rows = []
    for i in range(n):
        lang = rnd.choice(sorted(kinds))
        words = ["".join(rnd.choice(kinds[lang]) for _ in range(rnd.randint(1, 3))) for _ in range(rnd.randint(3, 60))]
        rows.append((i, " ".join(words), lang))
    return rows


def test_language_on_held_out_documents(spark):
    df = spark.createDataFrame(spoken(600), "doc_id bigint, text string, lang string")
    found = language.identify(df, fold("doc_id") != 0).join(df, "doc_id").filter(fold("doc_id") == 0).collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in found]) > 0.98
    assert np.mean([r["rejected"] for r in found]) < 0.02


def test_language_of_odd_rows(odd, odd_rows, nothing):
    rows = language.identify(odd, fold("doc_id") != 0).collect()
    assert len(rows) == len(odd_rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    unknown = {r["doc_id"] for r in rows if r["lang_pred"] == language.UNKNOWN}
    assert unknown == {None, 51, 52, 53}
    assert {r["lang_pred"] for r in rows} <= {"en", "de", language.UNKNOWN}
    assert language.identify(nothing, fold("doc_id") != 0).count() == 0
    kept = language.keep_identified(odd, fold("doc_id") != 0)
    assert kept.columns == odd.columns
    assert not {51, 52, 53} & {r["doc_id"] for r in kept.collect()}


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "words", None), (2, None, "en")], "doc_id bigint, text string, lang string")
    assert {r["lang_pred"] for r in language.identify(df, F.lit(True)).collect()} == {language.UNKNOWN}


def test_gradients(monkeypatch):
    rnd = np.random.default_rng(0)
    p = recurrent.start(np.arange(100, 1, -1)[:90].astype(float), 50.0)
    p = {k: v.astype(float) + (rnd.normal(0, 0.2, v.shape) if k != "word_bias" else 0) for k, v in p.items()}
    docs = [rnd.integers(0, 91, n) for n in (5, 9, 3, 12)]
    ids, owner = recurrent.streams(docs, 2)
    previous, fresh = recurrent._previous(ids, owner, 0, len(ids))
    monkeypatch.setattr(recurrent.np, "float32", np.float64)
    g = recurrent.backward(p, previous, fresh, ids, np.zeros((ids.shape[1], recurrent.HIDDEN)))[0]
    for name in p:
        for place in {tuple(rnd.integers(0, s) for s in p[name].shape) for _ in range(4)} | {(0,) * p[name].ndim}:
            losses = []
            for step in (1e-5, -1e-5):
                q = {k: v.copy() for k, v in p.items()}
                q[name][place] += step
                losses.append(-recurrent.score(q, docs, 2).sum())
            assert g[name][place] == pytest.approx((losses[0] - losses[1]) / 2e-5, abs=1e-6)


def test_score_does_not_depend_on_windows_or_streams():
    rnd = np.random.default_rng(1)
    p = recurrent.start(np.arange(70, 0, -1).astype(float), 9.0)
    p = {k: (v + rnd.normal(0, 0.1, v.shape)).astype(np.float32) for k, v in p.items()}
    docs = [rnd.integers(0, 71, n) for n in (1, 40, 7, 300, 2, 2)]
    scores = [recurrent.score(p, docs, n, w) for n, w in ((512, 64), (1, 3), (4, 1000))]
    alone = np.array([recurrent.score(p, [d])[0] for d in docs])
    for s in scores:
        assert np.allclose(s, alone, rtol=1e-4)


def test_next_tokens_sum_to_one():
    p = recurrent.start(np.arange(70, 0, -1).astype(float), 9.0)
    head = [3, 70, 5]
    total = sum(np.exp(recurrent.score(p, [np.array([*head, k])])[0] - recurrent.score(p, [np.array(head)])[0]) for k in range(71))
    assert total == pytest.approx(1, abs=1e-4)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def tokens(text):
    return [*__import__("re").findall(r"[^\x20\x09-\x0D]+", lower(text)), "\n"]


@pytest.mark.parametrize("head, own", [(131_072, 1_024), (20, 8)])
def test_lm_scores(odd, odd_rows, monkeypatch, head, own):
    monkeypatch.setattr(lm_scoring, "HEAD", head)
    monkeypatch.setattr(lm_scoring, "VOCABULARY", own)
    lm_scoring._ranks.cache_clear()
    rows = lm_scoring.score_documents(odd, F.coalesce(F.col("doc_id"), F.lit(0)) % 5 != 1).collect()
    counts = Counter()
    for i, t in odd_rows:
        if (i or 0) % 5 != 1:
            counts.update(tokens(t))
    total, distinct = sum(counts.values()), len(counts)
    want = []
    for i, t in odd_rows:
        w = tokens(t)
        base = sum(log10((counts[x] + 0.5) / (total + 0.5 * (distinct + 1))) for x in w)
        want.append((i or -1, (i or 0) % 5 == 1, len(w), sum(counts[x] > 0 for x in w), total, round(base, 6)))
    got = [(r["doc_id"] or -1, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows]
    assert sorted(got) == sorted(want)
    assert all(r["score"] < 0 for r in rows)


def test_lm_without_training(odd, nothing):
    rows = lm_scoring.score_documents(odd, F.lit(False)).collect()
    assert {r["train_tokens"] for r in rows} == {0}
    assert all(r["n_known"] == 0 and r["score"] <= 0 for r in rows)
    assert lm_scoring.score_documents(nothing, F.lit(True)).count() == 0


def test_training_beats_frequencies():
    docs = [np.array([0, 1, 2, 3, 4, 5] * 12) for _ in range(100)]
    p = recurrent.start(np.full(70, 100.0), 9.0)
    trainer = recurrent.Trainer(p)
    for _ in range(20):
        trainer.learn(docs)
    held = [np.array([0, 1, 2, 3, 4, 5] * 5)]
    assert recurrent.score(trainer.p, held)[0] > 0.5 * recurrent.score(p, held)[0]


def test_pipeline_stages(spark, odd, nothing):
    names = odd.columns
    for start in (odd, nothing):
        docs = start
        for name, function in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.stage(function(spark, docs, ""))
            assert docs.columns == names, name
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
        assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in docs.collect()}


def test_pipeline_keeps_clean_documents_and_one_copy(spark):
    rows = [(i, prose(i, 300, 3), "en") for i in range(60)]
    rows += [(100 + k, rows[5][1], "en") for k in range(5)] + [(200, None, "en"), (201, "1234 5678", "de")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    docs = df
    for _, function in corpus_pipeline.STAGES[:3]:
        docs = corpus_pipeline.stage(function(spark, docs, ""))
    ids = {r["doc_id"] for r in docs.filter("length(text) > 0").collect()}
    assert ids == set(range(60))
