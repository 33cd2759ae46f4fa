"""What the operators must not lose: the end token, other texts of an id, fitted patterns, streamed bytes, long texts."""

import random
import time
from collections import Counter
from itertools import repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from creditlake.llm import bpe, language, lm_scoring, packing, simhash
from tests.llm.conftest import prose

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def test_the_end_is_known_whatever_else_is_frequent(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "HEAD", 100)
    monkeypatch.setattr(lm_scoring, "BUCKETS", 64)
    lm_scoring._ranks.cache_clear()
    text = " ".join(f"w{i}" for i in range(131)) + " " + "long" * 40
    docs = spark.createDataFrame([(0, text), (2, text)], "doc_id bigint, text string")
    counts = lm_scoring.token_counts(docs)
    head = lm_scoring._head(counts)
    assert lm_scoring.END.encode() in head[0] and len(head[0]) <= 100 and len(head[0]) > 60
    assert max(map(len, head[0])) <= lm_scoring.LONGEST
    rows = lm_scoring.score_documents(docs, F.lit(True)).collect()
    assert [(r["n_tokens"], r["n_known"]) for r in rows] == [(133, 133)] * 2
    lm_scoring._ranks.cache_clear()


def test_one_row_of_each_group_and_other_texts_of_an_id(spark, odd, nothing):
    a, b, c = prose(1, 200), prose(2, 200), prose(3, 200)
    rows = [(3, a), (4, a), (4, b), (4, c), (5, c), (5, c), (9, b), (None, a)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    kept = sorted(map(tuple, simhash.keep_first(df).collect()), key=str)
    assert kept == sorted([(3, a), (4, b), (4, c), (None, a)], key=str)
    out = simhash.keep_first(odd)
    assert out.columns == odd.columns
    assert out.filter("doc_id IS NULL").count() == odd.filter("doc_id IS NULL").count()
    assert simhash.keep_first(nothing).count() == 0


def test_patterns_are_fitted_where_best_fit_would_do(monkeypatch):
    histogram = np.zeros(2049, np.int64)
    lengths = np.minimum(np.exp(np.random.default_rng(0).normal(6.4, 0.9, 20_000)).astype(int) + 1, 2048)
    np.add.at(histogram, lengths, 1)
    fitted = []
    monkeypatch.setattr(packing, "fit", lambda *a, fit=packing.fit: fitted.append(fit(*a)) or fitted[-1])
    slots = packing.plan(histogram.copy(), 2048)
    assert fitted and fitted[0].sum() > 1000
    sequences = max(s[3] + s[2] for s in slots)
    best = sum(t for _, t in packing.residual(np.where(np.arange(2049) < 2048, histogram, 0), 2048)) + histogram[2048]
    assert sequences <= best


def test_all_bytes_of_new_words_go_through_the_stream():
    coder, theirs = bpe.Coder(BYTES), Tokenizer.from_file(BYTES)
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdeorstn") for _ in range(rnd.randint(1, 12))) for _ in range(3000)]
    for text in (" ".join(words), "x" + " y" * 9, "abc" * 9000, "ab cd " * 4000 + "e" * 9000 + " f"):
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == theirs.encode(text, add_special_tokens=False).ids
    coder = bpe.Coder(BYTES)
    coder.encode(" ".join(words))
    pieces = {words[0], *(" " + w for w in words[1:])}
    assert coder.streamed == sum(len(p.encode()) for p in pieces)
    before = coder.streamed
    coder.encode(" " + words[5])
    assert coder.streamed == before


def test_a_language_of_long_texts_only_is_learned(spark):
    def text(seed, letters, n):
        rnd = random.Random(seed)
        made = ["".join(rnd.choice(letters) for _ in range(rnd.randint(3, 8))) for _ in range(n)]
        return "\n".join(" ".join(made[i : i + 20]) for i in range(0, n, 20))

    rows = [(i, text(i, "abcdefg", 60), "aa") for i in range(40)]
    rows += [(100 + i, text(i, "uvwxyzt", 5000), "bb") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    chosen = language.sample(docs, F.lit(True))
    assert {label for _, label in chosen} == {"aa", "bb"}
    assert len(chosen) == 46 and max(len(t) for t, _ in chosen) == language.SAMPLE_CHARS
    found = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs, F.lit(True)).collect()}
    assert all(found[i] == lang for i, _, lang in rows)


def test_a_frequent_label_is_sampled_in_full(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_PER_LABEL", 20)
    rows = spark.range(30_000).selectExpr("id AS doc_id", "concat('word', id) AS text", "IF(id % 50 = 0, 'b', 'a') AS lang")
    chosen = language.sample(rows.union(rows.filter("doc_id < 100")), F.lit(True))
    assert sorted(label for _, label in chosen) == ["a"] * 20 + ["b"] * 20


class Shared:
    def __init__(self, value):
        self.value = value


def plain_tokens(text):
    return [w.decode() for w in (text or "").encode().lower().split()]


def test_reading_training_texts_costs_less_than_plain_lookups(monkeypatch):
    """The CPU time of a training task but for the model's own, against one split and one dictionary lookup per word."""
    texts = [prose(k % 50, 400) + f" Rare{k} word{k % 7}" for k in range(1_500)]
    head = [lm_scoring.END.encode(), *sorted({w.encode() for t in texts[:900] for w in plain_tokens(t)})]
    lexicon, seen = Shared((head, np.ones(len(head), np.int64))), []

    class Idle:
        tokens = 0

        def __init__(self, parameters):
            pass

        def learn(self, documents):
            seen.extend(documents)

    monkeypatch.setattr(lm_scoring.recurrent, "Trainer", Idle)
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[k : k + 500])], ["text"]) for k in range(0, len(texts), 500)]
    places = {w: i for i, w in enumerate(head)}

    def new():
        seen.clear()
        list(lm_scoring._copies(lexicon, Shared({"embed": np.zeros((1_025, 1))}))(iter(batches)))

    def plain():
        for batch in batches:
            for text in batch.column(0):
                found = text.as_py().encode().lower().split()
                np.fromiter(map(places.get, found, repeat(-1)), np.int32, len(found))

    def seconds(function):
        begun = time.process_time()
        function()
        return time.process_time() - begun

    lm_scoring._ranks.cache_clear()
    new()
    want = [[*(min(places.get(w.encode(), 1_024), 1_024) for w in plain_tokens(t)), 0] for t in texts]
    assert [s.tolist() for s in seen] == want
    assert min(seconds(new) for _ in range(5)) < 0.8 * min(seconds(plain) for _ in range(5))
    lm_scoring._ranks.cache_clear()


@pytest.mark.parametrize("split", [1, 50, 8 << 20])
def test_words_and_their_ranks_as_in_plain_python(odd_rows, monkeypatch, split):
    monkeypatch.setattr(lm_scoring, "SPLIT", split)
    texts = [t for _, t in odd_rows] + ["".join(map(chr, range(1, 300))), " A\x0bb\x1cC É  ", "\r\n", None, "zz zz  ZZ y"]
    head = [lm_scoring.END, *sorted({w for t in texts[:30] for w in plain_tokens(t)})]
    ids, rare = [], []
    # Not from its first row, as slices of a batch are.
    for found, starts in lm_scoring.words(pa.array(["before", *texts]).slice(1)):
        ranks, bounds = lm_scoring._encoded(pa.array(head), found, starts)
        ids += [part.tolist() for part in np.split(ranks, bounds[1:-1])]
        rare += lm_scoring._beyond(ranks, bounds, found).to_pylist()
    assert ids == [[*(head.index(w) if w in head else -1 for w in plain_tokens(t)), 0] for t in texts]
    assert [Counter({r["word"]: r["n"] for r in x}) for x in rare] == [Counter(w for w in plain_tokens(t) if w not in head) for t in texts]


def test_words_are_counted_over_many_small_parts(spark, odd, odd_rows, monkeypatch):
    monkeypatch.setattr(lm_scoring, "SPLIT", 64)
    monkeypatch.setattr(lm_scoring, "COUNTED", 500)
    want = Counter(w for _, t in odd_rows for w in [*plain_tokens(t), lm_scoring.END])
    assert {r["word"]: r["c"] for r in lm_scoring.token_counts(odd).collect()} == want
