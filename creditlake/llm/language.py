"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is the average of the embeddings of its words' subwords (letter runs,
lower case, with their borders: two and three characters, and the word), each
hashed to a bucket. Embeddings and softmax are trained by stochastic gradient
descent in numpy on the lines of a bounded sample of labelled documents. A part of
the sample is held back to calibrate: a temperature makes the scores honest
probabilities, and documents below a threshold taken from that part are
rejected.

The model is linear once trained, so a word is a vector of logits; scoring a
text adds up the vectors of its words.

Missing texts and texts without a letter are ``und`` with score 0 and rejected. If there is
nothing to learn from (an empty table, no labels), every text is. Rows without
``doc_id`` and repeated rows are scored like others. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from creditlake.llm.common import give_back, in_process, map_slices

# The sample: so many documents of each label and in all, of at most so many characters.
SAMPLE_PER_LABEL = 400
SAMPLE_ROWS = 4_000
SAMPLE_CHARS = 20_000

BUCKETS = 1 << 15
DIMENSION = 12
EPOCHS = 4
BATCH = 128
RATE = 0.6
# Lines of a document and the whole of it are examples; so many of them at most.
EXAMPLES = 16_000

# One in so many sampled documents is kept for calibration.
HELD_BACK = 5
# Share of rightly labelled calibration texts that may be rejected, and the highest threshold.
REJECTED = 0.001
HIGHEST = 0.5

UNKNOWN = "und"

_WORDS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_CACHED = 250_000


def words(text: str | None) -> list[str]:
    return _WORDS.findall(text.lower()) if text else []


def subwords(word: str) -> list[int]:
    """Buckets of a word's subwords. Very long words count by their pieces all the same."""
    framed = f"<{word}>"
    parts = [framed]
    parts += [framed[i : i + 2] for i in range(len(framed) - 1)]
    parts += [framed[i : i + 3] for i in range(len(framed) - 2)]
    return [crc32(p.encode()) % BUCKETS for p in parts]


@dataclass(frozen=True)
class Model:
    """``table`` has each bucket's logits; ``bias``, temperature and threshold belong to all."""

    labels: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float


class Scorer:
    """Scores texts under a model; word vectors are kept while they are in use."""

    def __init__(self, model: Model):
        self.model = model
        self.kept: dict[str, int] = {}
        self.rows = np.zeros((1 << 10, len(model.labels) + 1))

    def logits(self, text: str | None) -> np.ndarray | None:
        found = words(text)
        if not found:
            return None
        kept = self.kept
        if len(kept) > _CACHED:
            kept.clear()
        for word in found:
            if word not in kept:
                self._add(word)
        total = self.rows[[kept[w] for w in found]].sum(0)
        return total[:-1] / total[-1] + self.model.bias

    def _add(self, word: str) -> None:
        at = len(self.kept)
        if at >= len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        parts = subwords(word)
        self.rows[at, :-1] = self.model.table[parts].sum(0)
        self.rows[at, -1] = len(parts)
        self.kept[word] = at

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Label, probability, and whether it is rejected."""
        logits = self.logits(text) if self.model.labels else None
        if logits is None:
            return UNKNOWN, 0.0, True
        p = _softmax(logits[None] / self.model.temperature)[0]
        best = int(p.argmax())
        return self.model.labels[best], float(min(p[best], 1.0)), bool(p[best] < self.model.threshold)


def sample(docs: DataFrame, learn: Column) -> list[tuple[str, str]]:
    """Texts and labels to learn from: the documents with the smallest hashes of each label.

    Of a longer text a passage of ``SAMPLE_CHARS`` characters is taken, from a place that its id decides.
    """
    hashed = F.xxhash64("doc_id")
    able = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = able.groupBy("lang").agg(F.greatest(F.approx_count_distinct("doc_id"), F.lit(1)).alias("n"))
    # Hashes below a bound that leaves some times the wanted number of a frequent label, so that
    # no task meets all its ids.
    share = F.lit(8.0 * SAMPLE_PER_LABEL) / F.col("n")
    low = F.pmod(hashed, F.lit(1 << 20)) < F.greatest(share, F.lit(2.0**-20)) * (1 << 20)
    keys = able.join(counts, "lang").filter(low)
    # The bits that the bound looked at come first in the order.
    keys = keys.select("lang", F.col("doc_id").alias("id"), F.pmod(hashed, F.lit(1 << 20)).alias("low"), hashed.alias("hash"))
    keys = keys.distinct()
    order = Window.partitionBy("lang").orderBy("low", "hash", "id")
    chosen = keys.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= SAMPLE_PER_LABEL)
    chosen = chosen.orderBy("place", "hash", "lang").limit(SAMPLE_ROWS).select("id", F.col("lang").alias("label"))
    # One text for each id and label, however often the row is repeated.
    rows = able.join(F.broadcast(chosen), (F.col("doc_id") == F.col("id")) & (F.col("lang") == F.col("label")))
    begin = F.pmod(F.xxhash64("id"), F.greatest(F.length("text") - SAMPLE_CHARS + 1, F.lit(1))) + 1
    texts = rows.groupBy("id", "label").agg(F.min("text").alias("text"))
    texts = texts.withColumn("text", F.substr("text", begin.cast("int"), F.lit(SAMPLE_CHARS)))
    return [(r["text"], r["label"]) for r in sorted(texts.collect(), key=lambda r: (r["id"], r["label"]))]


def train(rows: list[tuple[str, str]], seed: int = 7) -> Model:
    """Fit the model to ``rows`` of text and label."""
    labels = sorted({label for _, label in rows})
    if not labels:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 0.0)
    number = {label: i for i, label in enumerate(labels)}
    held = [r for i, r in enumerate(rows) if i % HELD_BACK == HELD_BACK - 1]
    rest = [r for i, r in enumerate(rows) if i % HELD_BACK != HELD_BACK - 1]
    random = np.random.default_rng(seed)
    examples = _examples(rest, number, random)
    embeddings = random.uniform(-1, 1, (BUCKETS, DIMENSION)) / DIMENSION
    weights, bias = np.zeros((DIMENSION, len(labels))), np.zeros(len(labels))
    steps = max(1, EPOCHS * -(-len(examples) // BATCH))
    done = 0
    for _ in range(EPOCHS):
        order = random.permutation(len(examples))
        for at in range(0, len(order), BATCH):
            batch = [examples[i] for i in order[at : at + BATCH]]
            rate = RATE * (1 - done / steps)
            _step(batch, embeddings, weights, bias, rate)
            done += 1
    model = Model(labels, embeddings @ weights, bias, 1.0, 0.0)
    return _calibrated(model, held or rest, number)


def identify(docs: DataFrame, learn: Column) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected`` of every row, as ``doc_id``, ``text`` and these.

    The model learns from the rows where ``learn`` holds. The prediction sees the text alone.
    """
    named = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang")
    model = train(sample(named, learn))

    def run(part: dict) -> Iterator[dict]:
        scorer = _scorer(model)
        for doc, text in zip(part["doc_id"], part["text"]):
            label, score, rejected = scorer.predict(text)
            yield {"doc_id": doc, "lang_pred": label, "score": score, "rejected": rejected}

    return map_slices(named.select("doc_id", "text"), run, "doc_id bigint, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, learn: Column) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with their columns as they are."""
    model = train(sample(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang"), learn))
    names = docs.columns
    at = names.index("text")

    def run(batches):
        scorer = _scorer(model)
        for batch in batches:
            for begin in range(0, batch.num_rows, 128):
                part = batch.slice(begin, 128)
                kept = [i for i, text in enumerate(part.column(at).to_pylist()) if not scorer.predict(text)[2]]
                if kept:
                    yield part.take(kept)
        give_back(but="scorer")

    return docs.mapInArrow(run, docs.schema)


def _scorer(model: Model) -> Scorer:
    """This process's scorer of a model, with the words it knows already."""
    return in_process("scorer", model.table.tobytes()[:4096] + model.bias.tobytes(), lambda: Scorer(model))


def _examples(rows, number, random) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Buckets, their shares, and the label, of whole texts and their lines."""
    texts = [(text, number[label]) for text, label in rows]
    lines = [(line, n) for text, n in texts for line in text.split("\n")]
    known: dict[str, list[int]] = {}
    found = []
    for i in random.permutation(len(texts) + len(lines)):
        text, label = texts[i] if i < len(texts) else lines[i - len(texts)]
        parts: list[int] = []
        for word in words(text):
            if word not in known:
                known[word] = subwords(word)
            parts += known[word]
        if parts:
            buckets, counts = np.unique(parts, return_counts=True)
            found.append((buckets, counts / len(parts), label))
            if len(found) >= EXAMPLES:
                break
    return found


def _step(batch, embeddings, weights, bias, rate) -> None:
    """One step of gradient descent on a batch."""
    buckets = np.concatenate([b for b, _, _ in batch])
    shares = np.concatenate([s for _, s, _ in batch])
    owner = np.repeat(np.arange(len(batch)), [len(b) for b, _, _ in batch])
    begins = np.searchsorted(owner, np.arange(len(batch)))
    hidden = np.add.reduceat(embeddings[buckets] * shares[:, None], begins)
    p = _softmax(hidden @ weights + bias)
    p[np.arange(len(batch)), [n for _, _, n in batch]] -= 1
    back = p @ weights.T
    weights -= rate * hidden.T @ p / len(batch) * DIMENSION
    bias -= rate * p.mean(0) * 0.1
    # Buckets meet often in a batch: their steps add up.
    moves = back[owner] * shares[:, None]
    order = np.argsort(buckets, kind="stable")
    ordered = buckets[order]
    heads = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    embeddings[ordered[heads]] -= rate * np.add.reduceat(moves[order], heads) * DIMENSION


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _calibrated(model: Model, held, number) -> Model:
    """The model with the temperature of least loss on ``held``, and its threshold.

    Whole texts and their lines take part, so that short texts get honest scores too.
    """
    scorer = Scorer(model)
    texts = [(t, label) for text, label in held for t in {text, *text.split("\n")}]
    pairs = [(scorer.logits(text), number[label]) for text, label in texts]
    pairs = [(logits, n) for logits, n in pairs if logits is not None]
    if not pairs:
        return model
    logits, truth = np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])
    at = np.arange(len(truth))
    temperatures = np.geomspace(0.01, 20, 80)
    losses = [-np.log(_softmax(logits / t)[at, truth] + 1e-12).mean() for t in temperatures]
    best = float(temperatures[int(np.argmin(losses))])
    p = _softmax(logits / best)
    right = p.max(1)[p.argmax(1) == truth]
    threshold = min(HIGHEST, float(np.quantile(right, REJECTED))) if len(right) else 0.0
    return Model(model.labels, model.table, model.bias, best, threshold)
