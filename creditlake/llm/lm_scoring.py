"""Scores of whole documents under a unigram base and a recurrent language model.

1. Tokens of the training documents are counted, combined in each task before
   the shuffle.
2. The ``HEAD`` most frequent words at most go to every task (a fixed bound, each
   word of at most ``LONGEST`` bytes), the end of a document always among them;
   the first ``VOCABULARY`` of them are the model's own, all others are the
   "outside" token to it.
3. The recurrent model (:mod:`creditlake.llm.recurrent`) trains on all training documents,
   in ``ROUNDS`` rounds over disjoint parts: every task trains a copy on its
   documents, and the copies are averaged in a tree, weighted by tokens.
4. Every document is scored by the model from its first token to its end. An
   outside word costs its share of the outside counts besides. Words beyond
   the head find their counts by a shuffle; none of them is frequent.

The score is a probability: the model spreads 1 over its words and the outside,
and the outside spreads 1 over its words and one unknown. Training reads documents as tasks
find them, so the model depends on how files are split into tasks. Texts are split, and their
words counted and looked up, as Arrow arrays of some megabytes.

Missing texts are empty: their end alone is scored. Rows without ``doc_id`` are
scored as held in training (they have no fold). Repeated rows are scored each.
Without training documents all words are unknown. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditlake.llm import recurrent
from creditlake.llm.common import give_back
from creditlake.staging import stage

HEAD = 131_072
LONGEST = 64
# Words of the count at which the head is cut are taken by whole buckets of their hashes.
BUCKETS = 1 << 16
VOCABULARY = 1_024
ROUNDS = 2
FAN_IN = 16
# Tokens of the documents that run side by side, bytes of the texts that are split at a time, and bytes of
# split words that a task counts before it hands them on.
TOGETHER = 4_200_000
SPLIT = 8 << 20
COUNTED = 40 << 20

# The end of a document; no word holds a line feed.
END = "\n"


def words(column: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """The words of some texts after each other, and where each text starts in them; at last, where the last one ends."""
    texts = pc.fill_null(column, "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + SPLIT, "right")))
        part = pc.ascii_split_whitespace(pc.ascii_lower(texts.slice(at, stop - at).cast(pa.string())))
        found, starts = part.flatten(), part.offsets.to_numpy()
        # White space at either end of a text leaves empty words.
        whole = pc.binary_length(found).to_numpy(zero_copy_only=False) > 0
        if not whole.all():
            found, starts = found.filter(pa.array(whole)), np.append(0, np.cumsum(whole))[starts]
        yield found, starts
        at = stop


def token_counts(docs: DataFrame) -> DataFrame:
    """``word`` and its count ``c`` over all rows, ends included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, ends = [], 0, 0
        for batch in batches:
            for found, starts in words(batch.column(0)):
                held.append(found)
                size += found.nbytes
                ends += len(starts) - 1
                if size > COUNTED:
                    yield _counted(held)
                    held, size = [], 0
        if held:
            yield _counted(held)
            del held, found
            give_back()
        if ends:
            yield pa.RecordBatch.from_arrays([pa.array([END]), pa.array([ends], pa.int64())], ["word", "c"])

    counted = docs.select("text").mapInArrow(run, "word string, c bigint")
    return counted.groupBy("word").agg(F.sum("c").alias("c"))


def _counted(held: list[pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(pa.chunked_array(held).value_counts().flatten(), ["word", "c"])


def score_documents(docs: DataFrame, learn: Column) -> DataFrame:
    """``doc_id``, ``held_out``, token counts, ``base_score`` and ``score`` (both log10) of every row.

    The model learns from rows where ``learn`` holds.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.coalesce(learn, F.lit(True)).alias("learn"))
    training = rows.filter("learn")
    counts = stage(token_counts(training))
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    head = _head(counts)
    lexicon = spark.sparkContext.broadcast(head)
    model = spark.sparkContext.broadcast(_train(training, lexicon, total, head))

    own = head[1][:VOCABULARY]
    outside, outside_kinds = int(total - own.sum()), int(distinct - len(own))
    scored = stage(rows.select("doc_id", "learn", "text").mapInArrow(_scorer(lexicon, model), _SCORED))
    rare = scored.select("row", F.explode("rare").alias("w")).select("row", "w.word", "w.n")
    known = rare.join(counts, "word").groupBy("row")
    known = known.agg(F.sum("n").alias("found"), F.sum(F.col("n") * F.log10(F.col("c") + 0.5)).alias("rare_log"))
    joined = scored.drop("rare").join(known, "row", "left")
    found, zero = F.coalesce("found", F.lit(0)), F.lit(0.0)
    logs = F.coalesce("rare_log", zero) + (F.col("n_rare") - found) * float(np.log10(0.5))
    base = float(np.log10(total + 0.5 * (distinct + 1)))
    beyond = float(np.log10(outside + 0.5 * (outside_kinds + 1)))
    return joined.select(
        "doc_id",
        (~F.col("learn")).alias("held_out"),
        "n_tokens",
        (F.col("n_head") + found).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("head_log") + logs - F.col("n_tokens") * base).alias("base_score"),
        (F.col("model_log") + F.col("outside_log") + logs - F.col("n_outside") * beyond).alias("score"),
    )


_SCORED = (
    "row bigint, doc_id bigint, learn boolean, n_tokens bigint, n_head bigint, n_rare bigint, n_outside bigint, "
    "head_log double, outside_log double, model_log double, rare array<struct<word:string,n:bigint>>"
)


def _head(counts: DataFrame) -> tuple[list[bytes], np.ndarray]:
    """The end and the most frequent words that fit, by falling count, and their counts.

    Words of the last count that has a place are taken by hash, in whole buckets.
    """
    short = counts.filter((F.octet_length("word") <= LONGEST) & (F.col("word") != END))
    # One line for each different count, from the top until the words are enough.
    sizes = short.groupBy("c").agg(F.count("*").alias("n")).orderBy(F.desc("c")).limit(HEAD).collect()
    room, least, cut = HEAD - 1, None, None
    for row in sizes:
        if row["n"] > room:
            cut = row["c"]
            break
        least, room = row["c"], room - row["n"]
    chosen = F.col("word") == END
    if least is not None:
        chosen |= (F.col("c") >= least) & (F.octet_length("word") <= LONGEST)
    if cut is not None and room:
        bucket = F.pmod(F.xxhash64("word"), F.lit(BUCKETS))
        last = short.filter(F.col("c") == cut)
        edge = 0
        for row in last.groupBy(bucket.alias("b")).agg(F.count("*").alias("n")).orderBy("b").collect():
            if row["n"] > room:
                break
            edge, room = row["b"] + 1, room - row["n"]
        chosen |= (F.col("c") == cut) & (F.octet_length("word") <= LONGEST) & (bucket < edge)
    found = sorted(((r["c"], r["word"]) for r in counts.filter(chosen).collect()), key=lambda r: (-r[0], r[1]))
    return [w.encode() for _, w in found], np.array([c for c, _ in found], np.int64)


@lru_cache(maxsize=1)
def _ranks(lexicon) -> pa.Array:
    """The head's words in this process, by rank."""
    return pa.array([w.decode() for w in lexicon.value[0]], pa.string())


def _encoded(ranks: pa.Array, found: pa.Array, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of the tokens of texts with these words (-1 beyond the head), ends included, and where each text starts."""
    end = pc.index(ranks, END).as_py()
    bounds = starts + np.arange(len(starts))
    ids = np.full(bounds[-1], end, np.int32)
    ids[_inner(bounds)] = pc.fill_null(pc.index_in(found, value_set=ranks), -1).to_numpy(zero_copy_only=False)
    return ids, bounds


def _inner(bounds: np.ndarray) -> np.ndarray:
    """Which tokens are words and not ends."""
    inner = np.ones(bounds[-1], bool)
    inner[bounds[1:] - 1] = False
    return inner


def _beyond(ids: np.ndarray, bounds: np.ndarray, found: pa.Array) -> pa.Array:
    """Each text's words beyond the head and how often it has them."""
    inner = _inner(bounds)
    rare = ids[inner] < 0
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    kinds = found.filter(pa.array(rare)).dictionary_encode()
    size = max(1, len(kinds.dictionary))
    held = text[inner][rare] * size + kinds.indices.to_numpy(zero_copy_only=False)
    held, n = np.unique(held, return_counts=True)
    pairs = pa.StructArray.from_arrays([kinds.dictionary.take(pa.array(held % size)), pa.array(n, pa.int64())], ["word", "n"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(held, np.arange(len(bounds)) * size), pa.int32()), pairs)


def _for_model(ids: np.ndarray, size: int) -> np.ndarray:
    return np.where((ids < 0) | (ids >= size), size, ids)


def _train(training: DataFrame, lexicon, total: int, head) -> recurrent.Parameters:
    own = head[1][:VOCABULARY]
    parameters = recurrent.start(own, float(total - own.sum()))
    if not total:
        return parameters
    for part in range(ROUNDS):
        rows = training.filter(F.pmod(F.xxhash64("text"), F.lit(ROUNDS)) == part).select("text")
        shared = training.sparkSession.sparkContext.broadcast(parameters)
        copies = stage(rows.mapInArrow(_copies(lexicon, shared), "node bigint, tokens bigint, weights binary"))
        while (copies.agg(F.max("node")).first()[0] or 0) > 0:
            above = copies.withColumn("node", F.floor(F.col("node") / FAN_IN))
            copies = stage(above.groupBy("node").applyInArrow(_average, copies.schema))
        last = copies.first()
        if last is not None:
            parameters = recurrent.shaped(np.frombuffer(bytes(last["weights"]), np.float32), parameters)
    return parameters


def _average(table: pa.Table) -> pa.Table:
    tokens = table.column("tokens").to_numpy()
    weights = np.stack([np.frombuffer(w.as_py(), np.float32) for w in table.column("weights")]).astype(float)
    share = np.maximum(tokens, 1) / np.maximum(tokens, 1).sum()
    # The order of a sum must not depend on the order of arrival.
    order = np.lexsort((weights[:, 0], tokens))
    mean = (weights[order] * share[order, None]).sum(0).astype(np.float32)
    columns = {"node": table.column("node")[:1], "tokens": [int(tokens.sum())], "weights": [mean.tobytes()]}
    return pa.table(columns, schema=pa.schema([("node", pa.int64()), ("tokens", pa.int64()), ("weights", pa.binary())]))


def _copies(lexicon, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, size = _ranks(lexicon), len(shared.value["embed"]) - 1
        trainer = recurrent.Trainer(shared.value)
        held, tokens = [], 0
        for batch in batches:
            for found, starts in words(batch.column(0)):
                ids, bounds = _encoded(ranks, found, starts)
                for text in np.split(_for_model(ids, size), bounds[1:-1]):
                    held.append(text)
                    tokens += len(text)
                    if tokens >= TOGETHER:
                        trainer.learn(held)
                        held, tokens = [], 0
        if held:
            trainer.learn(held)
        if trainer.tokens:
            columns = [[TaskContext.get().partitionId()], [trainer.tokens], [recurrent.flat(trainer.p).tobytes()]]
            kinds = pa.int64(), pa.int64(), pa.binary()
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["node", "tokens", "weights"])

    return run


def _scorer(lexicon, model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, p = _ranks(lexicon), model.value
        size = len(p["embed"]) - 1
        logs = np.append(np.log10(lexicon.value[1] + 0.5), 0.0)
        number = TaskContext.get().partitionId() << 33

        def scored(held):
            nonlocal number
            give_back()
            texts = [text for _, ids, bounds, _ in held for text in np.split(_for_model(ids, size), bounds[1:-1])]
            found = recurrent.score(p, texts) / np.log(10)
            del texts
            for rows, ids, bounds, rare in held:
                heads = bounds[:-1]
                outside = (ids < 0) | (ids >= size)
                of_head = logs[ids]
                n, many = np.diff(bounds), np.add.reduceat(ids < 0, heads, dtype=np.int64)
                model_log, found = found[: len(n)], found[len(n) :]
                sums = [
                    n, n - many, many, np.add.reduceat(outside, heads, dtype=np.int64), np.add.reduceat(of_head, heads),
                    np.add.reduceat(np.where(outside, of_head, 0.0), heads), model_log,
                ]
                made = [pa.array(np.arange(number, number + len(n))), *rows, *map(pa.array, sums), rare]
                number += len(n)
                yield pa.RecordBatch.from_arrays(made, schema=_SCORED_ARROW)

        held, tokens = [], 0
        for batch in batches:
            at = 0
            for found, starts in words(batch.column(2)):
                ids, bounds = _encoded(ranks, found, starts)
                if held and tokens + len(ids) > TOGETHER:
                    yield from scored(held)
                    held, tokens = [], 0
                rows = [batch.column(i).slice(at, len(starts) - 1) for i in range(2)]
                held.append((rows, ids, bounds, _beyond(ids, bounds, found)))
                at, tokens = at + len(starts) - 1, tokens + len(ids)
        if held:
            yield from scored(held)

    return run


_SCORED_ARROW = pa.schema([
    ("row", pa.int64()), ("doc_id", pa.int64()), ("learn", pa.bool_()), ("n_tokens", pa.int64()), ("n_head", pa.int64()),
    ("n_rare", pa.int64()), ("n_outside", pa.int64()), ("head_log", pa.float64()), ("outside_log", pa.float64()),
    ("model_log", pa.float64()), ("rare", pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())]))),
])
