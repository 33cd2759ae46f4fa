"""Removal of repeated byte strings, by suffix sorting of shards.

Every byte covered by a string of ``LENGTH`` bytes that also starts anywhere
else is removed. Texts are taken as UTF-8 bytes; strings never cross texts.

1. Each start of a string gets an anchor: its ``GRAM``-byte substring of least
   hash, the leftmost among equals. Equal strings have equal anchors at the
   same place, and neighbouring starts share one, so a text becomes runs of
   starts. Anchors of a single run cannot hold a repeated string and are dropped;
   if all runs of an anchor are equal to the last byte, all their starts are marked.
2. The runs of the other anchors become pieces of text. Equal pieces are counted
   and kept once, so copies never gather in a task.
3. Pieces are dealt out by anchor. A task takes anchors until a shard is full,
   sorts the suffixes of the shard by external induced sorting
   (:mod:`creditlake.llm.induced`), and marks the starts that share ``LENGTH`` bytes with another
   suffix, or whose piece occurs more than once.
4. Marked starts go back to their texts, where they merge into spans.

An anchor with more than ``CROWD`` different pieces is too much for one task:
its strings are hashed to 128 bits one by one and counted, which has no hot
key, since equal strings of equal pieces are one row.

Missing texts are empty. Texts shorter than ``LENGTH`` keep everything. Repeated
rows are repeated strings, whatever their ids; rows without ``doc_id`` are
texts like others. An empty table stays empty. Columns besides ``doc_id`` and
``text`` are carried along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType
from xxhash import xxh3_64_intdigest

from creditlake.llm.common import SLICE, give_back
from creditlake.llm.induced import repeats
from creditlake.staging import scope, stage

LENGTH = 200
GRAM = 32
# Bytes of a block of text.
BLOCK = 1 << 19
# Pieces that are handed on together.
PIECES = 4_000
# Bytes of a shard, and the most different pieces of an anchor in one.
SHARD_BYTES = 4 << 20
CROWD = 30_000

_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xBF58476D1CE4E5B9)
# Low bits of a hash that give way to its place, while the least is sought.
_PLACE = np.uint64((1 << 21) - 1)


def spans(docs: DataFrame) -> DataFrame:
    """``k1``, ``k2`` (the hashes of a text) and the ``spans`` to remove from it, for texts that have some."""
    rows = docs.select(F.coalesce("text", F.lit("")).alias("text")).select(*_keys(), "text")
    with scope(docs.sparkSession):
        runs = stage(rows.filter(F.octet_length("text") >= LENGTH).mapInArrow(_find_runs, _RUNS))
        shared = runs.groupBy("anchor").agg(F.count("*").alias("n"), (F.min("hash") < F.max("hash")).alias("mixed"))
        # Written, so that the join has a shuffle on either side and splits a frequent anchor.
        shared = stage(shared.filter("n > 1").select("anchor", "mixed"))
        wanted = runs.join(shared, "anchor")
        wanted = wanted.select("k1", "k2", F.struct("start", "starts", F.when(F.col("mixed"), F.col("anchor")).alias("anchor")).alias("run"))
        wanted = stage(wanted.groupBy("k1", "k2").agg(F.collect_set("run").alias("runs")), outlive=True)
        del runs, shared
    mixed = wanted.select("k1", "k2", F.filter("runs", lambda r: r["anchor"].isNotNull()).alias("runs")).filter(F.size("runs") > 0)
    with scope(docs.sparkSession):
        texts = rows.groupBy("k1", "k2").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
        cut = texts.join(mixed, ["k1", "k2"]).select("k1", "k2", "copies", F.col("text").cast("binary").alias("data"), "runs")
        pieces = cut.mapInArrow(_cut_pieces, _PIECES)
        pieces = stage(pieces.select("*", F.xxhash64("piece").alias("a"), F.xxhash64(F.lit(1), "piece").alias("b")), outlive=True)
        del texts, cut
    with scope(docs.sparkSession):
        found = _marked_starts(pieces).groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "begins", "ends")).alias("marks"))
        found = stage(found, outlive=True)
    same = F.filter("runs", lambda r: r["anchor"].isNull())
    whole = F.transform(same, lambda r: F.struct(r["start"].alias("start"), F.array(F.lit(0)).alias("begins"), F.array(r["starts"]).alias("ends")))
    both = wanted.select("k1", "k2", whole.alias("marks")).filter(F.size("marks") > 0).union(found)
    both = both.groupBy("k1", "k2").agg(F.flatten(F.collect_list("marks")).alias("marks"))
    return both.mapInArrow(_merge_marks, "k1 bigint, k2 bigint, spans array<struct<begin:bigint,end:bigint>>")


def _marked_starts(pieces: DataFrame) -> DataFrame:
    """``k1``, ``k2``, ``start`` of pieces with the runs of repeated starts in them."""
    kinds = pieces.groupBy("anchor", "a", "b").agg(F.first("piece").alias("piece"), F.sum("copies").alias("copies"))
    kinds = stage(kinds)
    crowds = kinds.groupBy("anchor").agg(F.count("*").alias("n")).filter(F.col("n") > CROWD).select("anchor")
    sorted_ = kinds.join(crowds, "anchor", "left_anti").repartition("anchor").sortWithinPartitions("anchor")
    marks = sorted_.select("anchor", "a", "b", "piece", "copies").mapInArrow(_sort_shards, _MARKS)
    marks = marks.union(_count_strings(kinds.join(crowds, "anchor", "left_semi")))

    return pieces.select("k1", "k2", "start", "a", "b").join(marks, ["a", "b"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_bytes``, the removed ``spans`` and the ``kept`` bytes of every row."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    joined = rows.select("doc_id", *_keys(), F.col("text").cast("binary").alias("data")).join(
        spans(docs), ["k1", "k2"], "left"
    )
    cut = _without(joined.select("doc_id", "data", "spans"), "data", "spans")
    return cut.select("doc_id", F.octet_length("data").cast("bigint").alias("n_bytes"), "spans", "kept")


def dedup_strings(docs: DataFrame) -> DataFrame:
    """``docs`` without the repeated strings, all columns in place.

    What a removed string leaves of a cut character goes too. Missing texts stay missing.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    text = names[docs.columns.index("text")]
    keyed = docs.toDF(*names).withColumns(dict(zip(("k1", "k2"), _keys(F.coalesce(text, F.lit(""))))))
    joined = keyed.join(spans(docs), ["k1", "k2"], "left").withColumn("data", F.col(text).cast("binary"))
    cut = _without(joined.select(*[n for n in names if n != text], "data", "spans"), "data", "spans")
    cut = cut.withColumn(text, F.when(F.col("data").isNull(), F.lit(None).cast("string")).otherwise(F.col("whole")))
    return cut.select(*[F.col(c).alias(n) for c, n in zip(names, docs.columns)])


def _keys(text: Column | str = "text") -> list[Column]:
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


# 1. Runs of starts with one anchor.

_RUNS = "k1 bigint, k2 bigint, anchor bigint, hash bigint, start bigint, starts int"


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of the anchor of every start of a string in ``data``, and the hash at every place."""
    h = (data.astype(np.uint64) + np.uint64(1)) * _MIX
    h ^= h >> np.uint64(31)
    factor, width = _BASE, 1
    while width < GRAM:
        h = h[:-width] * np.uint64(factor) + h[width:]
        factor = factor * factor % (1 << 64)
        width *= 2
    h ^= h >> np.uint64(32)
    h *= _MIX
    h ^= h >> np.uint64(29)
    least = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
    window, width = LENGTH - GRAM + 1, 1
    while 2 * width <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[: len(least) - (window - width)], least[window - width :])
    return (least & _PLACE).astype(np.int64), h


def runs_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text numbers, anchors, first starts and numbers of starts of the runs of some texts."""
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes)
    begins = ends - sizes
    data = np.frombuffer(b"".join(texts), np.uint8)
    at, hashes = anchors(data)
    owner = np.repeat(np.arange(len(texts)), sizes)[: len(at)]
    valid = np.arange(len(at)) + LENGTH <= ends[owner]
    head = valid.copy()
    head[1:] &= ~valid[:-1] | (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(head)
    stop = np.flatnonzero(np.append(~valid | head, True))
    after = stop[np.searchsorted(stop, first, side="right")]
    return owner[first], hashes[at[first]].view(np.int64), first - begins[owner[first]], (after - first).astype(np.int32)


def _find_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def blocks():
        """Texts as bytes with their keys and place; long ones in blocks that overlap by all but one start."""
        for batch in batches:
            k1, k2, texts = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)
            for i in range(batch.num_rows):
                data = texts[i].as_py().encode()
                for at in range(0, max(1, len(data) - LENGTH + 1), BLOCK):
                    yield k1[i], k2[i], at, data[at : at + BLOCK + LENGTH - 1]

    give_back()
    held, size = [], 0
    for block in blocks():
        held.append(block)
        size += len(block[3])
        if size >= BLOCK:
            yield _runs_batch(held)
            held, size = [], 0
    if held:
        yield _runs_batch(held)


def _runs_batch(held) -> pa.RecordBatch:
    owner, anchor, first, starts = runs_of([b[3] for b in held])
    k1, k2, at = (np.array([b[i] for b in held], np.int64) for i in range(3))
    # The hash of a run's whole text, beside that of its anchor.
    ends = (first + starts + LENGTH - 1).tolist()
    places = zip(owner.tolist(), first.tolist(), ends)
    hashes = np.array([xxh3_64_intdigest(held[i][3][a:b]) for i, a, b in places], np.uint64).view(np.int64)
    columns = [k1[owner], k2[owner], anchor, hashes, at[owner] + first, starts]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["k1", "k2", "anchor", "hash", "start", "starts"])


# 2. Pieces.

_PIECES = "k1 bigint, k2 bigint, start bigint, anchor bigint, copies bigint, piece binary"


def _cut_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["k1", "k2", "start", "anchor", "copies", "piece"]
    kinds = [*[pa.int64()] * 5, pa.binary()]
    held: list[list] = [[] for _ in names]

    def flush() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(held, kinds)], names)
        for column in held:
            column.clear()
        return made

    for batch in batches:
        keys = zip(*(batch.column(k).to_pylist() for k in range(3)))
        for i, (k1, k2, copies) in enumerate(keys):
            data = batch.column(3)[i].as_py()
            start, starts, anchor = (batch.column(4)[i].values.field(k).to_pylist() for k in range(3))
            n = len(start)
            pieces = [data[s : s + k + LENGTH - 1] for s, k in zip(start, starts)]
            for column, values in zip(held, ([k1] * n, [k2] * n, start, anchor, [copies] * n, pieces)):
                column.extend(values)
            if len(held[0]) >= PIECES:
                yield flush()
    if held[0]:
        yield flush()


# 3. Marked starts.

_MARKS = "a bigint, b bigint, begins array<int>, ends array<int>"
_MARKS_ARROW = pa.schema(
    [("a", pa.int64()), ("b", pa.int64()), ("begins", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32()))]
)


def _sort_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    give_back()
    held, size, last = [], 0, None
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
            # A shard ends between anchors only.
            if size >= SHARD_BYTES and row[0] != last:
                yield _marked(held)
                held, size = [], 0
            held.append(row)
            size += len(row[3])
            last = row[0]
    if held:
        yield _marked(held)
    del held
    give_back()


def _marked(held: list[tuple]) -> pa.RecordBatch:
    """The runs of repeated starts of each piece of a shard."""
    pieces = [row[3] for row in held]
    sizes = np.array([len(p) + 1 for p in pieces])
    # Bytes move up by two: 0 ends the shard, 1 the pieces.
    text = np.frombuffer(b"\xff".join(pieces) + b"\xff", np.uint8) + np.uint8(2)
    found = repeats(text, LENGTH)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    often = np.repeat([row[4] > 1 for row in held], sizes)
    starts = np.maximum(sizes - LENGTH, 0)
    inside = np.repeat(np.tile([True, False], len(held)), np.stack([starts, sizes - starts], 1).ravel())
    marked = np.concatenate([[False], (found | often) & inside, [False]])
    first = np.flatnonzero(~marked[:-1] & marked[1:])
    after = np.flatnonzero(marked[:-1] & ~marked[1:])
    rows, of = [], np.searchsorted(ends, first, side="right")
    cuts = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(of) else np.zeros(0, int)
    for x, y in zip(cuts, np.append(cuts[1:], len(of))):
        k = int(of[x])
        base = begins[k]
        rows.append({"a": held[k][1], "b": held[k][2], "begins": first[x:y] - base, "ends": after[x:y] - base})
    return pa.RecordBatch.from_pylist(rows, schema=_MARKS_ARROW)


def _count_strings(kinds: DataFrame) -> DataFrame:
    """The same for the pieces of crowded anchors: every string by its hashes."""
    place = F.explode(F.sequence(F.lit(0), F.octet_length("piece") - LENGTH))
    each = kinds.select("a", "b", "copies", "piece", place.alias("at"))
    string = F.substring("piece", F.col("at") + 1, F.lit(LENGTH))
    each = each.select("a", "b", "copies", "at", F.xxhash64(string).alias("x"), F.xxhash64(F.lit(1), string).alias("y"))
    often = each.groupBy("x", "y").agg(F.sum("copies").alias("n")).filter("n > 1").select("x", "y")
    marked = each.join(often, ["x", "y"]).groupBy("a", "b").agg(F.sort_array(F.collect_set("at")).alias("begins"))
    return marked.select("a", "b", "begins", F.transform("begins", lambda x: x + 1).alias("ends"))


# 4. Spans.


def _merge_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # Marks of a few texts at a time, and as arrays: as objects they take many times their bytes.
    for batch in batches:
        for begin in range(0, batch.num_rows, SLICE):
            part = batch.slice(begin, SLICE)
            merged = _merged(part.column(2))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), merged], ["k1", "k2", "spans"])


def _merged(marks: pa.ListArray) -> pa.ListArray:
    """The spans that the marked starts of each text cover."""
    start, begins, ends = marks.flatten().flatten()
    each = begins.value_lengths().to_numpy()
    owner = np.repeat(np.repeat(np.arange(len(marks)), marks.value_lengths().to_numpy()), each)
    base = np.repeat(start.to_numpy(), each)
    begin, end = base + begins.flatten().to_numpy(), base + ends.flatten().to_numpy() + (LENGTH - 1)
    order = np.lexsort((begin, owner))
    # The texts one after the other, so that no span reaches into the next.
    apart = owner[order] * (end.max(initial=0) + 1)
    begin, end = begin[order] + apart, np.maximum.accumulate(end[order] + apart)
    first = np.append(True, begin[1:] > end[:-1])[: len(begin)]
    last = np.append(first[1:], True)[: len(begin)]
    edges = np.searchsorted(owner[order][first], np.arange(len(marks) + 1)).astype(np.int32)
    spans = [pa.array(begin[first] - apart[first]), pa.array(end[last] - apart[last])]
    return pa.ListArray.from_arrays(pa.array(edges), pa.StructArray.from_arrays(spans, ["begin", "end"]))


def _without(rows: DataFrame, data: str, removed: str) -> DataFrame:
    """``rows`` with ``kept`` (bytes) and ``whole`` (text) once the spans are gone."""
    kept = pa.binary(), pa.string()
    at, by = rows.columns.index(data), rows.columns.index(removed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                left = []
                for text, gaps in zip(part.column(at).to_pylist(), part.column(by).to_pylist()):
                    text, place, pieces = text or b"", 0, []
                    for gap in gaps or ():
                        pieces.append(text[place : gap["begin"]])
                        place = gap["end"]
                    left.append(b"".join([*pieces, text[place:]]))
                texts = [x.decode("utf-8", "ignore") for x in left]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(left, kept[0]), pa.array(texts, kept[1])], [*part.schema.names, "kept", "whole"]
                )

    fields = [StructField("kept", BinaryType()), StructField("whole", StringType())]
    return rows.mapInArrow(run, StructType([*rows.schema.fields, *fields]))
