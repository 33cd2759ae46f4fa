"""Token ids on disk: one zstandard frame a document, with a shared dictionary.

A token folder holds three Parquet tables, all written by Spark:

``dictionary``
    one row: the dictionary and its sha256.
``segments``
    one row per run of documents in ascending ``doc_id`` order: the frames of
    the documents one after the other, the offset of each, its id count, the
    number of ids before it in the shard, and the hash of the dictionary.
``shards``
    one row per shard: how many documents and ids it has.

Reading one short document takes the segment whose id range covers it (Parquet
statistics skip the others) and decompresses a single frame.

Missing texts are empty documents and still get the end id. Rows without
``doc_id`` come first. Repeated rows are documents of their own, ordered by
hash and text. An empty table gives a folder without segments. Other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditlake.llm.common import map_slices
from creditlake.llm.encoding import encoder

# The dictionary is trained on whole documents of at most so many characters,
# and on so many of them: those with the smallest hashes.
SAMPLE_CHARS = 16_384
SAMPLE_ROWS = 600
DICTIONARY_BYTES = 110 * 1024

SEGMENT_BYTES = 1 << 20
# Characters of documents that are encoded together.
TOGETHER_CHARS = 4 << 20
LEVEL = 3

_SEGMENT = (
    "shard int, first_doc bigint, last_doc bigint, doc_id array<bigint>, start array<bigint>, "
    "n_tokens array<bigint>, offset array<bigint>, dictionary string, frames binary"
)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Encode ``docs`` (``doc_id``, ``text``), append ``end_id`` to each, and write the folder."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    data = _train(rows, tokenizer, end_id)
    name = hashlib.sha256(data).hexdigest()
    spark.createDataFrame([(name, data)], "dictionary string, data binary").write.parquet(f"{path}/dictionary")
    ordered = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie")
    ordered = ordered.sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text")
    segments = ordered.mapInArrow(_segments(tokenizer, end_id, data, name), _SEGMENT)
    segments.write.parquet(f"{path}/segments")
    totals = spark.read.parquet(f"{path}/segments").groupBy("shard").agg(
        F.sum(F.size("doc_id")).alias("n_docs"),
        F.sum(F.aggregate("n_tokens", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("n_tokens"),
    )
    totals.coalesce(1).write.parquet(f"{path}/shards")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit) of all documents."""
    # One line per shard, which is one task of the writer.
    shards = spark.read.parquet(f"{path}/shards").collect()
    sizes = {r["shard"]: r["n_tokens"] for r in shards}
    order = sorted(sizes)
    starts = dict(zip(order, accumulate((sizes[s] for s in order), initial=0)))
    name, data = _dictionary(spark, path)

    def decode(part: dict) -> Iterator[dict]:
        reader = _decompressor(data)
        for i, frames in enumerate(part["frames"]):
            if part["dictionary"][i] != name:
                raise ValueError(f"segment of another dictionary: {part['dictionary'][i]}")
            offset, base = part["offset"][i], starts[part["shard"][i]]
            for k, doc in enumerate(part["doc_id"][i]):
                ids = reader.decompress(frames[offset[k] : offset[k + 1]])
                yield {"doc_id": doc, "start": base + part["start"][i][k], "n_tokens": len(ids) // 4, "ids": ids}

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids binary"
    return map_slices(spark.read.parquet(f"{path}/segments"), decode, schema, rows=1)


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """The ids of the documents with this ``doc_id``: one segment read, one frame each decompressed."""
    name, data = _dictionary(spark, path)
    segments = spark.read.parquet(f"{path}/segments")
    found = segments.filter((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id))
    place = F.explode(F.arrays_zip("doc_id", F.sequence(F.lit(0), F.size("doc_id") - 1).alias("k")))
    rows = found.select("dictionary", "frames", "offset", place.alias("p")).filter(F.col("p.doc_id") == doc_id)
    begin, end = F.get("offset", F.col("p.k")), F.get("offset", F.col("p.k") + 1)
    frames = rows.select("dictionary", F.substring("frames", begin + 1, end - begin).alias("frame")).collect()
    if any(r["dictionary"] != name for r in frames):
        raise ValueError("segment of another dictionary")
    reader = _decompressor(data)
    return [np.frombuffer(reader.decompress(bytes(r["frame"])), "<u4").tolist() for r in frames]


def _dictionary(spark: SparkSession, path: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{path}/dictionary").first()
    data = bytes(row["data"])
    if hashlib.sha256(data).hexdigest() != row["dictionary"]:
        raise ValueError("the dictionary does not match its hash")
    return row["dictionary"], data


def _decompressor(data: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data))


def _ids(text: str, tokenizer: str, end: bytes) -> bytes:
    return encoder(tokenizer).encode(text) + end


def _train(rows: DataFrame, tokenizer: str, end_id: int) -> bytes:
    """A dictionary from the serialized ids of a bounded sample of short documents."""
    end = end_id.to_bytes(4, "little")
    short = rows.filter(F.length("text") <= SAMPLE_CHARS)
    sample = short.orderBy(F.xxhash64("doc_id", "text"), "doc_id").limit(SAMPLE_ROWS)

    def encode(part: dict) -> Iterator[dict]:
        for text in part["text"]:
            yield {"ids": _ids(text, tokenizer, end)}

    found = sorted(bytes(r["ids"]) for r in map_slices(sample.repartition(8), encode, "ids binary").collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, found).as_bytes()
    except zstandard.ZstdError:
        # Too little to train on: the ids themselves serve as dictionary.
        return (end * 2 + b"".join(found))[-DICTIONARY_BYTES:]


def _segments(tokenizer: str, end_id: int, data: bytes, name: str):
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(data))
        shard, total = TaskContext.get().partitionId(), 0
        docs, starts, counts, offsets, frames = [], [], [], [0], []

        def segment() -> pa.RecordBatch:
            known = [d for d in docs if d is not None]
            row = {
                "shard": shard,
                "first_doc": min(known, default=None),
                "last_doc": max(known, default=None),
                "doc_id": docs,
                "start": starts,
                "n_tokens": counts,
                "offset": offsets,
                "dictionary": name,
                "frames": b"".join(frames),
            }
            return pa.RecordBatch.from_pylist([row], schema=_ARROW)

        def documents():
            encode, held, texts, chars = encoder(tokenizer).encode_all, [], [], 0
            for batch in batches:
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    held.append(doc)
                    texts.append(text.as_py())
                    chars += len(texts[-1])
                    if chars >= TOGETHER_CHARS:
                        yield from zip(held, encode(texts))
                        held, texts, chars = [], [], 0
            yield from zip(held, encode(texts))

        for doc, ids in documents():
            ids += end
            frame = writer.compress(ids)
            docs.append(doc)
            starts.append(total)
            counts.append(len(ids) // 4)
            offsets.append(offsets[-1] + len(frame))
            frames.append(frame)
            total += counts[-1]
            if offsets[-1] >= SEGMENT_BYTES:
                yield segment()
                docs, starts, counts, offsets, frames = [], [], [], [0], []
        if docs:
            yield segment()

    return run


_ARROW = pa.schema(
    [
        ("shard", pa.int32()),
        ("first_doc", pa.int64()),
        ("last_doc", pa.int64()),
        ("doc_id", pa.list_(pa.int64())),
        ("start", pa.list_(pa.int64())),
        ("n_tokens", pa.list_(pa.int64())),
        ("offset", pa.list_(pa.int64())),
        ("dictionary", pa.string()),
        ("frames", pa.binary()),
    ]
)
