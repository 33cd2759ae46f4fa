"""Near-duplicates by SimHash, with pigeonring filtering.

A text's fingerprint has a bit for each bit that is set in more than half of
its shingles' XXH64 hashes. Fingerprints within ``MAX_BITS`` bits are linked
and linked documents form a group.

Candidates come from the pigeonring principle: cut the fingerprint into three
segments on a ring. If the total difference is at most 2, then from some
segment on every chain of consecutive segments stays within its proportional
budget: no bit in the first, at most one in the first two, two in all three.
So each fingerprint is stored under its three pairs of neighbouring segments,
and asks for each pair as it is and with one bit of the second segment set;
only what meets there gets the full Hamming check.

Only distinct fingerprints take part, so copies cost nothing. A pair of
segments that more than ``CROWD`` fingerprints share is not paired up: who asks
for it looks up the fingerprints that the remaining budget allows in the third
segment by value instead, a number that does not depend on the crowd. No link
is lost either way.

Missing and empty texts have fingerprint zero and are linked like any other.
Rows without ``doc_id`` get the group of their fingerprint and never name one
(a group of such rows alone has no name: NULL). Repeated rows fall into one group.
An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from creditlake.llm.common import map_slices
from creditlake.llm.components import components
from creditlake.staging import stage

SHINGLE = 3
MAX_BITS = 2
CROWD = 32

# Lowest bit and width of the segments on the ring.
SEGMENTS = ((0, 21), (21, 21), (42, 22))

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_SEED = 42
_AT_ONCE = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of a text as an unsigned number."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    data = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    begins = ends - sizes
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1 :]
    votes = np.zeros(64, np.int64)
    for at in range(0, n, _AT_ONCE):
        part = zip(begins[at : min(at + _AT_ONCE, n)].tolist(), last[at : at + _AT_ONCE].tolist())
        hashes = np.array([xxh64_intdigest(data[a:b], _SEED) for a, b in part], "<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id`` and ``fingerprint`` (as a signed number) of every row."""

    def run(part: dict) -> Iterator[dict]:
        for doc, text in zip(part["doc_id"], part["text"]):
            yield {"doc_id": doc, "fingerprint": _signed(fingerprint(text, shingle))}

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_slices(rows, run, "doc_id bigint, fingerprint bigint")


def links(distinct: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Pairs ``a``, ``b`` of different fingerprints of ``distinct`` within two bits; some more than once."""
    stored = _each_chain(distinct, lambda i: F.array(F.lit(0).cast("bigint")), 0).select("chain", "key", "fp")
    sizes = stored.groupBy("chain", "key").agg(F.count("*").alias("n"))
    crowded = sizes.filter(F.col("n") > crowd)
    few = stored.join(sizes.filter(F.col("n") <= crowd), ["chain", "key"]).select("chain", "key", F.col("fp").alias("other"))
    targets = few.union(crowded.select("chain", "key", F.lit(None).cast("bigint")))

    asked = _each_chain(distinct, lambda i: F.array(F.lit(0).cast("bigint")), 0).union(
        _each_chain(distinct, lambda i: _unset(F.col("fp"), _second(i)), 1)
    )
    met = asked.join(targets, ["chain", "key"])
    near = met.filter((F.col("other") != F.col("fp")) & (F.bit_count(F.col("other").bitwiseXOR(F.col("fp"))) <= MAX_BITS))
    pairs = near.select(F.col("fp").alias("a"), F.col("other").alias("b"))

    third = None
    for i in range(3):
        for flips in (0, 1):
            chosen = (F.col("chain") == i) & (F.col("flips") == flips)
            changes = F.lit(_changes(_third(i), MAX_BITS - flips)).cast("array<bigint>")
            third = F.when(chosen, changes) if third is None else third.when(chosen, changes)
    full = F.col("fp").bitwiseXOR(F.col("flip"))
    wide = met.filter(F.col("other").isNull()).select("fp", full.alias("at"), F.explode(third).alias("change"))
    wanted = wide.select("fp", F.col("at").bitwiseXOR(F.col("change")).alias("b")).filter("fp <> b")
    found = wanted.join(distinct.select(F.col("fp").alias("b")), "b")
    return pairs.union(found.select(F.col("fp").alias("a"), "b"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``fingerprint`` and ``component_id``, the smallest ``doc_id`` it can reach, of every row."""
    marked = stage(fingerprints(docs, shingle))
    named = _grouped(marked, F.col("doc_id"))
    groups = named.groupBy("root").agg(F.min("first").alias("component_id"))
    names = named.join(groups, "root").select(F.col("fp").alias("fingerprint"), "component_id")
    return marked.join(names, "fingerprint").select("doc_id", "fingerprint", "component_id")


def _grouped(marked: DataFrame, order: Column) -> DataFrame:
    """``fp``, the ``first`` of its rows by ``order`` and the ``root`` of its group, for each fingerprint."""
    distinct = stage(marked.groupBy(F.col("fingerprint").alias("fp")).agg(F.min(order).alias("first")))
    rooted = components(links(distinct.select("fp")))
    named = distinct.join(rooted, F.col("fp") == F.col("node"), "left")
    return stage(named.select("fp", "first", F.coalesce("root", "fp").alias("root")))


def keep_first(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row of each group of near-duplicates of ``docs``, all columns in place.

    It is the one with the smallest ``doc_id``; of rows that share it, the one whose
    text has the least hash, so another text of that ``doc_id`` stays if it is first
    in a group of its own. Texts without words are copies of each other. Rows without
    ``doc_id`` take no part and stay.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    doc, text = (F.col(names[docs.columns.index(c)]) for c in ("doc_id", "text"))
    named = docs.toDF(*names).withColumns({"doc_id_": doc.cast("bigint"), "hash_": F.xxhash64(text)})

    def run(part: dict) -> Iterator[dict]:
        for doc_id, hashed, value in zip(part["doc_id_"], part["hash_"], part["text"]):
            yield {"doc_id": doc_id, "hash": hashed, "fingerprint": _signed(fingerprint(value, shingle))}

    rows = named.filter("doc_id_ IS NOT NULL").select("doc_id_", "hash_", text.alias("text"))
    marked = stage(map_slices(rows, run, "doc_id bigint, hash bigint, fingerprint bigint"))
    first = F.struct(F.col("doc_id").alias("doc_id_"), F.col("hash").alias("hash_"))
    chosen = _grouped(marked, first).groupBy("root").agg(F.min("first").alias("first")).select("first.*")
    kept = named.join(chosen, ["doc_id_", "hash_"], "left_semi")
    once = kept.groupBy("doc_id_", "hash_").agg(F.min_by(F.struct(*names), F.xxhash64(*names)).alias("row"))
    whole = named.filter("doc_id_ IS NULL").select(*names).union(once.select("row.*"))
    return whole.toDF(*docs.columns)


def _mask(*segments: int) -> int:
    bits = 0
    for s in segments:
        low, width = SEGMENTS[s]
        bits |= ((1 << width) - 1) << low
    return _signed(bits)


def _signed(bits: int) -> int:
    return bits - (bits >> 63 << 64)


def _bits(segment: int) -> list[int]:
    low, width = SEGMENTS[segment]
    return [_signed(1 << b) for b in range(low, low + width)]


def _second(chain: int) -> int:
    return (chain + 1) % 3


def _third(chain: int) -> int:
    return (chain + 2) % 3


def _changes(segment: int, most: int) -> list[int]:
    """All changes of at most ``most`` bits of a segment."""
    single = _bits(segment)
    found = [0, *single]
    if most > 1:
        found += [a ^ b for k, a in enumerate(single) for b in single[:k]]
    return found


def _unset(fp: Column, segment: int) -> Column:
    """The bits of a segment that are not set."""
    every = F.lit(_bits(segment)).cast("array<bigint>")
    return F.filter(every, lambda bit: fp.bitwiseAND(bit) == 0)


def _each_chain(distinct: DataFrame, flips, n: int) -> DataFrame:
    """``chain``, ``key``, ``fp``, ``flip`` and ``flips`` for each of the three pairs of segments."""
    parts = []
    for i in range(3):
        rows = distinct.select("fp", F.explode(flips(i)).alias("flip"))
        key = F.col("fp").bitwiseXOR(F.col("flip")).bitwiseAND(F.lit(_mask(i, _second(i))))
        parts.append(rows.select(F.lit(i).alias("chain"), key.alias("key"), "fp", "flip", F.lit(n).alias("flips")))
    return parts[0].union(parts[1]).union(parts[2])
