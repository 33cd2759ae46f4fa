"""What the sort of a shard holds at its peak."""

import tracemalloc

import numpy as np
import pyarrow as pa

from creditlake.llm import common, suffix_dedup
from creditlake.llm.induced import AT_ONCE, repeats
from creditlake.staging import scope


def test_a_shard_takes_no_more_than_28_bytes_a_character():
    words = np.random.default_rng(5).integers(1, 27, (4000, 6)).astype(np.uint8)
    text = words[np.random.default_rng(6).integers(0, 4000, 150_000)].ravel()
    tracemalloc.start()
    try:
        repeats(text, 200)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # A part of the suffixes at a time, and what is kept of all of them.
    assert peak < 28 * len(text) + 200 * AT_ONCE


def test_parts_of_the_suffixes_meet():
    rng = np.random.default_rng(7)
    part = rng.integers(1, 255, 3 * AT_ONCE).astype(np.uint8)
    text = np.concatenate([part, [254], part[:1000]])
    found = repeats(text, 200)
    places = {bytes(text[i : i + 200]) for i in range(len(part) + 1, len(text) - 199)}
    assert found[: 1000 - 199].all() and found[len(part) + 1 : len(text) - 199].all() and not found[1000 : len(part) - 200].any()
    assert len(places) == 801


def test_positions_of_a_shard_are_no_wider_than_it_needs():
    words = np.random.default_rng(5).integers(1, 27, (4000, 6)).astype(np.uint8)
    text = words[np.random.default_rng(6).integers(0, 4000, 150_000)].ravel()
    tracemalloc.start()
    try:
        repeats(text, 200)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 23 * len(text)


def test_a_process_drops_what_it_keeps_of_other_kinds():
    made = []
    for name in ("x", "x", "y"):
        common.in_process("a", name, lambda: made.append(name) or name)
    assert made == ["x", "y"]
    common.in_process("b", 1, lambda: 1)
    common.give_back(but="a")
    assert [*common._KEPT] == ["a"]
    common.give_back()
    assert not common._KEPT


def test_sorting_shards_drops_what_earlier_steps_keep():
    common.in_process("scorer", "x", list)
    assert [*suffix_dedup._sort_shards(iter([]))] == []
    assert not common._KEPT


def test_tasks_of_a_scope_get_bounded_batches(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")

    def count(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    with scope(spark):
        sizes = [r.n for r in spark.range(0, 5000, 1, 1).mapInArrow(count, "n bigint").collect()]
    assert sum(sizes) == 5000 and max(sizes) <= 1000
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def _marks(rng, rows, most):
    """Marks of some texts, and the spans they cover by a plain count."""
    made, plain = [], []
    for _ in range(rows):
        marks = []
        for _ in range(rng.integers(0, most)):
            begins = np.sort(rng.choice(500, rng.integers(0, 5), replace=False))
            marks.append({"start": int(rng.integers(0, 9000)), "begins": begins.tolist(), "ends": (begins + rng.integers(1, 9, len(begins))).tolist()})
        spans = []
        for a, b in sorted((m["start"] + x, m["start"] + y + 199) for m in marks for x, y in zip(m["begins"], m["ends"])):
            if spans and a <= spans[-1]["end"]:
                spans[-1]["end"] = max(spans[-1]["end"], b)
            else:
                spans.append({"begin": a, "end": b})
        made.append(marks)
        plain.append(spans)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("begins", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32()))]))
    keys = pa.array(range(rows), pa.int64())
    return pa.RecordBatch.from_arrays([keys, keys, pa.array(made, kind)], ["k1", "k2", "marks"]), plain


def test_marks_merge_to_spans():
    batch, plain = _marks(np.random.default_rng(8), 400, 12)
    found = [r for b in suffix_dedup._merge_marks(iter([batch, batch.slice(0, 0), batch.slice(7, 1)])) for r in b.to_pylist()]
    assert [r["spans"] for r in found] == [*plain, plain[7]] and [r["k1"] for r in found] == [*range(400), 7]


def test_marks_of_many_texts_are_not_all_objects_at_once():
    batch, _ = _marks(np.random.default_rng(9), 2000, 30)
    tracemalloc.start()
    try:
        rows = sum(b.num_rows for b in suffix_dedup._merge_marks(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == 2000 and peak < 2 * batch.nbytes
