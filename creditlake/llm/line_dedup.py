"""Line deduplication by overlapping windows of three lines.

A window is three consecutive lines of a text (cut at line feeds). Windows are
hashed to 128 bits. The first place of a repeated window, by ``doc_id`` and line number,
stays; every other place is removed with all its lines. Windows overlap, so
the covered lines of a text merge into runs. A window without any word is no
evidence and ignored, and texts of fewer than three lines are left alone.

Only DataFrame functions are used. Windows are counted with a partial count
per task; windows that hold more than ``HOT_SHARE`` of all places are at most
``1 / HOT_SHARE`` by arithmetic and are looked up by broadcast, all others by a
shuffle in which no key is frequent.

Rows with the same ``doc_id`` and text are one document: what is removed from
one is removed from all, and they are no repetition of each other. Same ids with different texts are ordered
by the hash of the text. Rows without ``doc_id`` have no place in the order:
they keep their text and do not count. Missing texts stay missing. An empty
table stays empty. Columns besides ``doc_id`` and ``text`` are carried along,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlake.llm.common import WORD
from creditlake.staging import stage

LINES = 3
HOT_SHARE = 0.001

_PLACE = ["doc", "tie", "line"]


def repeated_windows(docs: DataFrame) -> DataFrame:
    """``doc``, ``tie`` (hash of the text) and ``line`` of all windows but the first of each kind."""
    places = stage(_windows(docs))
    total = places.count()
    place = F.struct(*_PLACE)
    kinds = places.groupBy("a", "b").agg(F.count("*").alias("n"), F.min(place).alias("first"))
    kinds = stage(kinds.filter("n > 1"))
    hot = kinds.filter(F.col("n") > total * HOT_SHARE).select("a", "b", F.col("first").alias("top"))
    cold = kinds.filter(F.col("n") <= total * HOT_SHARE).select("a", "b", "first")
    marked = places.join(F.broadcast(hot), ["a", "b"], "left")
    later = marked.filter(F.col("top").isNotNull() & (place > F.col("top"))).select(*_PLACE)
    rest = marked.filter(F.col("top").isNull()).join(cold, ["a", "b"])
    return later.union(rest.filter(place > F.col("first")).select(*_PLACE))


def removed_lines(docs: DataFrame) -> DataFrame:
    """``doc``, ``tie`` and the runs of removed lines: their first lines (from 0) and the lines after their last."""
    windows = repeated_windows(docs).groupBy("doc", "tie").agg(F.sort_array(F.collect_set("line")).alias("at"))
    begins = F.filter("at", lambda x, k: (k == 0) | (x > F.get("at", F.greatest(k - 1, F.lit(0))) + LINES))
    ends = F.filter("at", lambda x, k: F.coalesce(F.get("at", k + 1) > x + LINES, F.lit(True)))
    return windows.select("doc", "tie", begins.alias("begins"), F.transform(ends, lambda x: x + LINES).alias("ends"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` without the later occurrences of repeated windows, all columns in place."""
    runs = removed_lines(docs)
    names = [f"c{i}" for i in range(len(docs.columns))]
    named = docs.toDF(*names)
    doc, text = names[docs.columns.index("doc_id")], names[docs.columns.index("text")]
    keyed = named.withColumns({"tie_": F.xxhash64(text), "doc_": F.col(doc).cast("bigint")})
    joined = keyed.join(runs, (F.col("doc_") == F.col("doc")) & (F.col("tie_") == F.col("tie")), "left")
    # A column of its own, so that a text is split once and not for every gap.
    joined = joined.withColumn("lines", F.when(F.col("begins").isNotNull(), F.split(text, "\n", -1)))
    kept = F.when(F.col("begins").isNull(), F.col(text)).otherwise(F.array_join(_kept_lines(), "\n"))
    return joined.withColumn(text, kept).select(*[F.col(c).alias(n) for c, n in zip(names, docs.columns)])


def line_report(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_lines``, ``n_removed``, and the ``text`` that is left, of every row."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("before"), "text")
    left = dedup_lines(rows)
    n = lambda c: F.coalesce(F.size(F.split(c, "\n", -1)), F.lit(0)).cast("bigint")
    n_lines = F.when(F.col("before").isNull(), F.lit(0)).otherwise(n("before")).cast("bigint")
    # A text all of whose lines went is empty and has no line left.
    all_gone = (F.col("text") == "") & (F.col("before") != "")
    n_left = F.when(F.col("text").isNull() | all_gone, F.lit(0)).otherwise(n("text")).cast("bigint")
    return left.select("doc_id", n_lines.alias("n_lines"), (n_lines - n_left).alias("n_removed"), "text")


def _windows(docs: DataFrame) -> DataFrame:
    """A row per window with a word: two hashes and its place."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc"), "text").filter("doc IS NOT NULL AND text IS NOT NULL")
    lines = rows.select("doc", F.xxhash64("text").alias("tie"), F.split("text", "\n", -1).alias("lines"))
    lines = lines.filter(F.size("lines") >= LINES)
    hashed = lines.select(
        "doc", "tie",
        F.transform("lines", lambda x: F.struct(
            F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"), x.rlike(WORD).alias("word")
        )).alias("h"),
    )
    start = F.slice("h", 1, F.size("h") - (LINES - 1))
    second, third = (lambda i: F.get("h", i + 1)), (lambda i: F.get("h", i + 2))
    windows = F.transform(start, lambda x, i: F.when(
        x["word"] | second(i)["word"] | third(i)["word"],
        F.struct(
            F.xxhash64(x["a"], second(i)["a"], third(i)["a"]).alias("a"),
            F.xxhash64(x["b"], second(i)["b"], third(i)["b"]).alias("b"),
        ),
    ))
    each = hashed.select("doc", "tie", F.posexplode(windows).alias("line", "w"))
    return each.filter("w IS NOT NULL").select("w.a", "w.b", "doc", "tie", "line")


def _kept_lines():
    """The lines between the runs, one slice for each gap."""
    before = lambda k: F.when(k == 0, F.lit(0)).otherwise(F.get("ends", F.greatest(k - 1, F.lit(0))))
    gaps = F.transform(
        F.sequence(F.lit(0), F.size("begins")),
        lambda k: F.slice("lines", before(k) + 1, F.coalesce(F.get("begins", k), F.size("lines")) - before(k)),
    )
    return F.flatten(gaps)
