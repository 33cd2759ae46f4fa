"""The registered queries of the operators, with their production parameters."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditlake.llm import (
    bpe, hard_negatives, language, line_dedup, lm_scoring, packing, periodic_runs, quality_rules, simhash, suffix_dedup, token_files, topk,
    window_packing,
)
from creditlake.llm.common import fold, table
from creditlake.staging import staging_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_token_files(spark, sf_dir):
    """Ids of all documents, written to token files and read back."""
    path = f"{staging_folder(spark)}/tokens-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    token_files.write_token_files(docs, path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    back = token_files.read_token_files(spark, path)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op8_packing(spark, sf_dir):
    """All documents packed into sequences of at most 2048 tokens."""
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


@query
def op9_bpe(spark, sf_dir):
    """Every text encoded by the streaming transducer and decoded again."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    back = bpe.decode_documents(bpe.encode_documents(table(spark, sf_dir, "documents"), path), path)
    return back.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


@query
def op5_simhash(spark, sf_dir):
    """Every document's fingerprint and group."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query
def op10_language(spark, sf_dir):
    """Every document's language, learned from four of five folds of the labelled ones."""
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, fold("doc_id") != 0)
    return found.select("doc_id", (fold("doc_id") == 0).alias("held_out"), "lang_pred", "score", "rejected")


@query
def op7_topk(spark, sf_dir):
    """The ten best of all other vectors for every hundredth one."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


SQL["op7_topk"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS whole
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), pairs AS (
    SELECT q.vec_id AS query_id, v.vec_id,
        CAST(COALESCE(list_sum(list_transform(list_zip(q.whole, v.whole), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
    FROM v AS q JOIN v ON q.vec_id <> v.vec_id AND len(q.whole) = len(v.whole)
    WHERE q.vec_id % 100 = 0
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
        vec_id, score
    FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query
def op3_quality_rules(spark, sf_dir):
    """Every document's counts, base rules and verdict."""
    return quality_rules.judge(table(spark, sf_dir, "documents"))


@query
def op2_line_dedup(spark, sf_dir):
    """Every document without the later occurrences of repeated three-line windows."""
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


SQL["op2_line_dedup"] = r"""
WITH lines AS (
    SELECT doc_id, text AS t, str_split(text, chr(10)) AS l FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL
), windows AS (
    SELECT DISTINCT doc_id, t, i, list_slice(l, i, i + 2) AS w
    FROM (SELECT doc_id, t, l, unnest(range(1, len(l) - 1)) AS i FROM lines WHERE len(l) >= 3)
), places AS (
    SELECT doc_id, t, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, t, i) AS k
    FROM windows WHERE len(list_filter(w, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) > 0
), removed AS (
    SELECT DISTINCT doc_id, t, i + d AS i FROM places, (SELECT unnest([0, 1, 2]) AS d) WHERE k > 1
), kept AS (
    SELECT x.doc_id, x.t, count(*) AS n, string_agg(x.line, chr(10) ORDER BY x.i) AS text
    FROM (SELECT DISTINCT doc_id, t, generate_subscripts(l, 1) AS i, unnest(l) AS line FROM lines) AS x
    ANTI JOIN removed AS r ON x.doc_id = r.doc_id AND x.t = r.t AND x.i = r.i
    GROUP BY ALL
)
SELECT d.doc_id, COALESCE(len(str_split(d.text, chr(10))), 0) AS n_lines,
    CASE WHEN d.text IS NULL OR d.doc_id IS NULL THEN 0
        ELSE len(str_split(d.text, chr(10))) - COALESCE(k.n, 0) END AS n_removed,
    CASE WHEN d.text IS NULL OR d.doc_id IS NULL THEN d.text ELSE COALESCE(k.text, '') END AS text
FROM documents AS d LEFT JOIN kept AS k ON d.doc_id = k.doc_id AND d.text = k.t
"""


@query
def op4_suffix_dedup(spark, sf_dir):
    """Every document without the strings of 200 bytes that also start elsewhere."""
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.coalesce(F.size("spans"), F.lit(0)).cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op6_lm_scoring(spark, sf_dir):
    """Every document's base score and score under the recurrent model."""
    return lm_scoring.score_documents(table(spark, sf_dir, "documents"), fold("doc_id") != 1)


@query
def op13_hard_negatives(spark, sf_dir):
    """The ten hardest negatives of every hundredth vector and each of its five best of the same label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


SQL["op13_hard_negatives"] = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS whole
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), pairs AS (
    SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same,
        CAST(COALESCE(list_sum(list_transform(list_zip(a.whole, v.whole), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
    FROM v AS a JOIN v ON a.vec_id <> v.vec_id AND len(a.whole) = len(v.whole)
    WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score
    FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), ranked AS (
    SELECT p.anchor_id, p.positive_id, p.positive_score, n.vec_id AS negative_id, n.score AS negative_score,
        CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank
    FROM positives AS p JOIN pairs AS n
        ON p.anchor_id = n.anchor_id AND NOT n.same
        AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""


@query
def op11_window_packing(spark, sf_dir):
    """All documents in sequences of 2048 tokens without padding, by fitted combinations of lengths."""
    docs = table(spark, sf_dir, "documents")
    return window_packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


def _words_with_a_period(doc_id: int | None, text: str | None) -> list[bytes]:
    """The words; in a tenth of the documents they repeat one period from some place to the end."""
    words = periodic_runs.split(doc_id, text)
    code = zlib.crc32(str(doc_id).encode())
    if doc_id is None or code % 10 or not words:
        return words
    seed, n = code // 10, len(words)
    first = seed % n
    period = 1 + (n - first) // (3 + seed % 8)
    return [*words[:first], *(words[first + i % period] for i in range(n - first))]


@query
def op12_periodic_runs(spark, sf_dir):
    """Every document's periodic runs and its words without their repetitions."""
    found = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), words=_words_with_a_period)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    # More periods come first, and fractions are compared as whole numbers.
    best = F.reduce(
        F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))),
        F.get("runs", F.lit(0)),
        lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b),
    )
    found = found.select("doc_id", "runs", "collapsed", lines.alias("lines"), best.alias("best"))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(F.expr("1000 * best.length div best.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(F.array_join("lines", ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
