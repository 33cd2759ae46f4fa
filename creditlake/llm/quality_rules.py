"""Quality rules: base rules on text statistics, then robust multivariate outliers.

Each text has a vector of transformed statistics (:data:`STATISTICS`). Per
language and source, the minimum covariance determinant gives a centre and a
covariance that junk cannot move: from two starts, concentration steps keep the
three quarters of the documents that lie nearest and estimate anew; the start
of smaller determinant wins and is reweighted once. Documents whose squared
Mahalanobis distance is over ``CUTOFF`` are rejected.

Everything is DataFrame functions. Estimates are aggregates, combined before
the shuffle, so a source with a third of all rows costs its group one line per
task; rows meet their estimate under one of ``SPREAD`` salts. The statistics of
a text stay inside its row. The same three-word windows within a text are found
by 64-bit hashes.

Groups of fewer than ``LEAST`` passing rows are judged together with the other
small groups of their language; where these are too few, with those of all
languages; where even these are too few, they pass. Missing languages and
sources are groups like others. Missing texts have no words and fail the base
rules, as empty ones do. Rows without ``doc_id`` and repeated rows are judged
like others. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditlake.llm.common import WORD
from creditlake.staging import stage

LEAST_WORDS = 50
MOST_REPEATED = 50

LEAST = 30
STEPS = 4
SPREAD = 16
# Share of a group that its estimate rests on.
NEAREST = 0.75
# Chi-square with 5 degrees of freedom, at 0.975 and 0.999, and
# the factors that make the covariance of the nearest 75 %, and of those within
# the 0.975 quantile, that of the whole: the share kept over the distribution
# with 7 degrees of freedom at the same bound.
REWEIGHT = 12.83
CUTOFF = 20.52
CONSISTENCY = 1.41
REWEIGHTED = 1.06

# The statistics and the deviation that is added to each one's spread. Where most
# texts have none of something it is all the spread there is, so it is what
# ordinary texts show: two repeated lines in a hundred or one repeated word in a
# hundred is one deviation, and so is one symbol in a thousand characters.
STATISTICS = {
    "log of words": (lambda: F.log1p("n_words"), 0.05),
    "log of word length": (lambda: F.log(F.col("word_chars") / F.col("n_words")), 0.02),
    "root of symbol share": (lambda: F.sqrt(F.col("n_symbols") / F.col("word_chars")), 0.03),
    "share of repeated lines": (lambda: F.sqrt(F.col("n_dup_lines") / F.col("n_lines")), 0.14),
    "share of repeated words": (lambda: F.sqrt(F.col("n_repeat_words") / F.col("n_words")), 0.1),
}
_P = len(STATISTICS)
_X = [f"x{i}" for i in range(_P)]
_PAIRS = [(i, j) for i in range(_P) for j in range(i + 1)]
_ESTIMATE = [f"m{i}" for i in range(_P)] + [f"l{i}{j}" for i, j in _PAIRS] + ["log_det"]

_SPACE = " \t\n\x0b\x0c\r"


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``lang``, ``source`` and the counts of every row's text, with ``base_failed``."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "lang", "source", F.coalesce("text", F.lit("")).alias("text")
    )
    split = rows.select(
        "doc_id", "lang", "source",
        F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)).alias("words"),
        F.filter(F.split("text", "\n", -1), lambda line: F.length(F.translate(line, _SPACE, "")) > 0).alias("lines"),
        F.length(F.translate("text", _SPACE, "")).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).cast("bigint").alias("n_symbols"),
    )
    n = F.col("n_words")
    # Hashes of the windows with their places: one sort brings equal windows together.
    spots = F.transform(
        F.slice("words", 1, F.greatest(n.cast("int") - 2, F.lit(0))),
        lambda w, i: F.struct(
            F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)).alias("hash"), i.cast("bigint").alias("place")
        ),
    )
    counted = split.select(
        "doc_id", "lang", "source", "words", "word_chars", "n_symbols",
        F.size("words").cast("bigint").alias("n_words"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
    )
    ordered = counted.select("*", F.sort_array(spots).alias("spots")).drop("words")
    same = lambda a, b: a["hash"] == b["hash"]
    twice = F.transform(
        "spots",
        lambda x, k: F.when(
            F.coalesce(same(x, F.get("spots", k + 1)), F.lit(False))
            | ((k > 0) & F.coalesce(same(x, F.get("spots", F.greatest(k - 1, F.lit(0)))), F.lit(False))),
            x["place"],
        ),
    )
    found = ordered.withColumn("at", F.sort_array(F.filter(twice, lambda x: x.isNotNull()))).drop("spots")
    gaps = F.transform("at", lambda x, k: F.least(F.lit(3), F.coalesce(F.get("at", k + 1) - x, F.lit(3))))
    repeated = F.aggregate(gaps, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return found.withColumn("n_repeat_words", repeated).drop("at").withColumn(
        "base_failed", (n < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * n)
    )


def judge(docs: DataFrame) -> DataFrame:
    """The statistics of every row with ``base_failed``, ``kept`` and the squared ``distance`` (NULL if none)."""
    vector = {x: F.when(~F.col("base_failed"), make()) for x, (make, _) in zip(_X, STATISTICS.values())}
    counted = stage(statistics(docs).withColumns(vector))
    rows = stage(_grouped(counted))
    judged = rows.filter(F.col("kin").isNotNull()).select("kin", "salt", *_X)
    estimate = _estimate(judged)
    near = _meet(rows, estimate, "left").withColumn("distance", _distance())
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= CUTOFF, F.lit(True))
    return near.withColumn("kept", kept).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )


def _grouped(counted: DataFrame) -> DataFrame:
    """Rows with the group they are judged in as ``kin``, NULL where none is large enough."""
    text = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit(""))
    rows = counted.withColumns({
        "language": text("lang"),
        "origin": text("source"),
        "salt": F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(SPREAD)).cast("int"),
    })
    groups = stage(rows.filter(~F.col("base_failed")).groupBy("language", "origin").agg(F.count("*").alias("n")))
    small = groups.filter(F.col("n") < LEAST)
    languages = small.groupBy("language").agg(F.sum("n").alias("together"))
    everyone = languages.filter(F.col("together") < LEAST).agg(F.sum("together")).first()[0] or 0
    none = F.lit("")
    kin = (
        F.when(F.col("n") >= LEAST, _kin(0, F.col("language"), F.col("origin")))
        .when(F.col("together") >= LEAST, _kin(1, F.col("language"), none))
        .when(F.lit(everyone) >= LEAST, _kin(2, none, none))
    )
    names = groups.join(languages, "language", "left")
    names = stage(names.select("language", "origin", kin.alias("kin")))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1)))
    named = rows.join(names.withColumn("salt", salts), ["language", "origin", "salt"], "left")
    return named.withColumn("kin", F.when(~F.col("base_failed"), F.col("kin")))


def _kin(level: int, language: Column, origin: Column) -> Column:
    return F.struct(F.lit(level).alias("level"), language.alias("language"), origin.alias("origin"))


def _estimate(rows: DataFrame) -> DataFrame:
    """Centre and Cholesky factor of each group: the better of two starts, reweighted."""
    starts = F.explode(F.array(F.lit(0), F.lit(1))).alias("start")
    both = rows.select("kin", "salt", *_X, starts)
    estimate = stage(_starts(rows))
    for _ in range(STEPS):
        near = _meet(both, estimate, "inner").select("kin", "start", "salt", *_X, _distance().alias("d"))
        edge = near.groupBy("kin", "start").agg(F.percentile_approx("d", NEAREST, 2000).alias("edge"))
        bound = stage(estimate.join(edge, ["kin", "start"]))
        inside = _meet(both, bound, "inner").filter(_distance() <= F.col("edge"))
        estimate = stage(_moments(inside, ["kin", "start"], CONSISTENCY))
    better = estimate.groupBy("kin").agg(F.min_by("start", F.struct("log_det", "start")).alias("start"))
    chosen = stage(estimate.join(better, ["kin", "start"]).drop("start"))
    light = _meet(rows, chosen, "inner").filter(_distance() <= REWEIGHT)
    return stage(_moments(light, ["kin"], REWEIGHTED))


def _starts(rows: DataFrame) -> DataFrame:
    """Medians with the spread of the middle half, without and with correlations of bounded scores."""
    quarters = {x: F.percentile_approx(x, F.array(*map(F.lit, (0.25, 0.5, 0.75))), 2000).alias(f"q{x}") for x in _X}
    middle = rows.groupBy("kin").agg(*quarters.values())
    scale = {f"s{x}": (F.col(f"q{x}")[2] - F.col(f"q{x}")[0]) / 1.349 for x in _X}
    floor = {f"s{x}": F.greatest(s, F.lit(f)) for (x, s), f in zip(zip(_X, scale.values()), _floors())}
    middle = stage(middle.select("kin", *[F.col(f"q{x}")[1].alias(f"c{x}") for x in _X], *[s.alias(n) for n, s in floor.items()]))
    both = _meet(rows, middle, "inner")
    score = {x: F.tanh((F.col(x) - F.col(f"c{x}")) / F.col(f"s{x}")) for x in _X}
    scored = both.select("kin", *[s.alias(x) for x, s in score.items()])
    tied = scored.groupBy("kin").agg(*[F.covar_pop(_X[i], _X[j]).alias(f"r{i}{j}") for i, j in _PAIRS])
    joined = middle.join(tied, "kin").withColumn("start", F.explode(F.array(F.lit(0), F.lit(1))))
    covariance = {}
    for i, j in _PAIRS:
        each = F.col(f"s{_X[i]}") * F.col(f"s{_X[j]}")
        if i == j:
            covariance[f"v{i}{j}"] = each
        else:
            norm = F.sqrt(F.greatest(F.col(f"r{i}{i}") * F.col(f"r{j}{j}"), F.lit(1e-12)))
            # A little below the bounds, so that the matrix stays positive.
            tie = 0.9 * F.col(f"r{i}{j}") / norm
            covariance[f"v{i}{j}"] = F.when(F.col("start") == 1, each * tie).otherwise(F.lit(0.0))
    centred = joined.withColumns({f"m{i}": F.col(f"c{x}") for i, x in enumerate(_X)} | covariance)
    return _factored(centred, ["kin", "start"])


def _moments(rows: DataFrame, keys: list[str], factor: float) -> DataFrame:
    means = [F.avg(x).alias(f"m{i}") for i, x in enumerate(_X)]
    spread = [(F.covar_pop(_X[i], _X[j]) * factor).alias(f"v{i}{j}") for i, j in _PAIRS]
    return _factored(rows.groupBy(*keys).agg(*means, *spread), keys)


def _factored(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The Cholesky factor of each row's covariance, with the floors on its diagonal."""
    for i, j in _PAIRS:
        inner = reduce(Column.__add__, [F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)], F.lit(0.0))
        if i == j:
            floor = _floors()[i] ** 2
            value = F.sqrt(F.greatest(F.col(f"v{i}{i}") + floor - inner, F.lit(floor * 0.01)))
        else:
            value = (F.col(f"v{i}{j}") - inner) / F.col(f"l{j}{j}")
        rows = rows.withColumn(f"l{i}{j}", value)
    logs = reduce(Column.__add__, [F.log(f"l{i}{i}") for i in range(_P)])
    return rows.withColumn("log_det", logs).select(*keys, *_ESTIMATE)


def _distance() -> Column:
    """Squared Mahalanobis distance by forward substitution."""
    solved: list[Column] = []
    for i, x in enumerate(_X):
        inner = reduce(Column.__add__, [F.col(f"l{i}{k}") * solved[k] for k in range(i)], F.lit(0.0))
        solved.append((F.col(x) - F.col(f"m{i}") - inner) / F.col(f"l{i}{i}"))
    return reduce(Column.__add__, [z * z for z in solved])


def _meet(rows: DataFrame, groups: DataFrame, how: str) -> DataFrame:
    """Rows beside their group's line, over salts."""
    keys = [k for k in ("kin", "start") if k in groups.columns and k in rows.columns]
    salted = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    return rows.join(salted, [*keys, "salt"], how)


def _floors() -> list[float]:
    return [floor for _, floor in STATISTICS.values()]
