import random

import pytest

LONG = " ".join(f"w{i % 997}{i % 31}" for i in range(30_000))


def prose(seed, words=80, lines=4):
    rnd = random.Random(seed)
    made = ["".join(rnd.choice(["the", "an", "ti", "on", "er", "re", "ed"]) for _ in range(rnd.randint(1, 4))) for _ in range(words)]
    cut = max(1, words // lines)
    return "\n".join(" ".join(made[i : i + cut]) for i in range(0, words, cut))


# Columns whose names the operators use inside, or whose case may clash.
CLASHING = ["k1", "a", "b", "n", "tie", "doc", "node", "fp", "row", "words", "lines", "spans", "kept", "score", "tie_", "c0"]


@pytest.fixture(scope="session")
def odd_rows():
    """Ids and texts: missing, empty, white space, long, repeated rows, ties, one id with two texts."""
    base = [(i, prose(i)) for i in range(1, 40)]
    return [
        *base,
        (3, prose(3)),
        (4, prose(99)),
        (50, prose(7)),
        (51, None),
        (52, ""),
        (53, " \n\t\n "),
        (54, LONG),
        (55, "x"),
        (56, "a b"),
        (57, "äöü ß 漢字 😀\u0000\u0001"),
        (None, prose(8)),
        (None, None),
        (60, "same\nthree\nlines\nsame\nthree\nlines"),
        (61, "aaaa" * 200),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The odd rows with clashing and missing columns, over several partitions."""
    extra = ", ".join(f"`{c}` int" for c in CLASHING)
    rows = [(i, t, ["en", "de", None][k % 3], ["s0", None][k % 2], *[k] * len(CLASHING)) for k, (i, t) in enumerate(odd_rows)]
    df = spark.createDataFrame(rows, f"doc_id bigint, text string, lang string, source string, {extra}")
    return df.repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)
