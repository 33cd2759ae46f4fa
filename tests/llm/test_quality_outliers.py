"""One planted outlier per statistic is rejected, usual texts are kept."""

import random

from creditlake.llm import quality_rules
from tests.llm.conftest import prose


def test_an_outlier_of_each_statistic_is_rejected(spark):
    rnd = random.Random(5)
    rows = [(i, prose(i, rnd.randint(60, 300)), "en", "s") for i in range(400)]
    fresh, passage = prose(901, 130).split(), prose(902, 35).split()
    lines = [" ".join(fresh[i : i + 4]) for i in range(0, 120, 4)]
    planted = {
        1000: prose(900, 20_000),
        1001: " ".join(w * 4 for w in fresh),
        1002: " ".join(w + "$$" for w in fresh),
        1003: "\n".join(x for line in lines for x in (line, "same")),
        1004: " ".join([*fresh[:65], *passage, *fresh[65:], *passage]),
    }
    rows += [(i, t, "en", "s") for i, t in planted.items()]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    found = {r["doc_id"]: r for r in quality_rules.judge(df).collect()}
    assert not any(found[i]["base_failed"] for i in planted)
    assert [i for i in planted if found[i]["kept"]] == []
    assert sum(found[i]["kept"] for i in range(400)) > 390
