"""Limits of quality rules where most texts of a group have nothing of a metric."""

import random

import pytest

from rookery.llm import quality_rules as Q

DOCS = "doc_id long, text string, lang string, source string"


def text(r, n=250):
    return " ".join("".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(n))


def spoilt(r, metric):
    if metric == "symbols":
        return text(r) + " #$%&*<> |||| ### $$$" * 20
    if metric == "repeats":
        return text(r, 200) + " so it goes on and on" * 20
    if metric == "lines":
        return text(r) + "\nsame line\n" * 8 + text(r, 5)
    return text(r) + " SHOUTING" * 60


ONE = {"symbols": " & so on", "repeats": "", "lines": "\nonce more\nonce more", "upper": " Once"}


@pytest.mark.parametrize("metric", list(Q.RANKS))
def test_a_group_without_spread_lets_one_pass_and_no_more(spark, metric):
    r = random.Random(metric)
    rows = [(i, text(r), "en", "s") for i in range(96)] + [(100, text(r) + ONE[metric], "en", "s"), (101, spoilt(r, metric), "en", "s"), (102, spoilt(r, metric), "en", "s")]
    rows += [(200 + i, text(r), "en", "none at all") for i in range(20)] + [(300, text(r) + ONE[metric], "en", "none at all")]
    counts = Q.base_counts(spark.createDataFrame(rows, DOCS)).cache()
    for x in Q.thresholds(counts).collect():
        assert x[metric] > 0
    gone = {x.doc_id for x in Q.verdicts(counts).collect() if not x.kept}
    assert gone == {101, 102}


def test_groups_with_nothing_above_zero_keep_all(spark):
    r = random.Random(1)
    rows = [(i, text(r), "en", "s") for i in range(10)]
    assert all(x.kept for x in Q.quality_rules(spark.createDataFrame(rows, DOCS)).collect())
