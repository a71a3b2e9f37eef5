"""A split scan that is broken off after any step ends with the same elements and states."""

import pytest
from pyspark.sql import functions as F

from rookery.plans.scan import AREAS, CountryScan
from rookery.sources import area_id

ANSWER = "cc string, area bigint, statement int, error string, elements array<struct<type: string, id: bigint, tags: map<string,string>>>"
COUNTRIES = ["ok", "part", "gone", "big", "bare", "lost"]


def node(i, tag):
    return ("node", i, {"t": tag})


def answers(scan, calls, die_at=None):
    """What each request is answered, by the number of committed steps."""
    n = scan.steps()

    def one(cc, area, s):
        calls.append((cc, area, s))
        if cc == "lost":
            return None
        if area is None and s == 0 and cc in ("big", "bare"):
            return ("Query timed out", None)
        if area is None and s == 0 and cc == "gone":
            return ("busy", None)
        if s == AREAS:
            return (None, [("relation", 7, {}), ("node", 1, {}), ("relation", 5, {})] if cc == "big" else [])
        if cc == "part" and s == 1:
            return ("busy", None)
        if cc == "big" and area == 3_600_000_005 and s == 1 and n < 3:
            return ("busy", None)
        return (None, [node(1, f"{area}/{s}"), node(10 + s, f"{area}/{s}"), ("way", 1, None)])

    def ask(work):
        rows = []
        for r in work.collect():
            found = one(r.cc, r.area, r.statement)
            if found:
                error, elements = found
                rows += [(r.cc, r.area, r.statement, error, part) for part in ([elements[:1], elements[1:]] if elements else [elements])]
        if n == die_at:
            raise OSError("broken off")
        return work.sparkSession.createDataFrame(rows, ANSWER)

    return ask


def scanned(spark, path, most=3):
    return CountryScan(spark, str(path), spark.createDataFrame([(c,) for c in COUNTRIES], "cc string"), statements=2, most=most)


def result(scan):
    elements = sorted((x.cc, x.type, x.id, (x.tags or {}).get("t") or "") for x in scan.elements().collect())
    return elements, sorted(map(tuple, scan.states().collect()))


def test_broken_off_after_any_step(spark, tmp_path):
    calls = []
    whole = scanned(spark, tmp_path / "whole")
    whole.run(lambda work: answers(whole, calls)(work))
    elements, states = result(whole)
    assert states == [
        ("bare", True, 0, 0, False, None, "no subdivisions found to split by"),
        ("big", True, 2, 2, True, None, None),
        ("gone", False, 0, 0, False, None, "busy"),
        ("lost", False, 0, 0, False, None, "no response"),
        ("ok", False, 0, 0, False, None, None),
        ("part", False, 0, 0, False, 1, None),
    ]
    assert [e for e in elements if e[0] == "big"] == [
        ("big", "node", 1, "3600000005/1"),
        ("big", "node", 10, "3600000005/0"),
        ("big", "node", 11, "3600000005/1"),
        ("big", "way", 1, ""),
    ]
    # the first area is not asked again when the second one failed; a lost country is not asked on
    assert calls.count(("big", 3_600_000_007, 0)) == 1 and calls.count(("big", 3_600_000_005, 0)) == 2 and calls.count(("lost", None, 1)) == 0
    again = tmp_path / "again"
    for die_at in range(whole.steps()):
        with pytest.raises(OSError):
            scan = scanned(spark, again)
            scan.run(lambda work, scan=scan: answers(scan, [], die_at)(work))
    last = scanned(spark, again)
    last.run(lambda work: answers(last, [])(work))
    assert result(last) == (elements, states) and not last.step(answers(last, []))


def test_areas_are_given_up_after_some_tries(spark, tmp_path):
    scan = CountryScan(spark, str(tmp_path / "s"), spark.createDataFrame([("big",)], "cc string"), statements=1, most=2)
    error = F.when(F.col("area") == area_id(F.lit(5)), "busy").when(F.col("area").isNull() & (F.col("statement") == 0), "504")
    found = F.when(F.col("statement") == AREAS, F.expr("array(struct('relation', 5L, map('a', 'b')), struct('relation', 6L, map('a', 'b')))"))
    scan.run(lambda w: w.select("cc", "area", "statement", error.alias("error"), F.coalesce(found, F.expr("array(struct('node', 1L, map('a', 'b')))")).alias("elements")))
    assert [tuple(r) for r in scan.states().collect()] == [("big", True, 1, 2, False, None, None)]
    assert scan.log().filter("area is not null").count() == 3
