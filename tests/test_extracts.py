"""Extracts as single files, and restoring under keys that are free."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from rookery import sources
from rookery.operators import merge, reports
from rookery.sources.single_file import write_file

CLUB = "name string, sports array<string>, contact string, email string, lang string, country string, src string, stale boolean"


def test_a_failed_write_leaves_the_old_file(spark, tmp_path):
    path = f"{tmp_path}/out/site.json"
    lines = spark.range(500).select(F.concat(F.lit("line "), "id").alias("value"), "id").repartition(5)
    write_file(lines, path, [F.desc("id")])
    want = [f"line {i}" for i in reversed(range(500))]
    assert open(path).read().splitlines() == want and os.listdir(tmp_path / "out") == ["site.json"]
    bad = lines.withColumn("value", F.when(F.col("id") == 450, F.raise_error(F.lit("no more"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="no more"):
        write_file(bad, path)
    assert open(path).read().splitlines() == want and os.listdir(tmp_path / "out") == ["site.json"]
    with pytest.raises(Exception, match="one file needs one"):
        lines.select("value").write.format("single_file").mode("overwrite").save(path)
    assert open(path).read().splitlines() == want and os.listdir(tmp_path / "out") == ["site.json"]
    write_file(lines.limit(0), path)
    assert open(path).read() == ""


def test_the_site_is_read_back_in_order(spark, tmp_path):
    rows = [("Zoe", ["Tennis"], "", "z@a", "x", "Spain", None, False), ("ábc", ["Padel", "Tennis"], 'a "q"', "a@a", "x", "Spain", "map", True), ("b", ["Squash"], "", "b@a", "x", "Chile", "map", False)]
    path = f"{tmp_path}/site.json"
    write_file(reports.site_lines(spark.createDataFrame(rows, CLUB)), path, ["ord"])
    site = json.load(open(path))
    assert (site["count"], site["byCountry"], site["bySport"]) == (3, {"Chile": 1, "Spain": 2}, {"Tennis": 2, "Padel": 1, "Squash": 1})
    assert [c["email"] for c in site["clubs"]] == ["b@a", "a@a", "z@a"] and site["clubs"][1]["contact"] == 'a "q"'
    assert sources.published_extract(spark, path, CLUB).count() == 3
    write_file(reports.site_lines(spark.createDataFrame([], CLUB)), path, ["ord"])
    assert json.load(open(path)) == {"count": 0, "byCountry": {}, "bySport": {"Tennis": 0, "Padel": 0, "Squash": 0}, "clubs": []}


def test_free_keys_equal_trying_one_after_another(spark):
    r = random.Random(3)
    bases = ["n:ES:hot"] * 6 + ["n:ES:a", "n:GB:b", "n:PT:"]
    taken = {r.choice(bases) + r.choice(["", "#2", "#3", "#5", "#07", "#1", "#x", "#12"]) for _ in range(14)} | {"n:ES:hot", None}
    rows = [(r.choice(bases), i, 7) for i in range(120)]
    frame = spark.createDataFrame(rows, "base string, i int, n int")
    found = merge.free_keys(frame, "base", ["i"], spark.createDataFrame([(k,) for k in taken], "key string")).collect()
    used, want = set(taken), {}
    for base, i, _ in rows:
        key, k = base, 2
        while key in used:
            key, k = f"{base}#{k}", k + 1
        used.add(key)
        want[i] = key
    assert {x.i: x.key for x in found} == want


def test_restored_rows(spark):
    countries = sources.countries(spark)
    store = spark.createDataFrame([("n:ES:clubuno", "here@a.es"), ("n:ES:other", None)], "key string, email string")
    rows = [
        ("Club Uno", ["Tennis"], None, "New@a.es", "Spanish", "spain", "", None),
        ("Club Uno", ["Padel"], "Ana", "x@a.es", "Spanish", "Spain", "map", True),
        ("Known", [], "", "HERE@a.es", "Spanish", "Spain", "map", False),
        ("Nowhere", [], "", "n@a.es", "Spanish", "Atlantis", "map", False),
        ("No address", [], "", "", "Spanish", "Spain", "map", False),
    ]
    got = merge.restored(spark.createDataFrame(rows, CLUB), store, countries).orderBy("key").collect()
    assert [(x.key, x.email, x.cc, x.src, x.stale, x.contact, x.crawled, x.attempts, x.restored) for x in got] == [
        ("n:ES:clubuno#2", "new@a.es", "ES", "restored", False, "", True, 0, True),
        ("n:ES:clubuno#3", "x@a.es", "ES", "map", True, "Ana", True, 0, True),
    ]
