"""Places and breakers over ranges against one plain pass."""

import random

import pytest
from pyspark.sql import functions as F

from rookery.operators import ranges

KIND = "key string, n long, ok boolean, s long, range string"


def plain(rows, k, keyed):
    streak, opens, out = {}, {}, []
    for key, n, ok, *_ in sorted(rows, key=lambda r: ((r[0] is not None, r[0]) if keyed else 0, r[1])):
        key_ = key if keyed else None
        before = opens.get(key_, 0)
        s = 0 if ok else streak.get(key_, 0) % k + 1
        streak[key_] = s
        opens[key_] = before + (s == k)
        out.append((n, s, s == k, before))
    return sorted(out)


@pytest.mark.parametrize("keyed", [False, True])
@pytest.mark.parametrize("k, parts", [(1, 3), (3, 7), (4, 40)])
def test_breaker_equals_a_plain_pass(spark, keyed, k, parts):
    r = random.Random(k)
    outcomes = [True, False, False, None] + [False] * k
    keys = ["hot"] * 12 + ["a", "b", None, "z"]
    rows = [(r.choice(keys), i, r.choice(outcomes) if i % 100 < 60 else False, 1, "x") for i in range(400)]
    r.shuffle(rows)
    found = ranges.breaker(spark.createDataFrame(rows, KIND).repartition(3), [F.col("n")], F.col("ok"), k, ["key"] if keyed else None, parts)
    assert found.columns == ["key", "n", "ok", "s", "range", "streak", "opened", "pauses"]
    got = sorted((x.n, x.streak, x.opened, x.pauses) for x in found.collect())
    assert got == plain(rows, k, keyed)
    assert "SinglePartition" not in found._jdf.queryExecution().toString()


def test_until_open_and_empty_tables(spark):
    rows = [("a", i, i < 2, 1, "x") for i in range(6)] + [("b", i, True, 1, "x") for i in range(3)]
    table = spark.createDataFrame(rows, KIND)
    assert ranges.until_open(table, [F.col("n")], F.col("ok"), 2, ["key"]).filter("key = 'a'").count() == 4
    assert ranges.breaker(table.limit(0), [F.col("n")], F.col("ok"), 2).count() == 0
    assert ranges.placed(table.limit(0), [F.col("n")]).count() == 0


def test_places_under_a_collation(spark):
    names = ["Zoe", "ábc", "a b", "A b", "a-b", "ab", "", None, "ab"] * 20
    rows = spark.createDataFrame([(i, n, 5) for i, n in enumerate(names)], "i int, name string, place int")
    order = [F.collate("name", "UNICODE"), F.col("i")]
    found = ranges.placed(rows, order, 6)
    want = [x.i for x in rows.orderBy(*order).collect()]
    got = sorted(found.collect(), key=lambda x: x.place)
    assert [x.i for x in got] == want and [x.place for x in got] == list(range(1, len(names) + 1))
    assert "SinglePartition" not in found._jdf.queryExecution().toString()
