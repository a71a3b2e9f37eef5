"""States as of a time, values carried over ranges, windows and joins of streams, seeds met as beginnings."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rookery import sources
from rookery.functions import rx, urls
from rookery.operators import ranges, reports
from rookery.plans import walk
from rookery.streaming import answered, dropped, sessions, sliding

EVENTS = "event_id long, ts timestamp, user_id long, event_type string"
START = dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc)


@pytest.mark.parametrize("parts", [1, 5, 30])
def test_as_of_equals_a_plain_search(spark, parts):
    r = random.Random(parts)
    keys = ["hot"] * 8 + ["a", "b", "none", None]
    events = [(r.choice(keys), r.choice([*range(100), None]), i, "clash") for i in range(300)]
    states = [(r.choice(keys[:-2] + [None]), r.choice([*range(100), None]), r.randint(0, 5)) for _ in range(60)]
    found = ranges.as_of(spark.createDataFrame(events, "k string, at int, i int, state string").repartition(3), spark.createDataFrame(states, "k string, since int, v int"), ["k"], "at", "since", parts)
    got = {x.i: (x.state.since, x.state.v) if x.state else None for x in found.collect()}

    def plain(k, at):
        fit = [(s, v) for key, s, v in states if key == k and k is not None and s is not None and at is not None and s <= at]
        return max(fit) if fit else None

    assert got == {i: plain(k, at) for k, at, i, _ in events}


def test_next_and_last_values(spark):
    r = random.Random(5)
    rows = [(r.choice(["x", "y", None]), i, r.choice([None, None, None, i])) for i in range(150)]
    table = spark.createDataFrame(rows, "k string, i int, v int")
    for ahead, f in ((True, ranges.next_value), (False, ranges.last_value)):
        got = {x.i: x.near for x in f(table, [F.col("i")], F.col("v"), "near", ["k"], 9).collect()}
        for k, i, _ in rows:
            own = [v for key, j, v in rows if key == k and v is not None and (j >= i if ahead else j <= i)]
            assert got[i] == ((min(own) if ahead else max(own)) if own else None)
    assert ranges.next_value(table.limit(0), [F.col("i")], F.col("v"), "near").count() == 0


def test_seeds_that_begin_a_known_url_are_not_new(spark):
    lines = spark.createDataFrame([("ES https://a.es/clubs/x",), ("# https://b.es",), ("no url",), ("GB https://c.uk?q=1 rest",)], "value string")
    found = [("ES", "https://a.es/"), ("ES", "https://a.es/clubs/x"), ("ES", "https://a.es/clubs/x/y"), ("GB", "https://b.es"), ("GB", "https://c.uk"), ("PT", "https://d.pt"), ("BR", "https://d.pt"), ("ES", None)]
    got = sorted(x.value for x in sources.new_seeds(spark.createDataFrame(found, "cc string, url string"), lines).collect())
    assert got == ["BR  https://d.pt", "ES  https://a.es/clubs/x/y"]


def test_a_walk_that_is_too_deep_is_an_error(spark):
    edges = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(6)], "src string, dst string")
    roots = spark.createDataFrame([("n0",)], "node string")
    assert {x.node: x.depth for x in walk.reach(edges, roots).collect()} == {f"n{i}": i for i in range(7)}
    with pytest.raises(RuntimeError):
        walk.reach(edges, roots, most=3)


def events(spark):
    r = random.Random(6)
    return [(i, START + dt.timedelta(minutes=r.randint(0, 3000)), r.choice([1, 1, 1, 2, None]), r.choice("ab")) for i in range(200)]


def streamed(spark, folder, parts, schema, query):
    """Rows of a stream over parts that come one after another, and the rows dropped as late."""
    late, out = 0, f"{folder}/out"
    for n, part in enumerate(parts):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{folder}/in/part={n}")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in/part=*")
        q = query(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{folder}/check").trigger(availableNow=True).start()
        q.awaitTermination()
        late += dropped(q)
    return spark.read.parquet(out), late


@pytest.mark.parametrize("windows", [sessions, sliding])
def test_windows_of_a_stream_equal_those_of_a_table_and_count_late_rows(spark, tmp_path, windows):
    rows = sorted(events(spark), key=lambda x: x[1])
    last = [(1000, START + dt.timedelta(days=40), 9, "a")]  # moves the watermark beyond all others
    late = [(1001, START, 1, "a"), (1002, START + dt.timedelta(days=41), 9, "a")]
    got, n = streamed(spark, str(tmp_path), [rows[:100], rows[100:], last, late], EVENTS, lambda s: windows(s, late="3 days"))
    want = windows(spark.createDataFrame([*rows, *last], EVENTS))
    key = lambda frame: sorted(map(tuple, frame.filter(frame["start"] < F.lit(START + dt.timedelta(days=30))).collect()), key=str)
    assert key(got) == key(want) and n >= 1


def test_a_join_of_streams_equals_that_of_tables(spark, tmp_path):
    r = random.Random(7)
    rows = [(r.choice("ab"), START + dt.timedelta(minutes=30 * i + r.randint(0, 20)), r.choice(["try", "came"])) for i in range(80)]
    schema = "key string, at timestamp, kind string"

    def joined(frame, late=None):
        tried = frame.filter("kind = 'try'").select("key", F.col("at").alias("tried"))
        came = frame.filter("kind = 'came'").select("key", F.col("at").alias("came"), F.col("kind").alias("note"))
        return answered(tried, came, "2 hours", late)

    got, n = streamed(spark, str(tmp_path), [rows[:40], rows[40:]], schema, lambda s: joined(s, "1 hour"))
    assert sorted(map(str, got.collect())) == sorted(map(str, joined(spark.createDataFrame(rows, schema)).collect())) and n == 0


def test_sketches_unite(spark):
    rows = spark.range(30_000).select((F.col("id") % 3).alias("day"), (F.col("id") % 20_000).alias("host"))
    made = reports.distinct_sketches(rows, ["day"], "host")
    n = reports.united_counts(made.withColumn("all", F.lit(1)), ["all"]).first().n
    assert abs(n - 20_000) < 20_000 * 4 * 1.04 / 64


def test_links_are_resolved_as_before(spark):
    rows = [
        ("a/../b/./c?x=1#y", "https://H.es:443/p/q?z=1#f", "https://h.es/p/b/c?x=1#y"),
        ("//other.org/x/..", "http://h.es/", "http://other.org/"),
        ("#top", "https://h.es/p?q=1", "https://h.es/p?q=1#top"),
        ("?n=2", "https://h.es/p?q=1", "https://h.es/p?n=2"),
        ("HTTPS://USER@X.es", "https://h.es/", "https://x.es/"),
        ("tel:1", "https://h.es/", "tel:1"),
        ("x", "nothing", None),
        ("/a.b/..c", "https://h.es", "https://h.es/a.b/..c"),
        ("", "https://h.es/p", "https://h.es/p"),
        (None, "https://h.es/p", None),
        (" /a b\tc\n ", "https://h.es/", "https://h.es/a%20bc"),
        ("x\\y\\..\\z?q=\\", "https://h.es/p/", "https://h.es/p/x/z?q=\\"),
        ("/canción/日本?ñ='a b'#é `x`", "https://h.es/", "https://h.es/canci%C3%B3n/%E6%97%A5%E6%9C%AC?%C3%B1=%27a%20b%27#%C3%A9%20%60x%60"),
        ("https://Ñandú.es/ñ", "https://h.es/", "https://ñandú.es/%C3%B1"),
        ("https:\\\\h.es\\a", "https://x.es/", "https://h.es/a"),
        ("/😀{}", "https://h.es/", "https://h.es/%F0%9F%98%80%7B%7D"),
        ("javascript:a('b c')", "https://h.es/", "javascript:a('b c')"),
        ("/100%|^", "https://h.es/", "https://h.es/100%|^"),
    ]
    got = spark.createDataFrame(rows, "link string, base string, to string").select("to", urls.resolve(F.col("link"), F.col("base")).alias("x")).collect()
    assert [r.x for r in got] == [r.to for r in got]


def test_accents_of_all_scripts_go(spark):
    names = ["ÁÉÍ ñ ç ǖ ṩ", "Ἀθῆναι", "Йод ё", "Ångström Ệ", "Zażółć", "ﬁ ß ø ł đ", "é", "日本", "한국"]
    want = ["aei n c u s", "αθηναι", "иод е", "angstrom e", "zazołc", "ﬁ ß ø ł đ", "e", "日本", "한국"]
    got = spark.createDataFrame([(n,) for n in names], "n string").select(rx.strip_accents(F.col("n")).alias("x")).collect()
    assert [r.x for r in got] == want
