"""Stores: one JSON object read in blocks, keyed records added to in rounds."""

import json

import pytest
from pyspark.sql import functions as F

from rookery import sources
from rookery.catalogue import inline as V
from rookery.operators import merge
from rookery.sources import files
from rookery.sources.keyed_store import KeyedStore
from rookery.streaming import rounds

SF = "/root/testdata/sf0.001"

ODD = {
    'a}b"{': {"name": 'x}{\\"', "tags": ["]", "}"], "in": {"p": {"q": "}"}}},
    "b": {"name": None, "tags": [], "in": {"p": {}}},
    "": {"name": "\\"},
    "é": {"name": "ü\n}", "in": {}},
    "c": {},
    "number": 7,
    'd\\"': {"name": '{["', "tags": ['\\"}', "[[{"]},
}
RECORD = "name string, tags array<string>, in struct<p:struct<q:string>>"


@pytest.fixture
def cut(spark):
    """Files are split at every so many bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def to(size):
        spark.conf.set(names[0], f"{size}b")
        spark.conf.set(names[1], "0")

    yield to
    for n, v in before.items():
        spark.conf.set(n, v)


@pytest.mark.parametrize("indent", [None, 1])
@pytest.mark.parametrize("size", [3, 7, 4096])
def test_a_json_object_cut_anywhere_equals_the_whole(spark, tmp_path, cut, indent, size):
    path = str(tmp_path / "store.json")
    (tmp_path / "store.json").write_text(json.dumps(ODD, indent=indent, ensure_ascii=indent is None) + ("\n" if indent else ""))
    whole = spark.read.option("wholetext", True).text(path)
    one = F.from_json("value", f"map<string,struct<{RECORD}>>")
    plain = {k: v for k, v in ODD.items() if isinstance(v, dict)}
    cut(size)
    got = sources.json_store(spark, path, RECORD, place=True).orderBy("place").collect()
    assert [r.key for r in got] == list(plain)
    (tmp_path / "plain.json").write_text(json.dumps(plain))
    whole = spark.read.option("wholetext", True).text(str(tmp_path / "plain.json"))
    want = whole.select(F.explode(one).alias("key", "r")).select("key", "r.*").collect()
    assert sorted(map(str, want)) == sorted(str(r).replace(str(r)[4 : str(r).index("key=")], "") for r in got)


def test_several_and_broken_json_objects(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.json").write_text("\n".join(json.dumps({f"k{i}{j}": {"n": j}, f"m{i}{j}": {"n": None}}) for j in range(4)))
    got = sources.json_store(spark, str(tmp_path), "n int").collect()
    assert sorted((r.key, r.n) for r in got) == sorted((f"{k}{i}{j}", j if k == "k" else None) for i in range(3) for j in range(4) for k in "km")
    for i, text in enumerate(['{"a":{"n":1}', '{"a":{"n":1', "", "[]", "{}", "no json", '{"a":{"n":1},"b":{"n":2}']):
        (tmp_path / "broken").mkdir(exist_ok=True)
        (tmp_path / "broken" / "x.json").write_text(text)
        assert sources.json_store(spark, str(tmp_path / "broken"), "n int").collect() == [], text
    assert sources.json_store(spark, str(tmp_path / "none.json"), "n int").collect() == []


def rows(frame):
    return sorted(map(tuple, frame.select(sorted(frame.columns)).collect()), key=str)


BATCHES = (("map", 0), ("register", 1), ("leads", 2), ("prospect", 3), ("harvest", 4))


def batches(spark):
    """Parts of new records with mixed blanks, each under another rule."""
    every = V.NEW.spark(spark, SF).unionByName(V.STORE.spark(spark, SF)).withColumn("n", F.abs(F.hash("key", "email", "ord")) % 5)
    every = every.withColumn("ord", F.xxhash64("key", "ord", "email", "name"))
    return [(s, every.filter(F.col("n") == i).drop("n")) for s, i in BATCHES]


def test_mixed_folds_equal_one_upsert_after_another(spark):
    want, sides = batches(spark)[0][1].limit(0), None
    for i, (source, batch) in enumerate(batches(spark)):
        want = merge.upsert(want, batch, source)
        own = batch.withColumns({"side": F.lit(i), "source": F.lit(source)})
        sides = own if sides is None else sides.unionByName(own)
    assert rows(merge.fold(sides)) == rows(want)


def test_a_keyed_store_equals_one_upsert_after_another(spark, tmp_path):
    path, schema = str(tmp_path / "store"), batches(spark)[0][1].schema
    store = KeyedStore(spark, path, schema, buckets=8, least=20)
    assert store.read().count() == 0
    want = spark.createDataFrame([], schema)
    for i, (source, batch) in enumerate(batches(spark)):
        assert store.add(batch, source, "s", i)
        want = merge.upsert(want, batch, source)
    assert rows(store.read()) == rows(want)
    m = store.manifest()
    assert m.base and m.number == 5 and set(m.base) | set(m.deltas) <= set(range(8))
    # a batch that comes again, and another store object of the same path
    again = KeyedStore(spark, path)
    assert not again.add(batches(spark)[4][1], "harvest", "s", 4)
    assert again.manifest() == m and rows(again.read()) == rows(want)
    # one record touches one bucket: no base is written, all other files stay as they are
    one = batches(spark)[0][1].limit(1)
    assert again.add(one, "map", "s", 5)
    after = again.manifest()
    assert after.base == m.base and [b for b in after.deltas if after.deltas[b] != m.deltas.get(b, [])] == [
        one.select(F.pmod(F.xxhash64("key"), F.lit(8))).first()[0]
    ]
    before = rows(again.read())
    again.clean(keep=1)
    assert rows(again.read()) == before and files.names_in(spark, f"{path}/manifests") == [f"{6:012d}.json"]


def test_of_two_writers_the_second_fails_and_changes_nothing(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "store"), batches(spark)[0][1].schema, buckets=2)
    stale = store.manifest()
    store.add(batches(spark)[0][1], "map")
    held = rows(store.read())
    store.manifest, manifest = lambda: stale, store.manifest
    with pytest.raises(Exception, match="(?i)exist"):
        store.add(batches(spark)[1][1], "map")
    store.manifest = manifest
    assert rows(store.read()) == held
    with pytest.raises(ValueError):
        KeyedStore(spark, str(tmp_path / "other"))


def test_rounds_of_a_stream_with_a_restart(spark, tmp_path):
    schema = batches(spark)[0][1].schema
    for i, (_, batch) in enumerate(batches(spark)[:3]):
        batch.coalesce(1).write.parquet(str(tmp_path / "in" / f"part={i}"))
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in/part=*")
        rounds(stream, str(tmp_path / "store"), "map", str(tmp_path / "c"), buckets=4).awaitTermination(120)
    want = spark.createDataFrame([], schema)
    for _, batch in batches(spark)[:3]:
        want = merge.upsert(want, batch, "map")
    store = KeyedStore(spark, str(tmp_path / "store"))
    assert rows(store.read()) == rows(want) and store.manifest().batches == {str(tmp_path / "c"): 2}
