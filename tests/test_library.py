import json

import pytest
from pyspark.sql import functions as F

from rookery import sources
from rookery.catalogue import QUERIES, SQL
from rookery.catalogue import inline as V
from rookery.functions import emails, html, rules, rx, urls, values
from rookery.operators import merge, places, reports, schedule
from rookery.plans import judging, records, walk
from rookery.sources.keyed_store import KeyedStore
from rookery.streaming import first_seen, rounds, tumbling
from tests.oracle import same

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    same(spark, SF, QUERIES[name], SQL[name])


def one(spark, column, **values_):
    return spark.range(1).select(*(F.lit(v).alias(k) for k, v in values_.items())).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "name, sports",
    [
        ("Tênis Clube de Santos", ["Tennis"]),
        ("Padel Tennis Club", ["Padel"]),
        ("Tennis and Padel Tennis Club", ["Tennis", "Padel"]),
        ("Tennisworld", ["Tennis"]),
    ],
)
def test_sports(spark, name, sports):
    assert one(spark, rules.detect_sports(F.col("n")), n=name) == sports


@pytest.mark.parametrize(
    "name, url, ok",
    [
        ("Club de Tenis Pontevedra", "https://clubdetenispontevedra.es", True),
        ("Club de Tenis Amurrio", "https://ctamurrio.com", True),
        ("Club X", "https://iberdrola.es", False),
    ],
)
def test_plausible_site(spark, name, url, ok):
    assert one(spark, rules.plausible_site(F.col("n"), F.col("u")), n=name, u=url) is ok


@pytest.mark.parametrize(
    "title, name",
    [("Home - Tênis Clube de Santos", "Tênis Clube de Santos"), ("lapala club, pádel en Quito", "lapala club"), ("", "")],
)
def test_name_from_title(spark, title, name):
    assert one(spark, html.name_from_title(F.col("t")), t=title) == name


@pytest.mark.parametrize(
    "text, host, found",
    [
        ("info [at] miclub [dot] es", "", ["info@miclub.es"]),
        ("x@gmail.com info@miclub.es", "www.miclub.es", ["info@miclub.es", "x@gmail.com"]),
        ("someone@mail2.example.com", "", []),
        ('<a href="mailto:A%40b.es">', "", ["a@b.es"]),
        ('<a href="mailto:100%">', "", []),
    ],
)
def test_emails(spark, text, host, found):
    assert one(spark, emails.extract_emails(F.col("t"), F.col("h")), t=text, h=host) == found


@pytest.mark.parametrize(
    "link, to",
    [
        ("/a/../b", "https://h.es/b"),
        ("c?d#e", "https://h.es/x/c?d#e"),
        ("//k.es/z", "https://k.es/z"),
        ("../q", "https://h.es/q"),
        ("?p=2", "https://h.es/x/y?p=2"),
        ("HTTP://K.es", "http://k.es/"),
    ],
)
def test_resolve(spark, link, to):
    assert one(spark, urls.resolve(F.col("l"), F.col("b")), l=link, b="https://h.es/x/y") == to


@pytest.mark.parametrize("host, cc", [("club.co.uk", "GB"), ("x.tv", ""), ("x.com", ""), ("https://www.a.es/b", "ES")])
def test_country_of_host(spark, host, cc):
    assert one(spark, urls.country_of_host(F.col("h")), h=host) == cc


def test_small_functions(spark):
    assert one(spark, emails.site_from_email(F.col("e")), e="info@tegvitoria.com") == "https://tegvitoria.com"
    assert one(spark, emails.site_from_email(F.col("e")), e="x@gmail.com") == ""
    assert one(spark, rx.csv_cell(F.col("e")), e='a"b') == '"a""b"'
    assert one(spark, html.decode_entities(F.col("e")), e="a&#233;b &amp; &nbsp;c&lt;") == "aéb & c"
    assert one(spark, rules.is_challenge(F.col("e")), e='<meta http-equiv="refresh" content="0;/.well-known/sgcaptcha/">')
    assert one(spark, urls.key_for(F.lit(""), F.lit(""), F.lit("GB"), F.col("n"), False), n="Tênis Club") == "n:GB:tnisclub"
    assert one(spark, urls.country_of_path(F.col("u")), u="https://d.org/Europe/Espa%C3%B1a/x") == "ES"
    assert one(spark, urls.normalised_site(F.col("u")), u="www.club.es/, other") == "http://club.es".replace("club", "www.club")


def test_country_table():
    assert len(values.COUNTRIES) == len(values.PRIORITY) == 93
    assert {c for c, *_ in values.COUNTRIES} == set(values.PRIORITY)


def test_merge_is_idempotent_and_empty_tables_work(spark):
    store = V.STORE.spark(spark, SF)
    once = merge.upsert(store, V.NEW.spark(spark, SF), "map")
    twice = merge.upsert(once, V.NEW.spark(spark, SF), "map")
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
    empty = store.limit(0)
    assert merge.upsert(empty, empty, "harvest").count() == merge.publishable(empty).count() == 0
    addresses = [r.email for r in merge.publishable(once).collect()]
    assert len(addresses) == len(set(addresses))


def test_map_elements(spark):
    rows = [
        ("ES", "node", 1, {"name": "Club de Tenis X", "sport": "tennis", "website": "www.x.es"}),
        ("ES", "node", 2, {"name": "Club Padel Y", "sport": "padel", "addr:city": "Vigo"}),
        ("ES", "way", 3, {"name": "Polideportivo Z", "sport": "tennis"}),
        ("ES", "way", 4, {"sport": "tennis"}),
    ]
    table = spark.createDataFrame(
        [(c, t, i, tags, 1.0, 2.0, None) for c, t, i, tags in rows],
        "cc string, type string, id bigint, tags map<string,string>, lat double, lon double, center struct<lat:double,lon:double>",
    )
    got = {r.srcPage[-1]: (r.outcome, r.website, r.town) for r in records.from_elements(table, sources.countries(spark)).collect()}
    assert got == {"1": ("record", "http://www.x.es", ""), "2": ("lead", "", "Vigo"), "3": ("rejected", "", ""), "4": ("none", "", "")}


def test_vetting_gives_the_first_reason(spark):
    page = "<title>{}</title><p>padel in Spain</p>"
    rows = [
        ("https://a.es", page.format("Padel Club A")),
        ("https://b.pt", page.format("B Club")),
        ("https://c.es", None),
        ("https://d.es", page.format("Find a padel club")),
        ("https://e.es", page.format("Padel Club South Africa")),
        ("nonsense", "x"),
        ("https://f.com", page.format("Hotel F")),
    ]
    table = spark.createDataFrame(
        [(u, "ES", "", h, None) for u, h in rows],
        "url string, cc string, city string, html string, contact_html string",
    )
    got = {r.url: r.reason for r in records.vet(table, sources.countries(spark)).collect()}
    assert got["https://a.es"] == ""
    assert got["https://b.pt"] == "domain belongs to PT"
    assert got["https://c.es"] == "unreachable"
    assert got["https://d.es"].startswith("a listing of clubs")
    assert got["https://e.es"] == "names South Africa, not Spain"
    assert got["nonsense"] == "bad url"
    assert got["https://f.com"] == 'no club signal in "Hotel F"'


def test_walk_without_edges(spark):
    edges = V.EDGES.spark(spark, SF).limit(0)
    assert walk.reach(edges, spark.createDataFrame([("z",)], "node string")).count() == 1


def test_windows_of_a_stream_equal_those_of_the_table(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = tumbling(stream).writeStream.outputMode("complete").format("memory").queryName("hours").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert {
        (r.start, r.event_type, r.n) for r in spark.table("hours").collect()
    } == {(r.start, r.event_type, r.n) for r in tumbling(events).collect()}


def test_rounds_equal_one_merge(spark, tmp_path):
    new = V.NEW.spark(spark, SF)
    new.repartition(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(new.schema).parquet(str(tmp_path / "in"))
    rounds(stream, str(tmp_path / "store"), "map", str(tmp_path / "c")).awaitTermination(120)
    stored = KeyedStore(spark, str(tmp_path / "store")).read()
    want = merge.upsert(V.STORE.spark(spark, SF).limit(0), new, "map")
    assert {r.key: r.sports for r in stored.collect()} == {r.key: r.sports for r in want.collect()}


@pytest.mark.parametrize(
    ("body", "kind", "text"),
    [
        ("tênis".encode(), "text/html; charset=utf-8", "tênis"),
        (b"\xef\xbb\xbfok \xff", "text/html", "ok �"),
        ("“pádel” €".encode("cp1252"), "text/html; charset=ISO-8859-1", "“pádel” €"),
        (b'<meta charset="latin1">\x93\x81', None, '<meta charset="latin1">“\x81'),
        (
            '<meta http-equiv="x" content="text/html; charset=koi8-r">Теннис'.encode("koi8-r"),
            "",
            '<meta http-equiv="x" content="text/html; charset=koi8-r">Теннис',
        ),
        ("é".encode(), "text/html; charset=nonsense", "é"),
        ("é".encode(), "text/html; charset=cp99999", "é"),
        (b"", None, ""),
        (None, "text/html; charset=koi8-r", None),
    ],
)
def test_character_sets(spark, body, kind, text):
    rows = spark.createDataFrame([(body, kind)], "body binary, kind string")
    assert rows.select(sources.decoded(F.col("body"), F.col("kind"))).first()[0] == text


def test_seeds_are_checked(spark):
    clubs = "".join(f'<a href="https://c{i}.es/">Club de Tenis {i}</a>' for i in range(5))
    pages = [
        ("https://d.org/a", clubs + '<a href="/x">Club de Tenis 0</a>', True),
        ("https://d.org/b", '<a href="/1">Padel Club One</a>', True),
        ("https://d.org/c", "<script>window.__DATA</script>", True),
        ("https://d.org/d", "<p>nothing</p>", True),
        ("https://d.org/e", None, True),
        ("https://d.org/f", clubs, False),
    ]
    got = {
        r.url[-1]: (r.internal, r.external, r.verdict) for r in judging.checked(
            spark.createDataFrame(pages, "url string, html string, allowed boolean")
        ).collect()
    }
    assert got == {
        "a": (0, 5, "GOOD"),
        "b": (1, 0, "MAYBE"),
        "c": (0, 0, "REJECT empty/js"),
        "d": (0, 0, "REJECT empty"),
        "e": (0, 0, "REJECT unreadable"),
        "f": (0, 5, "REJECT robots"),
    }


def test_categories_are_judged(spark):
    clubs = "".join(f'<a href="https://c{i}.es/">Club de Tenis {i}</a>' for i in range(5))
    inside = '<a href="/en/Sports/Tennis/Clubs/#top">t</a><a href="/en/Sports/Tennis/Clubs">t</a><a href="/en/Sports/Chess/">c</a><a href="/fr/Sports/Tennis/">f</a>'
    pages = [
        ("https://d.org/en/Sports/Tennis/", clubs + inside),
        ("https://d.org/en/Sports/Tennis/Instruction/", inside),
        ("https://d.org/en/Sports/Squash/", '<a href="https://s.com/">Squash Club</a>'),
        ("https://d.org/en/x", ""),
    ]
    got = {
        r.url: (r.clubs, r.subcategories, r.verdict) for r in judging.category_pages(
            spark.createDataFrame(pages, "url string, html string")
        ).collect()
    }
    branch = ["https://d.org/en/Sports/Tennis/Clubs"]
    assert got == {
        pages[0][0]: (5, branch, "SEED"),
        pages[1][0]: (0, branch, "EXCLUDED"),
        pages[2][0]: (1, [], "THIN"),
        pages[3][0]: (0, [], "RETRY"),
    }


def test_register_venues(spark):
    sites = V.SITES.spark(spark, SF).withColumns({"cc": F.lit("GB"), "city": F.lit(""), "contact_html": F.lit("")})
    found = judging.from_register(V.VENUES.spark(spark, SF), records.vet(sites, sources.countries(spark)))
    got = {r.id: (r.name, r.sports, r.website, r.email, r.reason) for r in found.collect()}
    assert got["v1"] == ("Abbey Tennis Club", ["Tennis"], "https://abbey.co.uk", "sec@abbey.co.uk", "")
    assert got["v2"] == ("Bushey Tennis Club", ["Tennis"], "https://3tenn.co.uk", "", "")
    assert got["v3"][4] == "no club signal in name"
    assert got["v4"][2:] == ("", "", "no email and no website")
    assert got["v5"][4] == "unreachable" and got["v6"][4] == "no name on the page"
    assert got["v7"][4] == "no club signal in name; its site: no racket sport on the page"


def test_contact_pages(spark):
    page = '<a href="/kontakt">x</a><a href="/who">About us</a><a href="https://other.es/contact">y</a><a href="/news">n</a>'
    rows = spark.createDataFrame([(page, "https://a.es/x/y")], "html string, url string")
    got = rows.select(html.contact_pages(F.col("html"), F.col("url"))).first()[0]
    assert got == [
        "https://a.es" + p for p in (
            "/kontakt",
            "/who",
            "/contato",
            "/fale-conosco",
            "/faleconosco",
            "/fale-com-a-gente",
            "/atendimento",
            "/contact",
        )
    ]


def test_site_summary(spark):
    found = json.loads(QUERIES["site_summary"](spark, SF).first().line)
    published = QUERIES["publishable"](spark, SF).collect()
    assert found["count"] == len(published) == sum(found["byCountry"].values())
    assert set(found["bySport"]) == {"Tennis", "Padel", "Squash"}
    empty = reports.site_summary(merge.publishable(V.STORE.spark(spark, SF).limit(0))).first()
    assert (empty["count"], empty["byCountry"], empty["bySport"]) == (0, {}, {"Tennis": 0, "Padel": 0, "Squash": 0})


@pytest.mark.parametrize(
    ("reason", "places", "plain"),
    [
        ('a listing of clubs, not one: "X "', True, "a listing of clubs, not one:"),
        ('a "b" c "d"', True, 'a c "d"'),
        ("nothing on its pages ties it to Leeds", True, "nothing on its pages ties it"),
        ("ties it to Leeds", False, "ties it to Leeds"),
        ("", True, ""),
    ],
)
def test_reasons_without_particulars(spark, reason, places, plain):
    assert one(spark, rules.normalised_reason(F.col("r"), places), r=reason) == plain


def test_stores_and_extracts(spark, tmp_path):
    assert sources.json_store(spark, str(tmp_path / "missing.json"), "name string").collect() == []
    (tmp_path / "store.json").write_text('{"a": {"name": "A"}, "b": {"name": null}}')
    (tmp_path / "broken.json").write_text('{"a": {"na')
    assert {tuple(r) for r in sources.json_store(spark, str(tmp_path / "store.json"), "name string").collect()} == {("a", "A"), ("b", None)}
    assert sources.json_store(spark, str(tmp_path / "broken.json"), "name string").collect() == []
    (tmp_path / "site.json").write_text('{"clubs": [\n{"name": "A", "email": "a@b.es"},\n{"name": "B"}]}')
    assert {
        r.name for r in sources.published_extract(spark, str(tmp_path / "site.json"), "name string, email string").collect()
    } == {"A", "B"}
    (tmp_path / "none.json").write_text('{"clubs": []}')
    with pytest.raises(ValueError):
        sources.published_extract(spark, str(tmp_path / "none.json"), "name string")


def test_a_place_list_becomes_the_city_dimension(spark, tmp_path):
    line = lambda name, lat, lon, cc, n: "\t".join(["1", name, "", "", str(lat), str(lon), "", "", cc, "", "", "", "", "", str(n)])
    lines = [
        line("Leeds", 53.8, -1.5, "GB", 500000),
        line("leeds", 50.0, 0.5, "GB", 20),
        line("York", 53.9, -1.0, "GB", 500000),
        line("Léon", 47, 2, "FR", 90000),
        line("León", 42.6, -5.5, "ES", 120000),
        line("Leon", 37, -5, "ES", 30000),
        line("X", 1, 1, "GB", "many"),
    ]
    (tmp_path / "places.tsv").write_text("\n".join(lines))
    geo = sources.geonames(spark, str(tmp_path / "places.tsv"))
    cities = places.cities(geo, sources.countries(spark))
    assert {(r.cc, r.name, r["rank"]) for r in cities.collect()} == {
        ("GB", "Leeds", 1),
        ("GB", "York", 2),
        ("ES", "León", 1),
        ("ES", "Leon", 2),
    }
    assert places.by_plain_name(cities).filter("cc = 'ES'").first().city == "Leon"  # the smaller one of a plain name
    rows = [
        ("a", "GB", "Club", None, 50.01, 0.5, None),
        ("b", "ES", "Club", "LEÓN", None, None, None),
        ("c", "GB", "Club", None, 50.5, 0.5, None),
    ]
    records_ = spark.createDataFrame(rows, "key string, cc string, name string, town string, lat double, lon double, city string")
    got = {r.key: (r.city, r.method) for r in places.place(records_, geo, sources.countries(spark)).collect()}
    assert got == {"a": ("Leeds", "near"), "b": ("Leon", "town"), "c": (None, "none")}


def test_nearest_equals_all_distances(spark):
    import math
    import random

    rng = random.Random(4)
    there = [("XX", f"c{i}", rng.uniform(-88, 88), rng.uniform(-180, 180), i) for i in range(400)] + [
        ("XX", f"n{i}", 60 + rng.uniform(-1, 1), 10 + rng.uniform(-2, 2), 1000 + i) for i in range(60)
    ]
    points = [(i, "XX", lat + rng.uniform(-0.4, 0.4), lon + rng.uniform(-0.8, 0.8)) for i, (_, _, lat, lon, _) in enumerate(there)]
    got = {
        r.k: r.city for r in places.nearest(
            spark.createDataFrame(points, "k long, cc string, lat double, lon double"),
            spark.createDataFrame(there, "cc string, city string, lat double, lon double, ord long"),
            ["k"],
        ).collect()
    }
    want = {}
    for k, _, lat, lon in points:
        km, _, city = min((math.hypot((x - lon) * math.cos(math.radians(lat)) * 111, (y - lat) * 111), o, c) for _, c, y, x, o in there)
        if km < 30:
            want[k] = city
    assert got == want and len(want) > 50


def test_rounds_take_turns(spark):
    assert schedule.phase_order(1) == ("prospect", "crawl") and schedule.phase_order(2) == ("crawl", "prospect")
    waits = spark.createDataFrame([(1,), (3,), (40,)], "n int").select(schedule.failure_wait(F.col("n")).alias("w"))
    assert [r.w for r in waits.collect()] == [5_000, 15_000, 60_000]


def test_keys_of_a_stream_are_met_once(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet").withColumn("at", F.col("ts").cast("timestamp"))
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = first_seen(stream, ["user_id", "event_type"], "3650 days").writeStream.format("memory").queryName("firsts").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    got = [(r.user_id, r.event_type) for r in spark.table("firsts").collect()]
    assert len(got) == len(set(got)) and set(got) == {
        (r.user_id, r.event_type) for r in events.select("user_id", "event_type").distinct().collect()
    }
