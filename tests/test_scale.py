"""Work for each row: spread over the partitions, and done once."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rookery import sources
from rookery.catalogue import QUERIES, cases
from rookery.functions import html, rx, values
from rookery.plans import records
from tests.test_library import SF


def rows_by_partition(frame) -> list[int]:
    return [r["count"] for r in frame.groupBy(F.spark_partition_id()).count().collect()]


def times_in_plan(frame, pattern: str) -> int:
    return frame._jdf.queryExecution().optimizedPlan().toString().count(pattern)


@pytest.mark.parametrize("name", ["club_candidates", "outbound_site", "page_names", "chrome_hosts"])
def test_rows_of_one_file_are_spread(spark, name):
    dealt = rows_by_partition(QUERIES[name](spark, SF))
    assert len(dealt) == 4 and max(dealt) < sum(dealt) / 2


def test_links_of_a_listing_are_found_once(spark):
    assert times_in_plan(QUERIES["club_candidates"](spark, SF), "racket|lawn tennis") == 1


def test_candidates_keep_the_first_link_of_a_text(spark):
    page = '<a href="/1">Home club</a><a href="/2">Padel Club</a><a href="https://o.es/3">Padel  Club</a><a href="https://o.es/4">Club Municipal</a><a href="https://o.es/5">Squash Centre</a><a href="/6">club</a>'
    rows = spark.createDataFrame([(page, "https://A.es:443/x"), (None, "https://a.es/"), (page, None), ("", "")], "html string, url string")
    got = [r[0] for r in rows.select(html.candidates(F.col("html"), F.col("url"))).collect()]
    assert [tuple(x) for x in got[0]] == [("Padel Club", "https://a.es/2", True), ("Squash Centre", "https://o.es/5", False), ("club", "https://a.es/6", True)]
    assert [tuple(x)[:2] for x in got[2]] == [("Padel Club", "https://o.es/3"), ("Squash Centre", "https://o.es/5")] and all(x["internal"] for x in got[2])
    assert not got[1] and [x["name"] for x in got[3]] == []


def test_rows_of_tables_are_spread(spark):
    dealt = rows_by_partition(cases.VETTED.spark(spark, SF))
    assert max(dealt) < sum(dealt) / 2


def test_a_page_is_vetted_once(spark):
    # the heading is sought for the name's candidates, for the title of the name and for that of the sports
    assert times_in_plan(QUERIES["vetted_sites"](spark, SF), "<h1") <= 3


def test_vetting_keeps_the_order_of_its_reasons(spark):
    page = "<title>{}</title><h1>Padel &amp; more</h1><p>{}</p>"
    rows = [
        ("https://a.org", "GB", "Leeds", page.format("Municipal Tennis Club Spain", "x"), None, "names Spain, not United Kingdom"),
        ("https://b.org", "GB", "Leeds", page.format("Municipal Tennis Club", "x"), None, "public/institutional: Municipal"),
        ("https://c.org", "GB", "Leeds", page.format("Tennis Club", "x"), "<style>Leeds</style>", "nothing on its pages ties it to Leeds"),
        ("https://d.org", "GB", "Leeds", page.format("Tennis Club", "x"), "in&nbsp;<b>LEEDS</b>", ""),
        ("https://e.org", "GB", "York", page.format("Tennis Club", "York"), "", "nothing on its pages ties it to York"),
        ("https://f.co.uk", "GB", None, "<h1>Start</h1><p>tennis</p>", None, 'no club signal in "Start"'),
        ("https://g.org", None, None, page.format("Tennis Club", "x"), None, ""),
    ]
    frame = spark.createDataFrame(rows, "url string, cc string, city string, html string, contact_html string, want string")
    got = records.vet(frame, sources.countries(spark)).select("url", "reason").collect()
    assert {r.url: r.reason for r in got} == {r[0]: r[5] for r in rows}


def test_a_name_is_taken_apart_once_for_all_links(spark):
    rows = spark.createDataFrame([("x", "https://a.es/", "n")], "html string, url string, name string")
    site = rows.select(html.outbound_site(F.col("html"), F.col("url"), F.array(F.lit("b.es")), F.col("name")))
    # 18 where the host is sought again for each question to it
    assert times_in_plan(site, "[^/?#@]") <= 12


@pytest.mark.parametrize(
    "name, want",
    [
        ("Abbey Tennis Club", "https://abbey.co.uk/x"),
        ("", "https://o.es/?a=1"),
        (None, "https://o.es/?a=1"),
        ("Tennis", ""),
        ("Rural Club Deva Tenis", "https://rcdt.es/"),
        ("Real Club de Tenis", ""),
        ("Chrome", ""),
    ],
)
def test_outside_links(spark, name, want):
    page = "".join(f'<a href="{u}">x</a>' for u in ("/abbey", "https://facebook.com/abbey", "ftp://abbey.es/", "https://www.chrome.es/", "https://O.es:443?a=1#f", "https://rcdt.es", "https://abbey.co.uk/x#abbey", "https://abbey.es"))
    rows = spark.createDataFrame([(page, "https://a.es/x", name)], "html string, url string, name string")
    got = rows.select(html.outbound_site(F.col("html"), F.col("url"), F.array(F.lit("chrome.es")), F.col("name")), html.chrome_hosts(F.col("html"), F.col("url"))).first()
    assert got[0] == want
    assert got[1] == ["facebook.com", "abbey.es", "chrome.es", "o.es", "rcdt.es", "abbey.co.uk"]


def test_a_register_page_is_read_once(spark):
    dealt = rows_by_partition(cases.REGISTER.spark(spark, SF))
    assert max(dealt) < sum(dealt) / 2
    assert times_in_plan(QUERIES["register_venues"](spark, SF), "<script") <= 10


def test_candidates_of_a_name_are_found_once(spark):
    # once in the page that the query puts together, once for the candidates, once for the title
    assert times_in_plan(QUERIES["page_names"](spark, SF), "<h1") <= 3


def test_any_character_is_one_range(spark):
    assert rx.SPACE not in rx.rx(values.ANCHOR)
    inner = "a\n\u00a0\u2028\U0001f3be\x00<b>\u017f</b>"
    rows = spark.createDataFrame([(f"<A href='https://o.es/'>{inner}</a><a href='/x'>y</a>",)], "html string")
    assert rows.select(rx.first(F.col("html"), values.ANCHOR, 2), rx.all_of(F.col("html"), values.ANCHOR, 1)).first()[:] == (inner, ["https://o.es/", "/x"])


@pytest.mark.parametrize("name", ["chrome_hosts", "outbound_site"])
def test_outside_links_are_found_without_their_texts(spark, name):
    frame = QUERIES[name](spark, SF)
    assert times_in_plan(frame, "&nbsp;") == 0
    # four in the spelling of odd links; 26 where a link is cut again for each question to its path
    assert times_in_plan(frame, "^[^?#]*") <= 4


def test_own_links_of_an_odd_page_lead_inside(spark):
    page = "".join(f'<a href="{u}">x</a>' for u in ("/in", "../y/./z", "https://A.es/..", "//o.es", "https://p.es:443/it's a", "#x"))
    rows = spark.createDataFrame([(page, u) for u in ("https://a.es/x", " https://a.es:443/x ", "https://a\x01.es/x", "a.es", "", None)] + [(None, "https://a.es/x")], "html string, url string")
    got = [r[0] for r in rows.select(html.chrome_hosts(F.col("html"), F.col("url"))).collect()]
    assert got == [["o.es", "p.es"]] * 3 + [[]] * 4
