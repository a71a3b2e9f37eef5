"""From map elements and candidate pages to records, or to the reason why not."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import html, rules, rx, urls, values


def from_elements(elements: DataFrame, countries: DataFrame) -> DataFrame:
    """Records of ``elements(cc, type, id, tags, lat, lon, center)`` with an ``outcome``: record, lead, rejected or none, and ``reason``."""
    t, none = F.col("tags"), F.lit("")
    tag = lambda k: F.coalesce(F.element_at(t, k), none)
    name = rx.pick(t, "name", "official_name", "alt_name")
    by_tag = rules.sports_from_tag(F.element_at(t, "sport"))
    base = elements.withColumns(
        {"name": name, "by_tag": by_tag, "website": urls.normalised_site(rx.pick(t, "contact:website", "website", "url", "contact:url"))}
    )
    base = base.withColumn("email", F.lower(F.split(rx.pick(t, "contact:email", "email", "contact:mail"), rf"[{rx.SPACE},;]+")[0]))
    base = base.withColumn(
        "sports",
        F.when(F.size("by_tag") > 0, F.col("by_tag")).otherwise(rules.detect_sports(F.concat_ws(" ", "name", tag("club")))),
    )
    about = F.concat_ws(" ", *(tag(k) for k in ("description", "club", "leisure", "access", "operator_type")))
    gate = rules.private_gate(F.col("name"), F.col("website"), F.col("email"), tag("operator"), about)
    reason = (
        F.when(gate["reason"] != "", gate["reason"])
        .when(rx.like(tag("access"), values.ACCESS_FOR_ALL), F.concat(F.lit("access="), tag("access")))
        .when(rx.like(tag("operator_type"), values.PUBLIC_OPERATOR), F.concat(F.lit("operator_type="), tag("operator_type")))
        .otherwise("")
    )
    base = base.withColumn("reason", reason)
    outcome = F.when((F.col("name") == "") | (F.size("sports") == 0), "none").when(F.col("reason") != "", "rejected").when(
        (F.col("website") == "") & (F.col("email") == ""),
        "lead",
    ).otherwise("record")
    named = base.withColumn("outcome", outcome).join(
        F.broadcast(countries.select("cc", F.col("name").alias("country"), "lang")),
        "cc",
        "left",
    )
    return named.select(
        "cc", "country", "lang", "name", "sports", "website", "email", rx.pick(t, "contact:person", "contact:name").alias("contact"), F.lit("osm").alias("src"),
        F.concat(
            F.lit("https://www.openstreetmap.org/"),
            "type",
            F.lit("/"),
            F.col("id").cast("string"),
        ).alias("srcPage"), (F.col("email") != "").alias("crawled"),
        F.coalesce("lat", "center.lat").alias("lat"), F.coalesce("lon", "center.lon").alias("lon"), rx.pick(
            t,
            "addr:city",
            "addr:town",
            "addr:suburb",
            "addr:village",
        ).alias("town"), "outcome", F.when(F.col("outcome") == "rejected", F.col("reason")).otherwise("").alias("reason"),
    )


def from_bindings(bindings: DataFrame, countries: DataFrame, known: DataFrame, sport: str) -> DataFrame:
    """``key, ord, name, cc, country, lang, sports, website, src`` of catalogue entries ``ord, item, label, web, cc`` for one sport.

    Entries need a wanted country, a name that is no number and a web host that is not among ``known(host)``, and pass the
    gate for private clubs.  Of the entries of a host the first by ``ord`` stays.
    """
    name, web = F.col("label"), F.col("web")
    fit = bindings.filter((F.coalesce(name, F.lit("")) != "") & ~rx.like(name, r"^Q\d+$", fold=False) & rules.private_gate(name, web, F.lit(""))["ok"])
    rows = fit.withColumns({"host": urls.host_of(web), "website": urls.origin_of(web)}).filter("host <> ''")
    new = rows.join(known.select("host").distinct(), "host", "left_anti")
    first = new.groupBy("host").agg(F.min_by(F.struct("ord", "label", "cc", "website"), "ord").alias("x")).select("host", "x.*")
    own = F.broadcast(countries.select("cc", F.col("name").alias("country"), "lang"))
    return first.join(own, "cc").select(
        F.concat(F.lit("w:"), "host").alias("key"),
        "ord",
        F.col("label").alias("name"),
        "cc",
        "country",
        "lang",
        F.array(F.lit(sport)).alias("sports"),
        "website",
        F.lit("wikidata").alias("src"),
    )


def vet(candidates: DataFrame, countries: DataFrame) -> DataFrame:
    """``candidates(url, cc, city, html, contact_html)`` with ``name, sports, website`` and the first ``reason`` against them ('' if none).

    ``html`` is null for what could not be fetched; ``contact_html`` is the text of contact pages, read only for the doubtful.
    """
    own = countries.select("cc", F.col("name").alias("country"))
    rows = candidates.join(F.broadcast(own), "cc", "left").withColumns(
        {"website": urls.origin_of(F.col("url")), "host_cc": urls.country_of_host(urls.host_of(F.col("url")))}
    )
    rows = rows.withColumns({"name": html.page_name(F.col("html")), "body": html.text_of(F.coalesce("html", F.lit("")))})
    rows = rows.withColumn("sports", rules.detect_sports(F.concat_ws(" ", html.title_of(F.col("html")), "name", "body")))
    name, quoted = F.col("name"), lambda before: F.concat(F.lit(before + ': "'), F.col("name"), F.lit('"'))
    other = rules.names_other_country(name, F.col("cc"))
    gate = rules.private_gate(name, F.col("website"), F.lit(""))
    plain = lambda text: F.concat(F.lit(" "), F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    text = plain(F.concat_ws(" ", "body", html.text_of(F.coalesce("contact_html", F.lit("")))))

    def untied(words: Column) -> Column:
        says = lambda place: F.coalesce(words.contains(plain(place)), F.lit(False))
        tied = (F.col("host_cc") == F.col("cc")) | says(F.col("country")) | (F.coalesce(F.char_length("city") >= 5, F.lit(False)) & says(F.col("city")))
        return F.when(~tied, F.concat(F.lit("nothing on its pages ties it to "), F.coalesce(F.nullif("city", F.lit("")), "country"))).otherwise("")

    # each of the last three is found once, and only where nothing before it is against the site
    last = F.when(F.col("host_cc") == F.col("cc"), "").otherwise(rx.let(text, untied))
    last = rx.let(gate["reason"], lambda r: F.when(r != "", r).otherwise(last))
    last = rx.let(other, lambda o: F.when(o.isNotNull(), F.concat(F.lit("names "), o, F.lit(", not "), F.col("country"))).otherwise(last))
    reason = (
        F.when(F.col("website") == "", "bad url")
        .when((F.col("host_cc") != "") & (F.col("host_cc") != F.col("cc")), F.concat(F.lit("domain belongs to "), F.col("host_cc")))
        .when(F.coalesce("html", F.lit("")) == "", "unreachable")
        .when(rules.is_challenge(F.col("html")), "blocked by a challenge page")
        .when(name == "", "no name on the page")
        .when(F.size("sports") == 0, "no racket sport on the page")
        .when(rx.like(name, values.LISTING_NAME), quoted("a listing of clubs, not one"))
        .when(rx.like(name, r"^[a-z0-9.-]+\.[a-z]{2,}$"), quoted("the title is a domain, not a club"))
        .when(F.size(F.split(name, " ")) > 8, "title is a description, not a name")
        .when(~rx.like(name, values.CLUB_WORD), F.concat(F.lit('no club signal in "'), name, F.lit('"')))
        .otherwise(last)
    )
    return rows.select("url", "cc", "city", "name", "sports", "website", reason.alias("reason"))
