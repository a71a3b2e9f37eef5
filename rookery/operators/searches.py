"""Search queries planned for countries and cities, and how far they got."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rx, urls, values


def terms_for(cc: Column, lang: Column) -> Column:
    """The terms of a country: its own, else its language's, else English ones."""
    of = lambda words: F.array(*map(F.lit, words))
    out = F.when(cc == "BR", of(values.TERMS_OF_BRAZIL))
    for language, words in values.TERMS.items():
        out = out.when(lang == language, of(words))
    return out.otherwise(of(values.TERMS["English"]))


def contact_word(cc: Column, lang: Column) -> Column:
    out = F.when(cc == "BR", values.CONTACT_WORD_OF_BRAZIL)
    for language, word in values.CONTACT_WORD.items():
        out = out.when(lang == language, word)
    return out.otherwise(values.CONTACT_WORD["English"])


def twin_cities(countries: DataFrame, cities: DataFrame) -> DataFrame:
    """``cc, twin``: the city that has its country's name, if there is one."""
    named = F.broadcast(countries.select("cc", F.col("name").alias("twin")))
    return cities.select("cc", F.col("name").alias("city")).join(named, "cc").filter("city = twin").select("cc", "twin").distinct()


def planned_queries(countries: DataFrame, cities: DataFrame) -> DataFrame:
    """``cc, query, city, also, rank, i``: country-wide queries first (rank 0), then each city's by its rank.

    A twin city has no queries of its own; the country-wide ones name it in ``also``.  Each place carries its terms as an
    array, so nothing is multiplied by a join.
    """
    own = countries.select("cc", "lang", F.col("name").alias("country"))
    wide = own.join(F.broadcast(twin_cities(countries, cities)), "cc", "left").select(
        "cc",
        "lang",
        F.col("country").alias("place"),
        F.lit("").alias("city"),
        F.col("twin").alias("also"),
        F.lit(0).alias("rank"),
    )
    each = cities.select(
        "cc",
        F.col("name").alias("place"),
        F.col("rank").cast("int").alias("rank"),
    ).join(F.broadcast(own), "cc").filter("place <> country")
    each = each.select("cc", "lang", "place", F.col("place").alias("city"), F.lit(None).cast("string").alias("also"), "rank")
    asked = wide.unionByName(each).select(
        "cc",
        "lang",
        "place",
        "city",
        "also",
        "rank",
        F.posexplode(terms_for(F.col("cc"), F.col("lang"))).alias("i", "term"),
    )
    return asked.select(
        "cc",
        F.concat_ws(" ", "term", "place", contact_word(F.col("cc"), F.col("lang"))).alias("query"),
        "city",
        "also",
        "rank",
        "i",
    )


def candidates(results: DataFrame, known: DataFrame) -> DataFrame:
    """``cc, host, url, query, rank`` of search results ``cc, query, rank, url`` that are worth a look.

    Of a country's results on one host only the first by query and rank is looked at; hosts of ``known(host)`` go, and so do
    results that are never a club's site, listings and public bodies.
    """
    rows = results.withColumn("host", urls.host_of(F.col("url"))).filter("host <> ''")
    first = rows.groupBy("cc", "host").agg(
        F.min_by(F.struct("url", "query", "rank"), F.struct("query", "rank", "url")).alias("x")
    ).select("cc", "host", "x.*")
    new = first.join(known.select("host").distinct(), "host", "left_anti")
    never = rx.like(F.col("url"), values.NOT_A_CLUB_SITE) | rx.like(F.col("url"), values.AGGREGATOR) | rx.like(F.col("url"), values.PUBLIC_DOMAIN)
    return new.filter(~never).select("cc", "host", "url", "query", "rank")


def summed_stats(stats: DataFrame, found: DataFrame, twins: DataFrame) -> DataFrame:
    """``cc, city, searches, found`` after a round: sums by city ('' is country-wide); a twin's searches are set to the country's, never added."""
    total = stats.unionByName(found).groupBy("cc", "city").agg(F.sum("searches").alias("searches"), F.sum("found").alias("found"))
    wide = total.filter("city = ''").select("cc", F.col("searches").alias("wide")).join(F.broadcast(twins), "cc").select("cc", F.col("twin").alias("city"), "wide")
    return total.join(wide, ["cc", "city"], "full").select(
        "cc",
        "city",
        F.coalesce("wide", "searches").alias("searches"),
        F.coalesce("found", F.lit(0)).alias("found"),
    )


def coverage(countries: DataFrame, cities: DataFrame, stats: DataFrame, done: DataFrame, city_emails: DataFrame) -> DataFrame:
    """``cc, cities, searched, searches_done, searches, found, emails`` of every country.

    ``stats(cc, city, searches, found)``, ``done(cc, query)``, ``city_emails(country, city, emails)``; no country is shown
    beyond its plan.
    """
    planned = cities.groupBy("cc").agg(F.count("*").alias("cities"))
    met = stats.groupBy("cc").agg(F.count_if(F.col("city") != "").alias("searched"), F.sum("found").alias("found"))
    asked = done.groupBy("cc").agg(F.count("*").alias("asked"))
    mails = city_emails.groupBy(F.col("country").alias("name")).agg(F.sum("emails").alias("emails"))
    rows = countries.join(planned, "cc", "left").join(met, "cc", "left").join(asked, "cc", "left").join(mails, "name", "left").join(twin_cities(countries, cities), "cc", "left")
    n = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    target = F.size(terms_for(F.col("cc"), F.col("lang"))) * (1 + n("cities") - F.when(F.col("twin").isNull(), 0).otherwise(1))
    return rows.select(
        "cc",
        n("cities").alias("cities"),
        n("searched").alias("searched"),
        F.least(n("asked"), target).alias("searches_done"),
        target.alias("searches"),
        n("found").alias("found"),
        n("emails").alias("emails"),
    )


def display_order(rows: DataFrame, cities: DataFrame) -> DataFrame:
    """``rows(cc, city, ...)`` with ``place``, their number in their country: listed cities by rank, then others by Unicode collation."""
    listed = cities.select("cc", F.col("name").alias("city"), "rank")
    order = Window.partitionBy("cc").orderBy(F.coalesce("rank", F.lit(1_000_000_000)), F.collate("city", "UNICODE"), "city")
    return rows.join(listed, ["cc", "city"], "left").withColumn("place", F.row_number().over(order)).drop("rank")


def first_cities(cities: DataFrame, n: int = 30) -> DataFrame:
    """``cc, cities``: the names of the ``n`` largest in order."""
    top = cities.filter(F.col("rank") <= n).groupBy("cc").agg(F.array_sort(F.collect_list(F.struct("rank", "name"))).alias("c"))
    return top.select("cc", F.transform("c", lambda x: x["name"]).alias("cities"))
