"""Queries on records made of the given tables, and on some written-out ones for the edges: planned searches, their coverage, split scans and registers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sources
from ..functions import values
from ..operators import merge, reports, searches
from . import inline as V

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


_COUNTRIES = V.Table("cc string, name string, lang string", *values.COUNTRIES).sql
_TERMS = V.Table(
    "cc string, lang string, terms array<string>, word string",
    ("BR", None, values.TERMS_OF_BRAZIL, values.CONTACT_WORD_OF_BRAZIL),
    *((None, lang, words, values.CONTACT_WORD[lang]) for lang, words in values.TERMS.items()),
).sql
#: each country with its terms, contact word and twin city
_PLAN = f"""(select c.*, coalesce(own.terms, t.terms, en.terms) terms, coalesce(own.word, t.word, en.word) word, p.name twin from {_COUNTRIES} c
    left join {_TERMS} own on own.cc = c.cc left join {_TERMS} t on t.lang = c.lang left join {_TERMS} en on en.lang = 'English'
    left join {V.PLACES.sql} p on p.cc = c.cc and p.name = c.name)"""


@_query(f"""with p as (select cc, name place, '' city, twin also, 0 rank, terms, word from {_PLAN}
    union all select p.cc, c.name, c.name, null, c.rank, terms, word from {V.PLACES.sql} c join {_PLAN} p on p.cc = c.cc where c.name <> p.name)
    select cc, unnest(terms) || ' ' || place || ' ' || word query, city, also, rank, cast(generate_subscripts(terms, 1) - 1 as int) i from p""")
def planned_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All queries of all countries in their order."""
    return searches.planned_queries(sources.countries(spark), V.PLACES.spark(spark, sf_dir))


@_query(f"""with t as (select cc, city, cast(sum(searches) as bigint) s, cast(sum(found) as bigint) f from (from {V.STATS.sql} union all from {V.ROUND.sql}) group by all),
    w as (select t.cc, twin city, s from t join {_PLAN} p on p.cc = t.cc where city = '' and twin is not null)
    select cc, city, coalesce(w.s, t.s) searches, coalesce(f, 0) found from t full join w using (cc, city)""")
def search_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Searches and finds by city after a round."""
    twins = searches.twin_cities(sources.countries(spark), V.PLACES.spark(spark, sf_dir))
    return searches.summed_stats(V.STATS.spark(spark, sf_dir), V.ROUND.spark(spark, sf_dir), twins)


@_query(f"""select p.cc, coalesce(n, 0) cities, coalesce(s, 0) searched, least(coalesce(d, 0), len(terms) * (1 + coalesce(n, 0) - case when twin is null then 0 else 1 end)) searches_done,
    len(terms) * (1 + coalesce(n, 0) - case when twin is null then 0 else 1 end) searches, coalesce(f, 0) found, coalesce(e, 0) emails from {_PLAN} p
    left join (select cc, count(*) n from {V.PLACES.sql} group by 1) using (cc) left join (select cc, count(*) filter (city <> '') s, cast(sum(found) as bigint) f from {V.STATS.sql} group by 1) using (cc)
    left join (select cc, count(*) d from {V.ASKED.sql} group by 1) using (cc) left join (select country "name", count(*) e from {V.STORE.sql} where coalesce(city, '') <> '' and coalesce(email, '') <> '' group by 1) using ("name")""")
def search_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the searches of each country got."""
    return searches.coverage(
        sources.countries(spark),
        V.PLACES.spark(spark, sf_dir),
        V.STATS.spark(spark, sf_dir),
        V.ASKED.spark(spark, sf_dir),
        reports.city_emails(V.STORE.spark(spark, sf_dir)),
    )


@_query(
    f"select s.cc, s.city, s.searches, row_number() over (partition by s.cc order by coalesce(rank, 1000000000), lower(strip_accents(s.city))) place from {V.STATS.sql} s left join {V.PLACES.sql} p on p.cc = s.cc and p.name = s.city where s.city <> ''"
)
def city_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cities in the order in which they are shown."""
    shown = searches.display_order(V.STATS.spark(spark, sf_dir).filter("city <> ''"), V.PLACES.spark(spark, sf_dir))
    return shown.select("cc", "city", "searches", F.col("place").cast("bigint").alias("place"))


@_query(f"select cc, string_agg(name, '|' order by rank) cities from {V.PLACES.sql} where rank <= 2 group by 1")
def first_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two largest cities of each country."""
    return searches.first_cities(V.PLACES.spark(spark, sf_dir), 2).select("cc", F.array_join("cities", "|").alias("cities"))


@_query(f"select cc, relation, relation + 3600000000 area from {V.AREAS.sql} where not done")
def open_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas that a split scan has still to read."""
    areas = V.AREAS.spark(spark, sf_dir)
    return sources.open_areas(
        areas.select("cc", "relation"),
        areas.filter("done").select("cc", sources.area_id(F.col("relation")).alias("area")),
    )


@_query(f"select page, id from {V.LISTED.sql} where id not in (select id from {V.READ.sql})")
def unread_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a register walk has still to read."""
    return sources.unread_ids(V.LISTED.spark(spark, sf_dir), V.READ.spark(spark, sf_dir))


@_query(
    f"select error, regexp_matches(coalesce(error, ''), '504|timed out|out of memory|cut the query short', 'i') too_big from {V.ERRORS.sql}"
)
def too_big_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors after which a country is split."""
    return V.ERRORS.spark(spark, sf_dir).select("error", sources.is_too_big(F.col("error")).alias("too_big"))


@_query(f"select arg_max(value, ord) line from {V.LOG.sql} where contains(value, 'https://a/1')")
def last_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last line on one page."""
    return sources.last_check(V.LOG.spark(spark, sf_dir), "ord", "https://a/1")


@_query(f"select string_agg(cc || '×' || n, ' ' order by n desc, cc) line from (select cc, count(*) n from {V.STORE.sql} group by 1)")
def seed_counts_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by country in one line."""
    return reports.seed_counts_line(V.STORE.spark(spark, sf_dir).groupBy("cc").agg(F.count("*").alias("n")))


@_query(
    f"select country, count(*) leads, count(*) filter (coalesce(searched, '') <> '') searched, count(*) filter (coalesce(website, '') <> '') found from {V.LEADS.sql} where coalesce(country, '') <> '' group by 1"
)
def leads_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leads by country."""
    return reports.leads_by_country(V.LEADS.spark(spark, sf_dir))
