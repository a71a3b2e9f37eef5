"""Queries on the given tables: the same operators at volume."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sources
from ..functions import emails, html, rx, urls, values
from ..operators import merge, reports, schedule
from ..plans import judging
from ..streaming import tumbling

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(sql: str | None, *names: str):
    def register(f: Callable[..., DataFrame]) -> Callable:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(*(spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names))
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


_A = r"""<a\b[^>]*href=["'']([^"'']+)["''][^>]*>([\s\S]*?)</a>"""
_ORIGIN = r"regexp_extract(url, '^[a-z]+://[^/?#]*')"
_ESCAPED = "array_to_string(list_transform(regexp_extract_all(h, '.'), lambda c: case when c > '~' then url_encode(c) else c end), '')"  # as browsers do
_LINKS = f"""select page_id, i - 1 as place, case when starts_with(h, '/') then {_ORIGIN} || {_ESCAPED} else {_ESCAPED} end link,
    trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '<[^>]+>', ' ', 'g'), '&nbsp;', ' ', 'gi'), '&[a-z]+;', ' ', 'gi'), '\\s+', ' ', 'g')) as label
    from (select page_id, url, unnest(regexp_extract_all(html, '{_A}', 1, 'i')) h, unnest(regexp_extract_all(html, '{_A}', 2, 'i')) t, generate_subscripts(regexp_extract_all(html, '{_A}', 1, 'i'), 1) i from pages)"""


def _links(pages: DataFrame) -> DataFrame:
    rows = pages.select("page_id", F.posexplode(html.links(F.col("html"), F.col("url"))).alias("place", "l"))
    return rows.select(
        "page_id",
        F.col("place").cast("bigint").alias("place"),
        F.col("l.url").alias("link"),
        F.col("l.text").alias("label"),
    )


@_query(_LINKS, "pages")
def links_extract(pages: DataFrame) -> DataFrame:
    """All links of all pages."""
    return _links(pages)


@_query(f"select label, count(*) n, count(distinct page_id) pages from ({_LINKS}) group by 1", "pages")
def link_text_count(pages: DataFrame) -> DataFrame:
    """How often a link text comes."""
    return _links(pages).groupBy("label").agg(F.count("*").alias("n"), F.count_distinct("page_id").alias("pages"))


_HOST = r"regexp_replace(regexp_extract(lower(url), '^[a-z]+://([^/?#:]*)', 1), '^www\.', '')"


@_query(f"select page_id, {_HOST} host from pages", "pages")
def host_of_page(pages: DataFrame) -> DataFrame:
    """Hosts of pages."""
    return pages.select("page_id", urls.host_of(F.col("url")).alias("host"))


@_query(f"select {_HOST} host, count(*) pages, min(page_id) first_page, sum(length(html))::bigint chars from pages group by 1", "pages")
def site_rollup(pages: DataFrame) -> DataFrame:
    """Pages by host."""
    return pages.groupBy(urls.host_of(F.col("url")).alias("host")).agg(
        F.count("*").alias("pages"),
        F.min("page_id").alias("first_page"),
        F.sum(F.char_length("html")).alias("chars"),
    )


_PLAIN = r"regexp_replace(regexp_replace({0}, '&amp;', '&', 'gi'), '&nbsp;', ' ', 'gi')"


@_query(
    f"select page_id, trim(regexp_replace(regexp_replace({_PLAIN.format('t')}, '&[a-z]+;', ' ', 'gi'), '\\s+', ' ', 'g')) title from (select page_id, regexp_extract(html, '<title[^>]*>([\\s\\S]{{0,200}}?)</title>', 1, 'i') t from pages)",
    "pages",
)
def page_title(pages: DataFrame) -> DataFrame:
    """Titles of pages."""
    return pages.select("page_id", html.title_of(F.col("html")).alias("title"))


@_query(
    r"select page_id, length(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '<script[\s\S]*?</script>', ' ', 'gi'), '<style[\s\S]*?</style>', ' ', 'gi'), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g'))::bigint chars from pages",
    "pages",
)
def page_text_len(pages: DataFrame) -> DataFrame:
    """Length of each page's visible text."""
    return pages.select("page_id", F.char_length(html.text_of(F.col("html"))).cast("bigint").alias("chars"))


@_query(
    rf"select doc_id, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(text, '{values.EMAIL}', 0, 'i'), lambda e: lower(e)))), ' ') emails from documents where regexp_matches(text, '{values.EMAIL}', 'i')",
    "documents",
)
def emails_raw(documents: DataFrame) -> DataFrame:
    """Addresses in documents, before any is judged; the plain pattern only."""
    found = F.array_distinct(F.transform(rx.all_of(F.col("text"), values.EMAIL), F.lower))
    return documents.filter(F.col("text").contains("@")).select(
        "doc_id",
        F.array_join(F.array_sort(found), " ").alias("emails"),
    ).filter("emails <> ''")


def _i(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "', 'i'"


# a club's own name as a link text, by the rules for sports and private clubs
_CLUB_LIKE = f"""length(label) between 4 and 90 and regexp_matches(label, {_i('|'.join((values.TENNIS, values.PADEL, values.PADEL_TENNIS, values.SQUASH)))})
    and not regexp_matches(label || '  ', {_i(values.PUBLIC)}) and regexp_matches(label || '  ', {_i(values.CLUB_WORD)})"""
_SPELT = "html"
for _p, _to in values.SPELT_OUT:
    _SPELT = f"regexp_replace({_SPELT}, '{_p}', '{_to}', 'gi')"
_EMAILS = f"""(select page_id, count(distinct e) emails from (select page_id, regexp_replace(regexp_replace(lower(e), '^[^a-z0-9]+|[^a-z0-9._%+@-]+$', '', 'g'), '[.]$', '') e from (
    select page_id, unnest(list_concat(regexp_extract_all(html, '{values.EMAIL}', 0, 'i'), regexp_extract_all({_SPELT}, '{values.EMAIL}', 0, 'i'))) e from pages))
    where regexp_full_match(e, '{values.EMAIL}', 'i') and length(e) < 80 and not regexp_matches(e, {_i(values.JUNK_EMAIL)}) and not regexp_matches(e, {_i(values.NO_REPLY)}) group by 1)"""
_COUNTS = f"""(select p.page_id page, p.url, html, coalesce(n, 0)::int links, coalesce(internal, 0)::int internal, coalesce(external, 0)::int external, coalesce(emails, 0)::int emails from pages p
    left join (select page_id, count(*) n from ({_LINKS}) group by 1) using (page_id) left join {_EMAILS} using (page_id) left join (
        select page_id, count(*) filter (own) internal, count(*) filter (not own) external from (select l.page_id, starts_with(link, {_ORIGIN}) own, row_number() over (partition by l.page_id, label order by place) r
            from ({_LINKS}) l join pages using (page_id) where {_CLUB_LIKE}) where r = 1 group by 1) using (page_id))"""


@_query(
    f"select page, links, internal, external, emails, case when emails >= 3 or external >= 3 then 'GOOD' else 'MAYBE' end verdict from {_COUNTS}",
    "pages",
)
def page_audit(pages: DataFrame) -> DataFrame:
    """Counts and a verdict for every page."""
    found = F.size(emails.extract_emails(F.col("html"), urls.host_of(F.col("url"))))
    rows = pages.select(F.col("page_id").alias("page"), judging.link_counts(F.col("html"), F.col("url")).alias("c"), found.alias("emails"))
    return reports.page_audit(rows.select("page", "c.*", "emails"))


@_query(
    """with f as (select user_id::varchar email, event_id ord, event_type from events),
    a as (select email, first(event_type order by ord) src, max(ord) last, count(*) n from f group by 1 having count(*) <= 1000000),
    s as (select email, string_agg(event_type, '+' order by o) kinds from (select email, event_type, min(ord) o from f group by 1, 2) group by 1)
    select email, src, kinds from a join s using (email)""",
    "events",
)
def fold_events(events: DataFrame) -> DataFrame:
    """The published view's fold over events by user."""
    rows = events.select(
        F.col("event_id").alias("ord"),
        F.concat(F.lit("event "), "event_id").alias("name"),
        F.array("event_type").alias("sports"),
        F.lit("").alias("contact"),
        F.col("user_id").cast("string").alias("email"),
        F.lit("x").alias("lang"),
        F.lit("x").alias("country"),
        F.col("event_type").alias("src"),
        F.lit(False).alias("stale"),
    )
    return merge.publishable(rows, most=1_000_000).select("email", "src", F.array_join("sports", "+").alias("kinds"))


@_query("select c_custkey from customer c where not exists (select 1 from orders where o_custkey = c_custkey)", "customer", "orders")
def anti_new(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers that no order knows."""
    return merge.new_only(customer, orders.select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"]).select("c_custkey")


@_query("select c_custkey from customer c where exists (select 1 from orders where o_custkey = c_custkey)", "customer", "orders")
def semi_sync(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers that orders know."""
    return merge.in_sync(customer, orders.select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"], seeds_read=True).select("c_custkey")


@_query(
    """select n_name country, count(*) clubs, count(*) filter (n > 0) active, sum(n)::bigint orders, count(*) filter (c_acctbal < 0) in_debt from customer join nation on n_nationkey = c_nationkey
    left join (select o_custkey, count(*) n from orders group by 1) on o_custkey = c_custkey group by 1""",
    "customer", "nation", "orders",
)
def country_report(customer: DataFrame, nation: DataFrame, orders: DataFrame) -> DataFrame:
    """Conditional counts by country over a dimension and pre-summed facts."""
    n = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    rows = customer.join(n, "c_custkey", "left").join(nation, F.col("n_nationkey") == F.col("c_nationkey"))
    return rows.groupBy(F.col("n_name").alias("country")).agg(
        F.count("*").alias("clubs"),
        F.count_if(F.col("n") > 0).alias("active"),
        F.sum("n").alias("orders"),
        F.count_if(F.col("c_acctbal") < 0).alias("in_debt"),
    )


@_query(
    """with r as (select *, sum(case when event_type = 'error' then 0 else 1 end) over (partition by user_id order by ts, event_id rows unbounded preceding) run from events)
    select user_id, run::bigint run, count(*) length from r where event_type = 'error' group by 1, 2 having count(*) >= 2""",
    "events",
)
def failure_runs(events: DataFrame) -> DataFrame:
    """Two or more failures in a row, by user."""
    return schedule.failure_runs(events, ["user_id"], ["ts", "event_id"], F.col("event_type") != "error", 2)


@_query(
    "select o_orderkey, spent::bigint spent from (select o_orderkey, coalesce(sum(1) over (order by o_orderdate, o_orderkey rows between unbounded preceding and 1 preceding), 0) spent from orders) where spent < 5000",
    "orders",
)
def budget_prefix(orders: DataFrame) -> DataFrame:
    """The earliest orders within a budget of 5000."""
    rows = orders.select("o_orderkey", "o_orderdate", F.lit(1).cast("bigint").alias("cost"))
    return schedule.budget_prefix(rows, F.to_date("o_orderdate"), ["o_orderdate", "o_orderkey"], "cost", 5000).select("o_orderkey", "spent")


@_query(
    "select p_partkey, case when r = 1 then k else k || '#' || r end as key from (select p_partkey, p_name k, row_number() over (partition by p_name order by p_partkey) r from part)",
    "part",
)
def collision_keys(part: DataFrame) -> DataFrame:
    """Parts numbered within their names."""
    return merge.collision_keys(part, "p_name", ["p_partkey"]).select("p_partkey", "key")


@_query(
    "select c_custkey, case when regexp_matches(c_name, '[\",\\n]') then '\"' || replace(c_name, '\"', '\"\"') || '\"' else c_name end || ',' || c_mktsegment || ',' || c_nationkey line from customer",
    "customer",
)
def csv_export(customer: DataFrame) -> DataFrame:
    """Customers as lines of an extract."""
    return customer.select(
        "c_custkey",
        F.concat_ws(",", *(rx.csv_cell(F.col(c)) for c in ("c_name", "c_mktsegment", "c_nationkey"))).alias("line"),
    )


@_query(
    "select c_mktsegment segment, n_name country, count(*) n from customer join nation on n_nationkey = c_nationkey group by cube (c_mktsegment, n_name)",
    "customer",
    "nation",
)
def segment_cube(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Counts by segment and country, with all totals (an extension)."""
    rows = customer.join(nation, F.col("n_nationkey") == F.col("c_nationkey")).select(
        F.col("c_mktsegment").alias("segment"),
        F.col("n_name").alias("country"),
    )
    return rows.cube("segment", "country").agg(F.count("*").alias("n"))


@_query(
    "select time_bucket(interval 1 hour, ts)::varchar \"start\", event_type, count(*) n, round(sum(value), 4) total from events group by all",
    "events",
)
def tumbling_events(events: DataFrame) -> DataFrame:
    """Events by hour and type (an extension; the same function serves a stream)."""
    return tumbling(events).select(
        F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"),
        "event_type",
        "n",
        F.round("total", 4).alias("total"),
    )


@_query("select page_id, length(html) n_chars, md5(html) digest from pages", "pages")
def decoded_pages(pages: DataFrame) -> DataFrame:
    """Pages as bytes, decoded by the character set that they declare."""
    text = sources.decoded(F.encode("html", "UTF-8"), F.lit("text/html; charset=utf-8"))
    return pages.withColumn("t", text).select("page_id", F.char_length("t").cast("bigint").alias("n_chars"), F.md5("t").alias("digest"))


@_query(f"""select url, links, internal, external, emails, case when html = '' then 'REJECT unreadable' when internal + external = 0 and regexp_matches(html, '{values.DRAWN_BY_SCRIPT}') then 'REJECT empty/js'
    when internal + external = 0 then 'REJECT empty' when emails >= 3 or external >= 3 then 'GOOD' else 'MAYBE' end verdict from {_COUNTS}""", "pages")
def seed_check(pages: DataFrame) -> DataFrame:
    """The verdict on every page as a seed."""
    return judging.checked(pages.select("url", "html", F.lit(True).alias("allowed")))


@_query(f"""select c.url, coalesce(n, 0)::int clubs, coalesce(b, '') branches, emails, case when html = '' then 'RETRY' when regexp_matches(c.url, {_i(values.EXCLUDED_CATEGORY)}) then 'EXCLUDED' when coalesce(n, 0) >= 5 then 'SEED' else 'THIN' end verdict from {_COUNTS} c
    left join (select l.page_id, count(*) filter (not starts_with(link, {_ORIGIN}) and {_CLUB_LIKE} and not regexp_matches(link, {_i(values.PUBLIC_DOMAIN)})) n,
        string_agg(distinct regexp_replace(split_part(link, '#', 1), '/$', ''), ' ') filter (starts_with(link, {_ORIGIN}) and regexp_matches(link, '/(en|es|pt)/(Sports|Regional|Deportes|Esportes)/') and regexp_matches(link, {_i(values.RELEVANT)})) b
        from ({_LINKS}) l join pages using (page_id) group by 1) on page_id = page""", "pages")
def category_verdict(pages: DataFrame) -> DataFrame:
    """The verdict on every page as a directory's category."""
    found = judging.category_pages(pages.select("url", "html"))
    return found.select("url", "clubs", F.array_join("subcategories", " ").alias("branches"), "emails", "verdict")


_GUESSED = ", ".join(f"({i + 1000}, '{p}')" for i, p in enumerate(values.CONTACT_PATHS))


@_query(f"""with o as (select page_id, {_ORIGIN} origin from pages), c as (select page_id, place, link from ({_LINKS}) join o using (page_id) where starts_with(link, origin) and (regexp_matches(link, {_i(values.CONTACT_LINK)}) or regexp_matches(label, {_i(values.CONTACT_LINK)}))
        union all select page_id, g, origin || path from o cross join (values {_GUESSED}) v(g, path)), f as (select page_id, link, min(place) place from c group by 1, 2)
    select page_id, string_agg(link, ' ' order by place) pages from (select *, row_number() over (partition by page_id order by place) r from f) where r <= 8 group by 1""", "pages")
def contact_pages(pages: DataFrame) -> DataFrame:
    """Where each page's site may say how to reach it."""
    return pages.select("page_id", F.array_join(html.contact_pages(F.col("html"), F.col("url")), " ").alias("pages"))
