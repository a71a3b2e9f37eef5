"""Queries on records made of the given tables, and on some written-out ones for the edges: the domain's rules, merges, places and schedules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sources
from ..functions import emails, rules, values
from ..operators import merge, places, reports, schedule
from ..plans import walk
from . import inline as V

Query = Callable[[SparkSession, str], DataFrame]
NOW = 1772539200000  # 2026-03-03 12:00 UTC
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        name = f.__name__.lstrip("_")
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return register


_PRIORITY_SQL = "(select cc, prio from (select unnest([" + ", ".join(f"'{c}'" for c in values.PRIORITY) + "]) cc, unnest(range(1, 94)) prio))"
_CODES_SQL = "(" + ", ".join(f"'{c}'" for c, *_ in values.COUNTRIES) + ")"

_FIT = f"(select *, lower(email) e from {V.STORE.sql} where coalesce(name, '') <> '' and coalesce(email, '') <> '' and coalesce(lang, '') <> '' and len(sports) > 0)"


@_query(
    f"""with f as {_FIT}, s as (select e, string_agg(s, '+' order by ord, i) sports from (select e, s, min(ord) ord, arg_min(i, (ord, i)) i from (select e, ord, unnest(sports) s, generate_subscripts(sports, 1) i from f) group by e, s) group by e),
    a as (select e, arg_min(lang, ord) lang, arg_min(country, ord) country, first(src order by ord) src, first(coalesce(stale, false) order by ord) stale,
        coalesce(arg_min(contact, ord) filter (coalesce(contact, '') <> ''), '') contact, first(name order by length(name) desc, ord) "name" from f group by e having count(*) <= 5)
    select "name", sports, contact, e email, lang, country, src, stale from a join s using (e)"""
)
def publishable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published view."""
    return merge.publishable(V.STORE.spark(spark, sf_dir)).withColumn("sports", F.array_join("sports", "+")).orderBy(*merge.published_order())


def _upsert_sql() -> str:
    return f"""with b as (select *, 0 side from {V.STORE.sql} union all select *, 1 from {V.NEW.sql}),
    g as (select key, first("name" order by side, ord) "name", first(email order by side, ord) e0, first(website order by side, ord) w0, first(contact order by side, ord) c0, first(crawled order by side, ord) r0,
        first(email order by side, ord) filter (coalesce(email, '') <> '') e1, first(website order by side, ord) filter (coalesce(website, '') <> '') w1, first(contact order by side, ord) filter (coalesce(contact, '') <> '') c1 from b group by key),
    s as (select key, string_agg(s, '+' order by o) sports from (select key, s, min((side, ord, i)) o from (select key, side, ord, unnest(sports) s, generate_subscripts(sports, 1) i from b) group by key, s) group by key)
    select key, "name", coalesce(e1, e0) email, coalesce(w1, w0) website, coalesce(c1, c0) contact, case when coalesce(e0, '') = '' and e1 is not null then true else r0 end crawled, sports from g join s using (key)"""


@_query(_upsert_sql())
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New records merged by the rule of map imports."""
    out = merge.upsert(V.STORE.spark(spark, sf_dir), V.NEW.spark(spark, sf_dir), "map")
    return out.select("key", "name", "email", "website", "contact", "crawled", F.array_join("sports", "+").alias("sports"))


@_query(f"""select id, concat_ws('+', case when regexp_matches(name, '\\bt[eéê]nn?is|lawn tennis', 'i') and not (regexp_matches(name, 'p[aá]d(el|dle)[\\s-]*tennis', 'i') and not regexp_matches(regexp_replace(name, 'p[aá]d(el|dle)[\\s-]*tennis', ' ', 'i'), '\\bt[eéê]nn?is|lawn tennis', 'i')) then 'Tennis' end,
    case when regexp_matches(name, 'p[aá]del|p[aá]d(el|dle)[\\s-]*tennis', 'i') then 'Padel' end, case when regexp_matches(name, '\\bsquash', 'i') then 'Squash' end) sports from {V.NAMES.sql}""")
def sports_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sports by name."""
    return V.NAMES.spark(spark, sf_dir).select("id", F.array_join(rules.detect_sports(F.col("name")), "+").alias("sports"))


@_query(f"""select tag, concat_ws('+', case when (regexp_matches(t, '(^|;|\\s)tennis(;|$|\\s)') and not regexp_matches(regexp_replace(t, '(^|;)tennis(;|$)', ''), 'padel|paddle')) or (regexp_matches(t, '\\btennis\\b') and not regexp_matches(t, 'padel|paddle')) then 'Tennis' end,
    case when regexp_matches(t, 'padel|paddle') then 'Padel' end, case when regexp_matches(t, 'squash') then 'Squash' end) sports from (select tag, lower(coalesce(tag, '')) t from {V.TAGS.sql})""")
def tag_sports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sports by tag."""
    return V.TAGS.spark(spark, sf_dir).select("tag", F.array_join(rules.sports_from_tag(F.col("tag")), "+").alias("sports"))


def _pattern(p: str) -> str:
    return "'" + p.replace("'", "''") + "', 'i'"


_GATE = f"""select id, case when trim(name) = '' then 'no name' when regexp_matches(name || '  ', {_pattern(values.PUBLIC)}) then 'public/institutional: ' || regexp_extract(name || '  ', {_pattern(values.PUBLIC)[:-5]}, 0, 'i')
    when regexp_matches(website, {_pattern(values.PUBLIC_DOMAIN)}) then 'public domain' when regexp_matches(split_part(email, '@', 2), {_pattern(values.PUBLIC_DOMAIN)}) then 'public email domain'
    when not regexp_matches(name || '  ', {_pattern(values.CLUB_WORD)}) then 'no club signal in name' else '' end reason from {V.NAMES.sql}"""


@_query(_GATE)
def private_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why a name, site and address are no private club."""
    gate = rules.private_gate(F.col("name"), F.col("website"), F.col("email"))
    return V.NAMES.spark(spark, sf_dir).select("id", gate["reason"].alias("reason"))


@_query(
    f"select regexp_replace(regexp_replace(reason, ' \".*\"', ''), ': .*', '') reason, count(*) n from ({_GATE}) where reason <> '' group by 1 order by n desc, min(id) limit 3"
)
def gate_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent reasons."""
    gate = rules.private_gate(F.col("name"), F.col("website"), F.col("email"))
    rows = V.NAMES.spark(spark, sf_dir).select("id", gate["reason"].alias("why"))
    return reports.top_reasons(rows, F.regexp_replace(rules.normalised_reason(F.col("why")), ": .*", ""), "id", 3)


@_query(
    f"select code, coalesce(list_aggregate(list_transform(range(3, length(code), 2), lambda i: chr(xor(('0x' || substr(code, i, 2))::int, ('0x' || substr(code, 1, 2))::int))), 'string_agg', ''), '') as text from {V.CODES.sql}"
)
def cf_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hidden addresses."""
    return V.CODES.spark(spark, sf_dir).select("code", emails.cf_decode(F.col("code")).alias("text"))


@_query(
    f"select country, count(*) total, count(*) filter (coalesce(email, '') <> '') with_email, count(*) filter (coalesce(email, '') = '' and coalesce(website, '') <> '' and coalesce(attempts, 0) < 4) queued from {V.STORE.sql} group by rollup (country)"
)
def country_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by country, and in all."""
    return reports.country_counts(V.STORE.spark(spark, sf_dir))


_OPEN = "coalesce(email, '') = '' and coalesce(website, '') <> ''"


@_query(
    f"select count(*) filter ({_OPEN} and coalesce(attempts, 0) < 4 and coalesce(retryAfter, 0) <= {NOW}) ready, count(*) filter ({_OPEN} and coalesce(retryAfter, 0) > {NOW}) waiting, count(*) filter ({_OPEN} and coalesce(attempts, 0) >= 4) exhausted from {V.STORE.sql}"
)
def crawl_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ready, waiting, exhausted."""
    return reports.crawl_buckets(V.STORE.spark(spark, sf_dir), F.lit(NOW))


@_query(f"""select key, a attempts from (select *, case when {_OPEN} and coalesce(attempts, 0) >= 4 and (lastTried is null or {NOW} - epoch_ms(lastTried::timestamp) > 30 * 86400000::bigint) then 3 else coalesce(attempts, 0) end a from {V.STORE.sql})
    where {_OPEN} and a < 4 and coalesce(retryAfter, 0) <= {NOW}""")
def retry_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records to crawl now."""
    return schedule.crawl_due(V.STORE.spark(spark, sf_dir), F.lit(NOW)).select("key", "attempts")


@_query(
    f"select key, case when g then 0 else coalesce(attempts, 0) end attempts from (select *, coalesce({_OPEN} and (crawlNote = 'no email published' or coalesce(attempts, 0) >= 3), false) g from {V.STORE.sql})"
)
def requeue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts after giving up is taken back."""
    return schedule.requeued(V.STORE.spark(spark, sf_dir)).select("key", "attempts")


@_query(f"""with r as (select p.cc, prio, "at", error, epoch_ms("at"::timestamp) ms, coalesce(split, false) part from {_PRIORITY_SQL} p left join {V.STATE.sql} s on s.cc = p.cc),
    t as (select *, case when "at" is null or (error is not null and (part or {NOW} - ms >= 20 * 60000)) then 1 when error is null then 2 end tier from r)
    select cc, tier from t where tier is not null order by tier, case when tier = 1 then prio else ms end, prio limit 92""")
def next_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order of imports."""
    return schedule.next_countries(sources.countries(spark).select("cc", "prio"), V.STATE.spark(spark, sf_dir), F.lit(NOW), 92)


@_query(
    f"""select count(*) filter ("at" is not null and error is null) imported, count(*) filter (error is not null) failed, count(*) filter ("at" is null) pending, count(*) total, arg_max(error, "at") filter (error is not null) last_error from {_PRIORITY_SQL} p left join {V.STATE.sql} s using (cc)"""
)
def import_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far imports have come."""
    return reports.import_summary(sources.countries(spark).select("cc", "prio"), V.STATE.spark(spark, sf_dir))


_DIMENSION = f"""(select cc, name, population, row_number() over (partition by cc order by population desc, first_ord) rank from (
    select *, row_number() over (partition by cc, lower(name) order by population desc, ord) r, min(ord) over (partition by cc, lower(name)) first_ord
    from {V.CITIES.sql} where population >= 20000 and cc in {_CODES_SQL}) where r = 1)"""


@_query(f"select cc, name, population, rank from {_DIMENSION}")
def city_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest place of each name, ranked."""
    return places.cities(V.CITIES.spark(spark, sf_dir), sources.countries(spark)).select(
        "cc",
        "name",
        "population",
        F.col("rank").cast("bigint").alias("rank"),
    )


_FLAT = "trim(regexp_replace(strip_accents(lower({0})), '[^a-z0-9]+', ' ', 'g'))"


@_query(f"""with d as (select *, {_FLAT.format("name")} flat from {_DIMENSION}), b as (select cc, strip_accents(lower(name)) plain, arg_max(name, rank) city from d group by all),
    r as (select *, ' ' || {_FLAT.format("name")} || ' ' padded from {V.RECORDS.sql}), w as (select key, b.city by_town from r join b on b.cc = r.cc and plain = strip_accents(lower(town))),
    n as (select key, first(d.name order by length(flat) desc, rank) by_name from r join d on d.cc = r.cc and length(flat) >= 4 and contains(padded, ' ' || flat || ' ') group by 1),
    c as (select g.cc, b.city, g.lat, g.lon, g.ord from {V.CITIES.sql} g join b on b.cc = g.cc and plain = strip_accents(lower(g.name))),
    k as (select key, c.city as city, c.ord, sqrt(((c.lon - r.lon) * 111 * cos(radians(r.lat))) ** 2 + ((c.lat - r.lat) * 111) ** 2) km from r join c on c.cc = r.cc where r.lat is not null),
    p as (select key, first(city order by km, ord) by_place from k where km < 30 group by 1)
    select key, coalesce(nullif(city, ''), by_town, by_name, by_place) city, case when coalesce(city, '') <> '' then 'own' when by_town is not null then 'town' when by_name is not null then 'name' when by_place is not null then 'near' else 'none' end "method"
    from r left join w using (key) left join n using (key) left join p using (key)""")
def city_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each record is, and how that was found."""
    return places.place(V.RECORDS.spark(spark, sf_dir), V.CITIES.spark(spark, sf_dir), sources.countries(spark))


@_query(
    f"""with t as (select *, case when own and local then 1 when own then 2 when platform then 3 end tier from {V.RESULTS.sql} where rank <= 10) select lead, first(url order by tier, query, rank) url, min(tier) tier from t where tier is not null group by lead"""
)
def site_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The site of each lead."""
    return schedule.pick_site(V.RESULTS.spark(spark, sf_dir), ["lead"])


@_query(
    f"with recursive r as (select 'a' node, 0 depth union select dst, depth + 1 from r join {V.EDGES.sql} e on e.src = r.node where depth < 40) select node, min(depth) depth from r group by 1"
)
def walk_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a walk reaches."""
    return walk.reach(V.EDGES.spark(spark, sf_dir), spark.createDataFrame([("a",)], "node string"))


@_query(
    f"select upper(regexp_extract(trim(value), '^(AUTO|[A-Za-z]{{2}})\\s+(https?://\\S+)$', 1)) cc, regexp_extract(trim(value), '^(AUTO|[A-Za-z]{{2}})\\s+(https?://\\S+)$', 2) url from {V.LINES.sql} where upper(regexp_extract(trim(value), '^(AUTO|[A-Za-z]{{2}})\\s+(https?://\\S+)$', 1)) in ('AUTO', {_CODES_SQL[1:]}"
)
def seed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeds of a list."""
    return sources.seeds(V.LINES.spark(spark, sf_dir))


@_query(
    f"select split_part(value, ' ', 2) url, arg_max(split_part(value, ' ', 1), ord) verdict from {V.LOG.sql} where contains(value, ' ') group by 1"
)
def log_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last verdict on each page."""
    return sources.verdicts(V.LOG.spark(spark, sf_dir), "ord")


@_query(f"""with h as (select regexp_replace(regexp_replace(regexp_replace(trim(lower(unnest(string_split(name_value, chr(10))))), '^\\*\\.', ''), '^www\\d*\\.', ''), '{values.PLUMBING}', '', 'i') host from {V.HOSTS.sql}),
    t as (select host, case when regexp_extract(host, '[^.]*$') = 'uk' then 'GB' else upper(regexp_extract(host, '[^.]*$')) end cc, regexp_extract(host, '[^.]*$') tld from h)
    select distinct host, cc from t where contains(host, '.') and contains(host, 'padel') and regexp_matches(host, '^[a-z0-9.-]+$') and cc in {_CODES_SQL} and tld not in ({", ".join(f"'{t}'" for t in values.VANITY_TLDS)})""")
def certificate_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts of certificates, by word."""
    return sources.certificate_hosts(V.HOSTS.spark(spark, sf_dir), "padel")


@_query(
    f"select country, city, count(*) emails from {V.STORE.sql} where coalesce(city, '') <> '' and coalesce(email, '') <> '' group by all"
)
def city_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses by city."""
    return reports.city_emails(V.STORE.spark(spark, sf_dir))


@_query(
    f"select country, count(*) clubs, count(*) filter (coalesce(email, '') <> '') emails, count(*) filter (coalesce(website, '') <> '') sites, count(*) filter (coalesce(crawlNote, '') <> '') \"read\", count(*) filter (crawlNote = 'unreachable') unreachable, count(*) filter (crawlNote = 'no email published') no_address, count(*) filter (list_contains(sports, 'Tennis')) tennis, count(*) filter (list_contains(sports, 'Padel')) padel, count(*) filter (list_contains(sports, 'Squash')) squash, any_value(s.sources) sources from {V.STORE.sql} left join (select country, string_agg(src || '=' || n, ' ' order by src) sources from (select country, coalesce(src, '?') src, count(*) n from {V.STORE.sql} where coalesce(email, '') <> '' group by all) group by 1) s using (country) where coalesce(country, '') <> '' group by country"
)
def country_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage by country."""
    slots = reports.country_slots(V.STORE.spark(spark, sf_dir))
    pairs = F.transform(F.array_sort(F.map_entries("sources")), lambda x: F.concat(x["key"], F.lit("="), x["value"].cast("string")))
    return slots.withColumn("sources", F.array_join(pairs, " "))


@_query(
    f"select count(*) total, count(*) filter (known) already, count(*) filter (not known and wanted) to_add, count(*) filter (not known and not wanted) unknown_country from (select coalesce(lower(n.email) in (select lower(email) from {V.STORE.sql} where email is not null), false) known, country in ({', '.join(repr(n) for _, n, _ in values.COUNTRIES)}) wanted from {V.NEW.sql} n)"
)
def restore_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a restore would do."""
    return reports.restore_counters(V.NEW.spark(spark, sf_dir), V.STORE.spark(spark, sf_dir), sources.countries(spark))
