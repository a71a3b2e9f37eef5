"""Merges by every rule, reports, schedules and verdicts on records made of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import sources
from ..functions import values
from ..operators import merge, reports, schedule, searches
from ..plans import judging, records
from ..streaming import attempted
from . import inline as V
from .domain import _CODES_SQL, _FIT, _PRIORITY_SQL, NOW
from .inline import Table, _at
from .planning import _COUNTRIES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _query(sql: str):
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return register


def _merge(rule: str) -> None:
    """A query that merges new records by a rule, and its SQL."""
    r = merge.RULES[rule]
    blank = lambda c: f"coalesce({c}, '') <> ''"
    first = ", ".join(
        f'first({c} order by side, ord) {c}0, first({c} order by side, ord) filter ({blank(c)}) {c}1' for c in ("email", "website", "contact")
    )
    out = ", ".join(f"coalesce({c}1, {c}0) {c}" if c in r.fills else f"{c}0 {c}" for c in ("email", "website", "contact"))
    crawled = "case when coalesce(email0, '') = '' and email1 is not null then true else r0 end" if r.email_crawls else "r0"
    sports = "s.sports" if r.sports else "array_to_string(s0, '+')"
    SQL[f"merge_{rule}"] = f"""with b as (select *, 0 side from {V.STORE.sql} union all select *, 1 from {V.NEW.sql}),
        g as (select key, first(crawled order by side, ord) r0, first(sports order by side, ord) s0, {first} from b group by key),
        s as (select key, string_agg(x, '+' order by o) sports from (select key, x, min((side, ord, i)) o from (select key, side, ord, unnest(sports) x, generate_subscripts(sports, 1) i from b) group by key, x) group by key)
        select key, {out}, {crawled} crawled, {sports} sports from g join s using (key)"""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = merge.upsert(V.STORE.spark(spark, sf_dir), V.NEW.spark(spark, sf_dir), rule)
        return out.select("key", "email", "website", "contact", "crawled", F.array_join("sports", "+").alias("sports"))

    QUERIES[f"merge_{rule}"] = run


for _rule in merge.RULES:
    _merge(_rule)

_PUBLISHED = f"""(select e, first(name order by length(name) desc, ord) "name", arg_min(country, ord) country, first(src order by ord) src from {_FIT} group by e having count(*) <= 5)"""
_SPORTS_OF = f"(select e, s from (select e, unnest(sports) s from {_FIT}) join {_PUBLISHED} using (e) group by all)"


def _published(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.publishable(V.STORE.spark(spark, sf_dir))


@_query(f"select country, count(*) n from {_PUBLISHED} group by 1")
def published_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published records by country."""
    return reports.by_country(_published(spark, sf_dir))


@_query(
    f"select count(*) filter (s = 'Tennis') \"Tennis\", count(*) filter (s = 'Padel') \"Padel\", count(*) filter (s = 'Squash') \"Squash\" from {_SPORTS_OF}"
)
def published_by_sport(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published records by sport, zeros included."""
    return reports.by_sport(_published(spark, sf_dir))


@_query(f"""select '{{"count":' || (select count(*) from {_PUBLISHED}) || ',"byCountry":{{' || (select string_agg('"' || country || '":' || n, ',' order by country) from (select country, count(*) n from {_PUBLISHED} group by 1))
    || '}},"bySport":{{' || (select string_agg('"' || x || '":' || (select count(*) from {_SPORTS_OF} where s = x), ',' order by i) from (values (1, 'Tennis'), (2, 'Padel'), (3, 'Squash')) v(i, x)) || '}}}}' line""")
def site_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The site's figures as one JSON line."""
    return reports.site_summary(_published(spark, sf_dir)).select(F.to_json(F.struct("count", "byCountry", "bySport")).alias("line"))


@_query(f"""with s as (select e, string_agg(s, '+' order by o) sports from (select e, s, min((ord, i)) o from (select e, ord, unnest(sports) s, generate_subscripts(sports, 1) i from {_FIT}) group by e, s) group by e),
    c as (select e, coalesce(arg_min(contact, ord) filter (coalesce(contact, '') <> ''), '') contact from {_FIT} group by e)
    select "name" || ',' || sports || ',' || contact || ',' || e || ',' || country "value" from {_PUBLISHED} join s using (e) join c using (e)""")
def extract_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published view as lines of an extract."""
    return merge.csv_lines(_published(spark, sf_dir))


QUEUE = Table(
    "url string, cc string, done boolean, pagesRead int, lastRun string",
    ("https://a/1", "AUTO", None, None, None),
    more=f"select 'https://q/' || cast(p_partkey as string) url, {_at('ES,GB,AUTO,BR', 'p_partkey % 4')} cc, p_partkey % 3 = 0 done, cast(p_partkey % 9 as int) pagesRead, case when p_partkey % 5 > 0 then '2026-01-' || lpad(cast(1 + p_partkey % 28 as string), 2, '0') end lastRun from {{part}}",
)
MINE = Table(
    "word string, pending array<string>, added int",
    ("none", None, None),
    more="select 'w' || cast(p_partkey as string) word, split('a.es,b.es', ',') pending, cast(p_partkey % 4 as int) added from {part}",
)
OUTCOMES = Table(
    "outcome string, email string",
    ("added", "a@b.es"),
    more=f"select {_at('added,merged,rejected,lead,none', 'event_id % 5')} outcome, case when event_id % 3 = 0 then 'x@y.es' else '' end email from {{events}}",
)


@_query(f"select cc, count(*) n from {QUEUE.sql} where cc in {_CODES_SQL} group by 1")
def seeds_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeds by country."""
    return reports.seeds_by_country(QUEUE.spark(spark, sf_dir), sources.countries(spark).select("cc"))


@_query(
    f"select count(*) total, count(*) filter (not coalesce(done, false)) working, count(*) filter (done) exhausted, coalesce(sum(pagesRead), 0)::bigint pages from {QUEUE.sql}"
)
def seeds_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeds in all."""
    return reports.seeds_summary(QUEUE.spark(spark, sf_dir))


@_query(
    f"select count(*) total, count(*) filter (coalesce(searched, '') <> '') searched, count(*) filter (coalesce(searched, '') = '') \"left\" from {V.LEADS.sql}"
)
def leads_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leads in all."""
    return reports.leads_summary(V.LEADS.spark(spark, sf_dir))


@_query(f"select count(*) patterns, coalesce(sum(len(pending)), 0)::bigint queued, coalesce(sum(added), 0)::bigint added from {MINE.sql}")
def mine_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mined words in all."""
    return reports.mine_summary(MINE.spark(spark, sf_dir))


@_query(f"""select count(*) seen, count(*) filter (outcome = 'added') added, count(*) filter (outcome = 'merged') merged, count(*) filter (outcome = 'rejected') rejected, count(*) filter (outcome = 'lead') leads,
    count(*) filter (coalesce(email, '') <> '') with_email from {OUTCOMES.sql}""")
def import_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of a map import."""
    return reports.import_counters(OUTCOMES.spark(spark, sf_dir))


_OPEN = "coalesce(email, '') = '' and coalesce(website, '') <> ''"


@_query(f"""select 'crawl' section, json_object('ready', count(*) filter ({_OPEN} and coalesce(attempts, 0) < 4 and coalesce(retryAfter, 0) <= {NOW}), 'waiting', count(*) filter ({_OPEN} and coalesce(retryAfter, 0) > {NOW}),
        'exhausted', count(*) filter ({_OPEN} and coalesce(attempts, 0) >= 4))::varchar as value from {V.STORE.sql}
    union all select 'reasons', '{{"reasons":[' || string_agg('{{"reason":"' || crawlNote || '","n":' || n || '}}', ',' order by n desc, crawlNote) || ']}}' from (select crawlNote, count(*) n, min(ord) o from {V.STORE.sql} where coalesce(crawlNote, '') <> '' group by 1 order by n desc, o limit 6)
    union all select 'imports', json_object('imported', count(*) filter ("at" is not null and error is null), 'failed', count(*) filter (error is not null), 'pending', count(*) filter ("at" is null), 'total', count(*),
        'last_error', arg_max(error, "at") filter (error is not null))::varchar from {_PRIORITY_SQL} p left join {V.STATE.sql} s using (cc)
    union all select 'leads', json_object('total', count(*), 'searched', count(*) filter (coalesce(searched, '') <> ''), 'left', count(*) filter (coalesce(searched, '') = ''))::varchar from {V.LEADS.sql}
    union all select 'seeds', json_object('total', count(*), 'working', count(*) filter (not coalesce(done, false)), 'exhausted', count(*) filter (done), 'pages', coalesce(sum(pagesRead), 0)::bigint)::varchar from {QUEUE.sql}
    union all select 'mine', json_object('patterns', count(*), 'queued', coalesce(sum(len(pending)), 0)::bigint, 'added', coalesce(sum(added), 0)::bigint)::varchar from {MINE.sql}""")
def status_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sections of a status report."""
    tables = (t.spark(spark, sf_dir) for t in (V.STORE, V.LEADS, QUEUE, MINE))
    return reports.status(*tables, sources.countries(spark).select("cc", "prio"), V.STATE.spark(spark, sf_dir), F.lit(NOW))


@_query(f"""with s as (select country, city, sum(searches) searches, sum(found) found from (select c.name country, city, searches, found from {V.STATS.sql} join {_COUNTRIES} c using (cc) where city <> '') group by all),
    e as (select country, city, count(*) emails from {V.STORE.sql} where coalesce(country, '') <> '' and coalesce(city, '') <> '' and coalesce(email, '') <> '' group by all)
    select country, city, coalesce(searches, 0)::bigint searches, coalesce(found, 0)::bigint found, coalesce(emails, 0) emails from s full join e using (country, city)""")
def city_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Searches and addresses of every city that has either."""
    named = V.STATS.spark(spark, sf_dir).filter("city <> ''").join(
        sources.countries(spark).select("cc", F.col("name").alias("country")),
        "cc",
    )
    stats = named.groupBy("country", "city").agg(F.sum("searches").alias("searches"), F.sum("found").alias("found"))
    return reports.city_coverage(stats, reports.city_emails(V.STORE.spark(spark, sf_dir)))


@_query(
    f"""select key, searched from {V.LEADS.sql} where coalesce(searched, '') = '' or (coalesce(website, '') = '' and {NOW} - epoch_ms(searched::timestamp) >= 30 * 86400000::bigint)""".replace(
        "searched::timestamp",
        "nullif(searched, '')::timestamp",
    )
)
def leads_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leads to search now."""
    return schedule.leads_due(V.LEADS.spark(spark, sf_dir), F.lit(NOW)).select("key", "searched")


@_query(
    f"select key, case when coalesce(searched, '') <> '' and coalesce(website, '') = '' then null else searched end searched from {V.LEADS.sql}"
)
def leads_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leads after searches in vain are taken back."""
    return schedule.leads_reset(V.LEADS.spark(spark, sf_dir)).select("key", "searched")


@_query(f"""select key, case when g then 0 else coalesce(attempts, 0) end attempts, case when not g then crawlNote end crawlNote, case when not g then coalesce(retryAfter, -1) else -1 end retryAfter, case when g then false else crawled end crawled
    from (select *, coalesce({_OPEN} and (crawlNote = 'no email published' or coalesce(attempts, 0) >= 3), false) g from {V.STORE.sql})""")
def store_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records after giving up is taken back."""
    return schedule.requeued(V.STORE.spark(spark, sf_dir)).select(
        "key",
        "attempts",
        "crawlNote",
        F.coalesce("retryAfter", F.lit(-1)).alias("retryAfter"),
        "crawled",
    )


TRIES = Table("key string, note string, email string", ("w:a.es", "homepage", ""), more=f"""select 'w:club' || cast(c_custkey as string) || '.es' key, {_at('unreachable,no email published,blocked by a challenge page,homepage,bad url', 'c_custkey % 5')} note,
    case when c_custkey % 5 = 3 then 'got@' || cast(c_custkey as string) || '.es' end email from {{customer}} where c_custkey % 2 = 0""")  # fmt: skip


@_query(f"""select s.key, case when t.note is null then coalesce(s.attempts, -1) when t.note = 'blocked by a challenge page' then coalesce(s.attempts, 0) when t.note = 'no email published' then 4 else coalesce(s.attempts, 0) + 1 end attempts,
    case when t.note = 'blocked by a challenge page' then {NOW} + 21600000 when t.note in ('unreachable', 'bad url') then {NOW} + (coalesce(s.attempts, 0) + 1) * 600000 else coalesce(s.retryAfter, -1) end retryAfter,
    case when t.note in ('homepage', 'no email published') then true else s.crawled end crawled, coalesce(t.note, s.crawlNote) crawlNote, coalesce(nullif(s.email, ''), t.email) email,
    case when t.note is null then s.lastTried else '2026-03-03' end lastTried from {V.STORE.sql} s left join {TRIES.sql} t using (key)""")
def crawl_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records after a round of attempts."""
    out = attempted(V.STORE.spark(spark, sf_dir), TRIES.spark(spark, sf_dir), NOW)
    return out.select(
        "key",
        F.coalesce("attempts", F.lit(-1)).alias("attempts"),
        F.coalesce("retryAfter", F.lit(-1)).alias("retryAfter"),
        "crawled",
        "crawlNote",
        "email",
        "lastTried",
    )


@_query(f"select url, row_number() over (order by coalesce(lastRun, ''), url) place from {QUEUE.sql} order by place limit 100")
def harvest_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hundred seeds that have waited longest, in their order."""
    rows = schedule.least_recent(QUEUE.spark(spark, sf_dir), "lastRun", "url").limit(100)
    return rows.agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("lastRun", F.lit("")).alias("r"), "url"))).alias("a")
    ).select(F.posexplode("a").alias("p", "x")).select("x.url", (F.col("p") + 1).cast("bigint").alias("place"))


_LAST = f"(select cc, max(lastRun) last from {QUEUE.sql} group by 1)"


@_query(
    f"select cc, row_number() over (order by coalesce(last, ''), prio)::int place, prio::int by_priority from {_PRIORITY_SQL} p left join {_LAST} l using (cc)"
)
def prospect_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order of countries in even rounds, and in odd ones."""
    countries = sources.countries(spark).select("cc", "prio")
    last = QUEUE.spark(spark, sf_dir).groupBy("cc").agg(F.max("lastRun").alias("last"))
    odd = schedule.prospect_order(countries, last, 1).select("cc", F.col("place").alias("by_priority"))
    return schedule.prospect_order(countries, last, 2).select("cc", "place").join(odd, "cc")


@_query(
    "select user_id, case when max(event_id) % 3 = 2 then sum(event_id % 5)::bigint else -1 end done, least(60000, 5000 * count(*)) wait from events group by 1"
)
def epoch_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress that belongs to the present epoch, and how long to rest after so many failures."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    state = events.groupBy("user_id").agg(
        (F.max("event_id") % 3).alias("epoch"),
        F.sum(F.col("event_id") % 5).alias("queriesDone"),
        F.count("*").alias("cityStats"),
        F.count("*").alias("n"),
    )
    return schedule.epoch_state(state, 2).select(
        "user_id",
        F.coalesce("queriesDone", F.lit(-1)).alias("done"),
        schedule.failure_wait(F.col("n")).alias("wait"),
    )


SEARCHED = Table(
    "key string, name string, cc string",
    ("generic", "Tennis Club", "ES"),
    more=f"select 'k' || cast(p_partkey as string) key, {_at('Green Hill Tennis Club,Abbeyroad Padel,Mount Schank Tennis Club', 'p_partkey % 3')} name, {_at('GB,ES', 'p_partkey % 2')} cc from {{part}}",
)
_HITS = "https://www.facebook.com/greenhill,https://abbeyroad.es/x,https://greenhill.com/,https://clubspark.kiwi/GreenHillTennis,https://other.org/,https://greenhill.co.uk/a,https://clubspark.kiwi/MountnessingTennisClub"
HITS = Table(
    "key string, query int, rank int, url string, title string",
    ("generic", 1, 1, "https://tennis.es", "Tennis Club"),
    more=f"select 'k' || cast(p_partkey as string) key, cast(j as int) query, cast((p_partkey * j + i * 3) % 13 as int) rank, {_at(_HITS, '(p_partkey + i * j) % 7')} url, 'Title' title from {{part}} cross join (select 1 i, 1 j union all select 2, 1 union all select 3, 2) x where p_partkey % 11 > 0",
)


@_query(f"""with r as (select l.key, l.name, l.cc, query, rank, url, regexp_extract(lower(url), '^https://[^/]*') origin, case l.name when 'Green Hill Tennis Club' then ['green', 'hill'] when 'Abbeyroad Padel' then ['abbeyroad'] else ['mount', 'schank'] end w
        from {SEARCHED.sql} l join {HITS.sql} h using (key) where key <> 'generic' and not contains(url, 'facebook')),
    j as (select *, len(list_filter(w, lambda x: contains(origin, x))) > 0 own from r),
    t as (select key, query, rank, case when own then origin else url end url, case when own and ((cc = 'GB' and origin like '%.uk') or (cc = 'ES' and origin like '%.es')) then 1 when own then 2
        when contains(origin, 'clubspark') and len(list_filter(w, lambda x: contains(lower(substr(url, length(origin) + 1)), x))) = len(w) then 3 end tier from j where rank <= 10),
    p as (select key, first(url order by tier, query, rank, url) url, min(tier) tier from t where tier is not null group by 1)
    select l.key, coalesce(p.url, '') url, case when l.key = 'generic' then 'name too generic to search' when tier = 3 then 'club platform page ' || p.url when tier is not null then 'own domain ' || p.url
        when not exists (select 1 from {HITS.sql} h where h.key = l.key) then 'search engine did not answer' else 'no result matching the name' end note from {SEARCHED.sql} l left join p using (key)""")
def sites_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sites of searched leads, or why there is none."""
    return schedule.sites_found(SEARCHED.spark(spark, sf_dir), HITS.spark(spark, sf_dir))


_FOUND = "https://www.club-x.es/a,https://club-y.es,https://playtomic.io/c,https://facebook.com/z,https://town.gob.es/w,https://es.wikipedia.org/q,https://www.venuefinder.com/x"
FOUND = Table(
    "cc string, query int, rank int, url string",
    ("ES", 1, 1, "no url"),
    more=f"select {_at('ES,GB', 'p_partkey % 2')} cc, cast(p_partkey % 50 as int) query, cast(p_partkey as int) rank, case when p_partkey % 3 = 0 then 'https://www.own' || cast(p_partkey % 90 as string) || '.es/p' || cast(p_partkey as string) else {_at(_FOUND, 'p_partkey % 7')} end url from {{part}}",
)


@_query(f"""with f as (select *, regexp_extract(url, '^https://(www[.])?([^/]*)', 2) host from {FOUND.sql}), g as (select *, row_number() over (partition by cc, host order by query, rank, url) r from f where host <> '')
    select cc, host, url, query from g where r = 1 and host <> 'own3.es' and (starts_with(host, 'own') or starts_with(host, 'club'))""")
def search_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search results worth a look."""
    known = spark.createDataFrame([("own3.es",)], "host string")
    return searches.candidates(FOUND.spark(spark, sf_dir), known).select("cc", "host", "url", "query")


@_query(
    f"select country, emails, row_number() over (order by emails desc, country) place from (select country, count(*) filter (coalesce(email, '') <> '') emails from {V.STORE.sql} where coalesce(country, '') <> '' group by 1)"
)
def country_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Countries in the order in which a report shows them."""
    slots = reports.country_slots(V.STORE.spark(spark, sf_dir))
    return slots.select("country", "emails", F.row_number().over(Window.orderBy(*reports.by_emails(slots))).cast("bigint").alias("place"))


ENTRIES = Table(
    "ord bigint, label string, web string, cc string",
    (0, None, "https://n.es", "ES"),
    (1, "Club", None, "ES"),
    more=f"""select 10 + cast(p_partkey as bigint) ord, {_at('Green Tennis Club,Q123,Municipal Tennis Club,Padel Club,Something', 'p_partkey % 5')} label,
        case when p_partkey % 11 = 0 then 'no url' else 'HTTPS://www.E' || cast(p_partkey % 400 as string) || '.es/x' end web, {_at('ES,FR,GB', 'p_partkey % 3')} cc from {{part}}""",
)


@_query(f"""with f as (select *, regexp_extract(lower(web), '^https://www[.](.*)/x$', 1) host from {ENTRIES.sql} where label in ('Green Tennis Club', 'Padel Club') and starts_with(web, 'HTTPS')),
    g as (select *, row_number() over (partition by host order by ord) r from f where host <> 'e7.es')
    select 'w:' || host key, label "name", g.cc, c.name country, 'https://www.' || host website from g join {_COUNTRIES} c on c.cc = g.cc where r = 1""")
def catalogue_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New records of a catalogue of places."""
    known = spark.createDataFrame([("e7.es",)], "host string")
    return records.from_bindings(ENTRIES.spark(spark, sf_dir), sources.countries(spark), known, "Tennis").select("key", "name", "cc", "country", "website")


@_query(f"""with s as (select distinct url from {QUEUE.sql} where right(url, 1) <> '3' union select 'https://new/' || p_partkey from part)
    select url, cc from {QUEUE.sql} where url in (select url from s) union all select url, null from s where url not in (select url from {QUEUE.sql})""")
def queue_synced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The queue after a look at the seeds."""
    queue = QUEUE.spark(spark, sf_dir)
    new = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.concat(F.lit("https://new/"), F.col("p_partkey").cast("string")).alias("url"))
    seeds = queue.filter(~F.col("url").endswith("3")).select("url").unionByName(new)
    return merge.queue_after(queue, seeds, ["url"]).select("url", "cc")


@_query(f"select url, row_number() over (order by coalesce(lastRun, ''), url) place from {QUEUE.sql} where not coalesce(done, false) order by place limit 60")
def workable_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeds to read within a budget of 60 pages."""
    return schedule.workable(QUEUE.spark(spark, sf_dir), 60)


_STOPWORDS = "[" + ", ".join(f"'{w}'" for w in values.STOPWORDS) + "]"


@_query(f"""with l as (select key, trim(name) n, trim(coalesce(town, '')) t from {V.RECORDS.sql} where name not in ('Own')
        and len(list_filter(regexp_split_to_array(strip_accents(lower(name)), '[^a-z0-9]+'), lambda x: length(x) >= 4 and not list_contains({_STOPWORDS}, x))) > 0),
    q as (select key, case when t = '' then n else n || ' ' || t end query, 0 place from l union all select key, n, 1 from l where t <> '') select * from q""")
def lead_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is asked for each lead."""
    rows = V.RECORDS.spark(spark, sf_dir).filter("name not in ('Own')")
    return schedule.lead_queries(rows)


@_query(f"select sum(l_linenumber)::bigint added, sum(l_suppkey % 3)::bigint merged, (select string_agg(distinct 'S' || lpad(l_suppkey::varchar, 6, '0'), ' ' order by 'S' || lpad(l_suppkey::varchar, 6, '0')) from lineitem where l_partkey = 5) failed from lineitem")
def import_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Imports in all."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    cc = F.concat(F.lit("S"), F.lpad(F.col("l_suppkey").cast("string"), 6, "0"))
    state = rows.groupBy(cc.alias("cc")).agg(F.sum("l_linenumber").alias("added"), F.sum(F.col("l_suppkey") % 3).alias("merged"), F.max(F.when(F.col("l_partkey") == 5, F.lit("timeout"))).alias("error"))
    return reports.import_totals(state)


@_query(f"select ord, value from {V.LINES.sql} where trim(value) <> '' order by ord desc limit 14")
def recent_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last lines of a log that are not blank."""
    return sources.recent_lines(V.LINES.spark(spark, sf_dir), "ord")


TOWNS = Table(
    "key string, town string, lat double, lon double",
    ("x", "y", None, None),
    more=f"select 'n:' || cc || ':' || lower(replace(club, ' ', '')) key, min(city) town, min(1.5) lat, cast(null as double) lon from ({V._ROWS}) where k % 4 = 0 group by 1",
)


@_query(
    f"select s.key, l.town, l.lat from {V.STORE.sql} s left join {TOWNS.sql} l on l.key = 'n:' || coalesce(s.cc, '') || ':' || regexp_replace(lower(coalesce(s.name, '')), '[^a-z0-9]+', '', 'g')"
)
def lead_towns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with the towns of their leads."""
    return merge.with_leads(V.STORE.spark(spark, sf_dir), TOWNS.spark(spark, sf_dir)).select("key", "town", "lat")


@_query(
    "select (l_partkey % 3)::varchar || 't' \"type\", l_suppkey id, min(l_orderkey * 10 + l_linenumber) ord, arg_max(l_comment, l_orderkey * 10 + l_linenumber) tag from (select *, l_returnflag || l_linestatus l_comment from lineitem) group by 1, 2"
)
def latest_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map elements of several statements: the last content at the first place."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    ord_ = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord")
    kind = F.concat((F.col("l_partkey") % 3).cast("string"), F.lit("t")).alias("type")
    return merge.latest_element(
        rows.select(kind, F.col("l_suppkey").alias("id"), ord_, F.concat("l_returnflag", "l_linestatus").alias("tag"))
    )


ELEMENTS = Table(
    "k bigint, cc string, name string, sport string, website string, email string, access string, operator_type string, town string",
    (0, "ES", "", "tennis", "", "", "", "", ""),
    more=f"""select cast(p_partkey as bigint) k, {_at('ES,GB,BR', 'p_partkey % 3')} cc, {_at('Green Padel Club,Municipal Tennis Club,Oak Club,Sporting Squash', 'p_partkey % 4')} name, {_at('tennis,padel,soccer,', '(p_partkey + 1) % 4')} sport,
        {_at('www.x.es,https://b.gov.uk/y,,https://c.es/z/', 'p_partkey % 4')} website, {_at('Info@A.es; b@c.es,,x@y.edu', 'p_partkey % 3')} email, {_at('yes,private,,', 'p_partkey % 9')} access, {_at('public,private,', 'p_partkey % 7')} operator_type,
        {_at('Leeds,', 'p_partkey % 2')} town from {{part}}""",
)


@_query(f"""with e as (select *, split_part(lower(email), ';', 1) mail, case when starts_with(website, 'www') then 'http://' || website when website = 'https://c.es/z/' then website else website end site,
        case sport when 'tennis' then 'Tennis' when 'padel' then 'Padel' else case when contains(name, 'Tennis') then 'Tennis' when contains(name, 'Padel') then 'Padel' when contains(name, 'Squash') then 'Squash' else '' end end sports from {ELEMENTS.sql}),
    r as (select *, case when name = '' then 'no name' when contains(name, 'Municipal') then 'public/institutional: Municipal' when contains(site, '.gov.') then 'public domain' when ends_with(mail, '.edu') then 'public email domain'
        when access in ('yes') then 'access=yes' when operator_type = 'public' then 'operator_type=public' else '' end reason from e)
    select k, sports, site website, mail email, case when name = '' or sports = '' then 'none' when reason <> '' then 'rejected' when site = '' and mail = '' then 'lead' else 'record' end outcome,
        case when name <> '' and sports <> '' then reason else '' end reason, town from r""")
def map_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records, leads and rejections of map elements."""
    rows = ELEMENTS.spark(spark, sf_dir)
    tags = F.map_from_arrays(
        F.array(*(F.lit(x) for x in ("name", "sport", "website", "contact:email", "access", "operator_type", "addr:town"))),
        F.array("name", "sport", "website", "email", "access", "operator_type", "town"),
    )
    at = F.lit(1.0)
    elements = rows.select(
        "cc",
        F.lit("node").alias("type"),
        F.col("k").alias("id"),
        tags.alias("tags"),
        at.alias("lat"),
        at.alias("lon"),
        F.struct(at.alias("lat"), at.alias("lon")).alias("center"),
    )
    out = records.from_elements(elements, sources.countries(spark))
    return out.select(
        F.regexp_extract("srcPage", r"\d+$", 0).cast("bigint").alias("k"),
        F.array_join("sports", "+").alias("sports"),
        "website",
        "email",
        "outcome",
        "reason",
        "town",
    )


_TITLES = "Abbey Tennis Club,Guia Padel Club,padel.today,One Two Three Four Five Six Seven Eight Squash Club,Tennis World,Tennis Club South Africa,Municipal Tennis Club,,Oak Golf Club"
VETTED = Table(
    "k bigint, url string, cc string, city string, title string, body string, contact string",
    (0, "nothing", "GB", "", "Abbey Tennis Club", "Tennis", ""),
    more=f"""select cast(p_partkey as bigint) k, {_at('https://a.co.uk/x,https://b.com,https://c.es,https://d.org/y', 'p_partkey % 4')} url, 'GB' cc, {_at('Leeds,York,', 'p_partkey % 3')} city, {_at(_TITLES, 'p_partkey % 9')} title,
        {_at('in Leeds now,York,the United Kingdom,nowhere', '(p_partkey + 1) % 4')} body, {_at('x,visit leeds,y', 'p_partkey % 5')} contact from {{part}}""",
)


@_query(f"""with c as (select *, k % 10 = 9 and k > 0 gone, lower(body || ' ' || contact) words, case when url = 'nothing' then '' else regexp_extract(url, '^https://[^/]*') end website from {VETTED.sql})
    select k, website, case when website = '' then 'bad url' when ends_with(website, '.es') then 'domain belongs to ES' when gone then 'unreachable' when title = '' then 'no name on the page' when title = 'Oak Golf Club' then 'no racket sport on the page'
        when title = 'Guia Padel Club' then 'a listing of clubs, not one: "Guia Padel Club"' when title = 'padel.today' then 'the title is a domain, not a club: "padel.today"' when starts_with(title, 'One') then 'title is a description, not a name'
        when title = 'Tennis World' then 'no club signal in "Tennis World"' when title = 'Tennis Club South Africa' then 'names South Africa, not United Kingdom' when starts_with(title, 'Municipal') then 'public/institutional: Municipal'
        when not (ends_with(website, '.uk') or contains(words, 'united kingdom') or (city = 'Leeds' and contains(words, 'leeds'))) then 'nothing on its pages ties it to ' || coalesce(nullif(city, ''), 'United Kingdom') else '' end reason from c""")
def vetted_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first reason against candidate sites."""
    rows = VETTED.spark(spark, sf_dir)
    gone = (F.col("k") % 10 == 9) & (F.col("k") > 0)
    page = F.concat(F.lit("<title>"), "title", F.lit("</title><p>"), "body", F.lit("</p>"))
    sites = rows.withColumns({"html": F.when(~gone, page), "contact_html": F.col("contact")})
    keyed = sites.withColumn(
        "url",
        F.concat("url", F.when(F.col("url") == "nothing", F.lit("")).otherwise(F.concat(F.lit("?"), F.col("k").cast("string")))),
    )
    out = records.vet(keyed.select("url", "cc", "city", "html", "contact_html"), sources.countries(spark))
    return out.select(F.coalesce(F.regexp_extract("url", r"\?(\d+)$", 1).try_cast("bigint"), F.lit(0)).alias("k"), "website", "reason")


REGISTER = Table(
    "k bigint, name string, email string, site string",
    (0, "", "", ""),
    more=f"""select cast(p_partkey as bigint) k, {_at('Abbey Tennis Club,3Tenn Hall,Golf Place Club,', 'p_partkey % 4')} name, {_at('mailto:Sec@Abbey.co.uk,mailto:info@lta.org.uk,mailto:test@x.uk,', '(p_partkey + 1) % 4')} email,
        {_at('https://abbey.co.uk,https://www.lta.org.uk/x,,https://3tenn.co.uk/', 'p_partkey % 5')} site from {{part}}""",
)


@_query(f"""with r as (select *, k % 13 = 0 gone, case when email = 'mailto:Sec@Abbey.co.uk' then 'sec@abbey.co.uk' else '' end mail, case when contains(site, 'lta.org') then '' else site end web from {REGISTER.sql})
    select k, case when gone then 'unreachable' when name = '' then 'no name on the page' when name = '3Tenn Hall' and web = '' then 'no club signal in name' when name = '3Tenn Hall' and contains(web, '3tenn') then ''
        when name = '3Tenn Hall' then 'no club signal in name; its site: site unreachable' when mail = '' and web = '' then 'no email and no website' else '' end reason, case when gone then '' else mail end email from r""")
def register_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reasons against the venues of a register, with a second look at some of their sites."""
    return _venues(spark, sf_dir).select(F.col("id").alias("k"), "reason", "email")


def _venues(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = REGISTER.spark(spark, sf_dir)
    field = lambda label, c: F.concat(F.lit(f'<div class="c__header">{label}</div><a href="'), F.col(c), F.lit('">x</a></div>'))
    page = F.concat(F.lit("<title>"), "name", F.lit(" | LTA</title><p>Tennis</p>"), field("Email", "email"), field("Website", "site"))
    venues = rows.select(F.col("k").alias("id"), F.when(F.col("k") % 13 != 0, page).alias("html"))
    seen = spark.createDataFrame(
        [("https://3tenn.co.uk/", "GB", "", "<title>Bushey Tennis Club</title><p>Tennis</p>", "")],
        "url string, cc string, city string, html string, contact_html string",
    )
    return judging.from_register(venues, records.vet(seen, sources.countries(spark)))


@_query(f"""with r as (select *, k % 13 = 0 gone, case when email = 'mailto:Sec@Abbey.co.uk' then 'sec@abbey.co.uk' else '' end mail, case when contains(site, 'lta.org') then '' else site end web from {REGISTER.sql}),
    s as (select *, name = '3Tenn Hall' and contains(web, '3tenn') saved from r)
    select k, case when saved then 'Bushey Tennis Club' else name end "name", 'Tennis' sports, case when saved then 'https://3tenn.co.uk' else web end website, mail email from s
    where not gone and name <> '' and (saved or name <> '3Tenn Hall') and not (mail = '' and web = '')""")
def register_venues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The venues of a register that are records; what their own site says better is taken from there."""
    found = _venues(spark, sf_dir).filter("reason = ''")
    return found.select(F.col("id").alias("k"), "name", F.array_join("sports", "+").alias("sports"), "website", "email")


@_query(
    f"""select "at", string_agg(key, ' ' order by key) firsts from (select user_id::varchar || event_type key, min(date_trunc('day', ts))::varchar "at" from events group by 1) group by 1""".replace(
        "min(date_trunc('day', ts))::varchar",
        "strftime(min(ts), '%Y-%m-%d')",
    )
)
def first_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys by the day on which they were first met."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    first = events.groupBy(F.concat(F.col("user_id").cast("string"), "event_type").alias("key")).agg(F.min("ts").alias("ts"))
    return first.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("at")).agg(
        F.array_join(F.array_sort(F.collect_list("key")), " ").alias("firsts")
    )

