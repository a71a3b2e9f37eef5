"""Queries on stores, rounds and state: what is written and read back, added in batches, or kept by key over a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sources
from ..functions import values
from ..operators import merge, ranges, reports
from ..operators.schedule import DAY, MINUTE
from ..plans import scan
from ..sources.files import shared_folder
from ..sources.keyed_store import KeyedStore
from ..sources.single_file import write_file
from ..streaming import answered, crawl, sessions, sliding
from . import inline as V
from .cases import _PUBLISHED, _SPORTS_OF
from .domain import _upsert_sql
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


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query("select 'c{' || c_custkey || '}' as key, c_name \"name\", c_mktsegment || '\"]}' segment, c_acctbal balance, c_nationkey::int nation from customer")
def stored_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written as JSON objects by key, some hundred a line, and read back in blocks."""
    record = F.struct(
        F.col("c_name").alias("name"),
        F.concat("c_mktsegment", F.lit('"]}')).alias("segment"),
        F.struct(F.col("c_acctbal").alias("balance"), F.array(F.col("c_nationkey")).alias("nations")).alias("figures"),
    )
    key = F.concat(F.lit("c{"), F.col("c_custkey").cast("string"), F.lit("}"))
    pair = F.to_json(F.map_from_arrays(F.array(key), F.array(record)))
    rows = _table(spark, sf_dir, "customer").select(F.floor(F.col("c_custkey") / 300).alias("line"), F.regexp_replace(pair, r"^\{|\}$", "").alias("entry"))
    lines = rows.groupBy("line").agg(F.concat(F.lit("{"), F.array_join(F.collect_list("entry"), ","), F.lit("}")).alias("value"))
    path = shared_folder(spark, "json")
    lines.select("value").write.text(path)
    back = sources.json_store(spark, path, "name string, segment string, figures struct<balance: double, nations: array<int>>")
    return back.select("key", "name", "segment", "figures.balance", F.col("figures.nations")[0].alias("nation"))


@_query(_upsert_sql())
def keyed_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of a keyed store after the stored ones and three rounds of new ones, one of which came twice."""
    known, new = V.STORE.spark(spark, sf_dir), V.NEW.spark(spark, sf_dir)
    store = KeyedStore(spark, shared_folder(spark, "store"), known.schema, buckets=16, least=200)
    store.add(known, "map", "rounds", 0)
    for n, (low, high) in enumerate(((0, 1200), (1200, 2000), (2000, 1 << 62)), 1):
        store.add(new.filter((F.col("ord") >= low) & (F.col("ord") < high)), "map", "rounds", n)
        store.add(new.filter((F.col("ord") >= low) & (F.col("ord") < high)), "map", "rounds", n)
    return store.read().select("key", "name", "email", "website", "contact", "crawled", F.array_join("sports", "+").alias("sports"))


#: what stands for the outcome of an attempt, by kind of event
_NOTES = {"view": "unreachable", "click": "homepage", "error": values.CHALLENGED, "purchase": values.SILENT, "signup": "bad url"}
_REOPEN = 3
_NOTE_SQL = "case event_type " + " ".join(f"when '{k}' then '{v}'" for k, v in _NOTES.items()) + " end"
_MISSED = "(" + ", ".join(f"'{x}'" for x in values.MISSED) + ")"
_OPENED = f"(case when s.attempts >= {values.MOST_ATTEMPTS} and x.ts - s.last > {_REOPEN * DAY} then {values.MOST_ATTEMPTS - 1} else s.attempts end)"


def _step(field: str, tried: str) -> str:
    """A field of the state after an attempt: ``tried`` if it was made."""
    return f"\"{field}\": case when {_OPENED} < {values.MOST_ATTEMPTS} and s.retry <= x.ts then {tried} else {_OPENED if field == 'attempts' else 's.' + field} end"


_STATES = f"""with e as (select user_id, (epoch_us(ts) // 1000)::bigint ts, {_NOTE_SQL} note, event_id from events),
    l as (select user_id, list({{'ts': ts, 'note': note, 'attempts': 0::bigint, 'retry': 0::bigint, 'last': -1::bigint, 'made': 0::bigint}} order by ts, event_id) a, count(*) seen from e group by 1),
    r as (select user_id, seen, list_reduce(list_prepend({{'ts': 0::bigint, 'note': '', 'attempts': 0::bigint, 'retry': 0::bigint, 'last': -1::bigint, 'made': 0::bigint}}, a), lambda s, x: {{"ts": x.ts,
        {_step('note', 'x.note')}, {_step('attempts', f"case x.note when '{values.CHALLENGED}' then {_OPENED} when '{values.SILENT}' then {values.MOST_ATTEMPTS} else {_OPENED} + 1 end")},
        {_step('retry', f"case when x.note = '{values.CHALLENGED}' then x.ts + {values.CHALLENGE_MINUTES * MINUTE} when x.note in {_MISSED} then x.ts + ({_OPENED} + 1) * {values.RETRY_MINUTES * MINUTE} else s.retry end")},
        {_step('last', 'x.ts')}, {_step('made', 's.made + 1')}}}) x from l)
    select user_id::varchar as key, x.attempts::bigint attempts, x.retry::bigint "retryAfter", x.note note, x.last::bigint "lastTried", x.made::bigint made, seen from r"""


@_query(_STATES)
def crawl_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as attempts on their users: the state of each after a stream in two parts, with a restart between them.

    A settled record that a timer has opened again by the stream's end counts as settled, as it does in the SQL.
    """
    note = F.create_map(*(F.lit(x) for pair in _NOTES.items() for x in pair))
    rows = _table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("key"),
        F.col("ts").cast("timestamp").alias("at"),
        F.element_at(note, F.col("event_type")).alias("note"),
        F.col("event_id").alias("number"),
    )
    ends = rows.agg(F.timestamp_millis(F.floor((F.min(F.unix_millis("at")) + F.max(F.unix_millis("at"))) / 2)).alias("middle")).first()
    source, out, checkpoint = (shared_folder(spark, x) for x in ("attempts", "states", "stream"))
    for n, part in enumerate((F.col("at") < F.lit(ends.middle), F.col("at") >= F.lit(ends.middle))):
        rows.filter(part).write.parquet(f"{source}/part={n}")
        stream = spark.readStream.schema(rows.schema).parquet(f"{source}/part=*")
        crawl.replay(stream, out, checkpoint, reopen=_REOPEN)
    return crawl.latest_states(spark, out, kind="state").select("key", "attempts", "retryAfter", "note", "lastTried", "made", "seen")


def _breaker_sql(k: int, keys: str = "") -> str:
    over = lambda frame: f"over ({'partition by ' + keys if keys else ''} order by ts, event_id {frame})"
    island = f"{keys + ', ' if keys else ''}run"
    return f"""with o as (select *, sum((event_type <> 'error')::int) {over('')} run from events),
    r as (select *, case when event_type = 'error' then (row_number() over (partition by {island} order by ts, event_id) - (run > 0)::int - 1) % {k} + 1 else 0 end streak from o)
    select event_id, streak, streak = {k} opened, coalesce(sum((streak = {k})::int) {over('rows between unbounded preceding and 1 preceding')}, 0)::bigint pauses from r"""


def _order() -> list:
    return [F.col("ts"), F.col("event_id")]


@_query(_breaker_sql(3))
def breaker_pauses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in one order, with a breaker that opens at three errors in a row and starts anew after a rest."""
    found = ranges.breaker(_table(spark, sf_dir, "events"), _order(), F.col("event_type") != "error", 3)
    return found.select("event_id", "streak", "opened", "pauses")


@_query(_breaker_sql(2, "user_id"))
def breaker_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for each user, at two errors in a row."""
    found = ranges.breaker(_table(spark, sf_dir, "events"), _order(), F.col("event_type") != "error", 2, ["user_id"])
    return found.select("event_id", "streak", "opened", "pauses")


@_query(f"select event_id from ({_breaker_sql(2, 'user_id')}) where pauses = 0")
def attempts_made(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each user's phase gets to before two errors in a row end it."""
    return ranges.until_open(_table(spark, sf_dir, "events"), _order(), F.col("event_type") != "error", 2, ["user_id"]).select("event_id")


@_query(f"select e email, country, row_number() over (order by country collate en, \"name\" collate en, e) place from {_PUBLISHED}")
def published_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published records with their places in the published order."""
    rows = merge.publishable(V.STORE.spark(spark, sf_dir)).select("email", "country", "name")
    return ranges.placed(rows, [*merge.published_order(), F.col("email")]).select("email", "country", "place")


_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
# statement 0 of some nations is too big, of others refused; statement 2 of some fails; some areas fail once, one fails always
_TOO_BIG, _REFUSED, _PART, _ONCE, _NEVER = "n % 4 = 0", "n % 7 = 3 and n % 4 > 0", "n % 5 = 1", "(n + segment) % 3 = 0", "n = 8 and segment = 1"


def _scanned(spark: SparkSession, sf_dir: str) -> scan.CountryScan:
    """A scan of the nations, broken off and taken up again; the elements are customers, the areas their segments."""
    customer = _table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").cast("int").alias("n"),
        F.array_position(F.array(*(F.lit(s) for s in _SEGMENTS)), F.col("c_mktsegment")).alias("segment"),
        F.col("c_custkey").cast("bigint").alias("k"),
    )
    both = F.slice(F.array((F.col("k") % 3).cast("int"), ((F.col("k") + 1) % 3).cast("int")), F.lit(1), F.when(F.col("k") % 5 == 0, 2).otherwise(1))
    held = customer.withColumn("statement", F.explode(both))
    element = lambda kind, i, statement: F.struct(F.lit(kind).alias("type"), i.alias("id"), F.create_map(F.lit("statement"), statement.cast("string")).alias("tags"))
    chunk = F.floor(F.col("k") / 1000).alias("chunk")
    inside = held.groupBy("n", "segment", "statement", chunk).agg(F.collect_list(element("node", F.col("k"), F.col("statement"))).alias("elements")).drop("chunk")
    relations = F.transform(F.sequence(F.lit(1), F.lit(len(_SEGMENTS))), lambda i: element("relation", i.cast("bigint"), F.lit("")))
    path, countries = shared_folder(spark, "scan"), _table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("cc"))

    def ask_of(own: scan.CountryScan) -> scan.Ask:
        def ask(work: DataFrame) -> DataFrame:
            rows = work.withColumns({"n": F.col("cc").cast("int"), "s": F.col("area") - sources.area_id(F.lit(0)), "t": F.col("statement")}).drop("statement").alias("w")
            first_try = F.lit(own.steps() == 2)
            error = (
                F.expr(f"case when area is null and t = 0 and {_TOO_BIG} then 'Gateway 504' when area is null and t = 0 and {_REFUSED} then 'refused' when area is null and t = 2 and {_PART} then 'busy' end")
            )
            late = F.expr(f"area is not null and t = 1 and ({_NEVER.replace('segment', 's')})") | (F.expr(f"area is not null and t = 1 and {_ONCE.replace('segment', 's')}") & first_try)
            rows = rows.withColumn("error", F.coalesce(error, F.when(late, "timed out"))).alias("w")
            met = (F.col("w.n") == F.col("h.n")) & (F.col("w.t") == F.col("h.statement")) & (F.col("w.area").isNull() | (F.col("w.s") == F.col("h.segment")))
            found = rows.join(inside.alias("h"), met, "left")
            none = F.array().cast(f"array<struct<{scan.ELEMENT}>>")
            answer = F.when(F.col("w.t") == scan.AREAS, relations).otherwise(F.coalesce("h.elements", none))
            return found.select("w.cc", "w.area", F.col("w.t").alias("statement"), "w.error", F.when(F.col("w.error").isNull(), answer).alias("elements"))

        return ask

    first = scan.CountryScan(spark, path, countries, statements=3, most=3)
    first.step(ask_of(first))
    first.step(ask_of(first))
    second = scan.CountryScan(spark, path, countries, statements=3, most=3)
    second.run(ask_of(second))
    return second


@_query(f"""with c as (select n_nationkey n from nation) select n::varchar cc, {_TOO_BIG} split, case when {_TOO_BIG} then case when n = 8 then 4 else 5 end else 0 end::bigint done, case when {_TOO_BIG} then 5 else 0 end::bigint total,
    {_TOO_BIG} and n <> 8 complete, case when {_PART} and not ({_TOO_BIG}) and not ({_REFUSED}) then 1 else 0 end::bigint partial, case when {_REFUSED} then 'refused' end error from c""")
def country_scan_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the scan of each nation got."""
    return _scanned(spark, sf_dir).states().fillna({"partial": 0})


@_query(f"""with h as (select c_custkey k, c_nationkey n, list_position([{', '.join(repr(x) for x in _SEGMENTS)}], c_mktsegment) segment, unnest(case when c_custkey % 5 = 0 then [c_custkey % 3, (c_custkey + 1) % 3] else [c_custkey % 3] end) t from customer)
    select n::varchar cc, k::bigint id, max(t)::varchar statement from h where case when {_TOO_BIG} then not (t = 1 and {_NEVER}) when {_REFUSED} then false else not (t = 2 and {_PART}) end group by 1, 2""")
def country_scan_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The elements of all nations, each with the last answer's content."""
    found = _scanned(spark, sf_dir).elements()
    return found.select("cc", "id", F.element_at("tags", "statement").alias("statement"))


_KEY = "'n:' || n.cc || ':' || regexp_replace(lower(coalesce(n.\"name\", '')), '[^a-z0-9]+', '', 'g')"
#: new records stand for published ones, an address each; stored keys of some names are taken, with gaps in their numbers
_BACK = f"(select distinct on (lower(email)) * from {V.NEW.sql} where coalesce(email, '') <> '' order by lower(email), ord)"


@_query(f"""with s as (select key, email from {V.STORE.sql} union all select key, null from (select distinct {_KEY} || u key from {_BACK} n, (values (''), ('#2'), ('#4')) t(u) where n.ord % 3 = 0)),
    c as (select lower(n.email) email, n."name", c.cc, {_KEY.replace("n.cc", "c.cc")} base from {_BACK} n join {_COUNTRIES} c on lower(c.name) = lower(n.country) where lower(n.email) not in (select lower(email) from s where coalesce(email, '') <> '')),
    r as (select *, row_number() over (partition by base order by email) turn from c),
    f as (select base, i, row_number() over (partition by base order by i) turn from (select base, unnest(range(1, count(*)::bigint + 8)) i from c group by 1) x
        where case when i = 1 then base else base || '#' || i end not in (select key from s where key is not null))
    select email, case when i = 1 then base else base || '#' || i end as key, cc from r join f using (base, turn)""")
def restored_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a restore adds: published records that the store lacks, under keys that are free."""
    new = V.NEW.spark(spark, sf_dir).filter(merge.filled(F.col("email")).isNotNull())
    back = new.groupBy(F.lower("email").alias("e")).agg(F.min_by(F.struct(*new.columns), "ord").alias("x")).select("x.*")
    own = F.concat(F.lit("n:"), F.coalesce("cc", F.lit("")), F.lit(":"), F.regexp_replace(F.lower(F.coalesce("name", F.lit(""))), "[^a-z0-9]+", ""))
    held = back.filter("ord % 3 = 0").select(F.explode(F.array(*(F.concat(own, F.lit(u)) for u in ("", "#2", "#4")))).alias("key")).distinct()
    store = V.STORE.spark(spark, sf_dir).select("key", "email").unionByName(held, allowMissingColumns=True)
    return merge.restored(back, store, sources.countries(spark)).select("email", "key", "cc")


@_query(f"""with s as (select e, string_agg(s, '+' order by o) sports from (select e, s, min((ord, i)) o from (select e, ord, unnest(sports) s, generate_subscripts(sports, 1) i from (select *, lower(email) e from {V.STORE.sql} where coalesce(name, '') <> '' and coalesce(email, '') <> '' and coalesce(lang, '') <> '' and len(sports) > 0)) group by e, s) group by e)
    select e email, "name", sports, country, (select count(*) from {_PUBLISHED}) as total, (select count(*) from {_SPORTS_OF} where s = 'Padel') padel from {_PUBLISHED} join s using (e)""")
def site_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The site's file, written in one step and read back as a JSON document."""
    path = f"{shared_folder(spark, 'site')}/site.json"
    write_file(reports.site_lines(merge.publishable(V.STORE.spark(spark, sf_dir))), path, ["ord"])
    club = "name string, sports array<string>, contact string, email string, lang string, country string, src string, stale boolean"
    site = spark.read.schema(f"count bigint, bySport map<string,bigint>, clubs array<struct<{club}>>").option("multiLine", True).json(path)
    rows = site.select("count", F.col("bySport.Padel").alias("padel"), F.explode("clubs").alias("c"))
    return rows.select("c.email", "c.name", F.array_join("c.sports", "+").alias("sports"), "c.country", F.col("count").alias("total"), "padel")


@_query("select event_id, user_id, event_type from events where event_id % 7 <> 3")
def activity_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of JSON lines, some of them broken, written and read back."""
    line = F.to_json(F.struct("event_id", "user_id", "event_type"))
    broken = F.when(F.col("event_id") % 7 == 3, F.substring(line, 1, 20)).otherwise(line)
    path = shared_folder(spark, "log")
    sources.write_lines(_table(spark, sf_dir, "events").select(broken.alias("value")), path)
    return sources.json_lines(spark, path, "event_id bigint, user_id bigint, event_type string")


_HOT = "case when user_id % 3 > 0 then 0 else user_id end"


@_query(f"""with e as (select *, {_HOT} k from events) select a.event_id, coalesce(b.event_id, -1) state_id, coalesce(b.value, -1) as value from (select * from e where event_type <> 'purchase') a
    asof left join (select * from e where event_type = 'purchase') b on a.k = b.k and a.ts >= b.ts""")
def state_at_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The purchase that each event of a user follows; two thirds of all rows have one key."""
    rows = _table(spark, sf_dir, "events").withColumn("k", F.expr(_HOT)).select("k", "ts", "event_id", "event_type", "value")
    bought = F.col("event_type") == "purchase"
    found = ranges.as_of(rows.filter(~bought), rows.filter(bought), ["k"], "ts", "ts")
    none = lambda c: F.coalesce(c, F.lit(-1))
    return found.select("event_id", none("state.event_id").alias("state_id"), none("state.value").alias("value"))


@_query("""with o as (select *, coalesce(epoch_us(ts) - epoch_us(lag(ts) over (partition by user_id order by ts, event_id)) > 21600000000, true) new from events),
    s as (select *, sum(new::int) over (partition by user_id order by ts, event_id) s from o)
    select user_id, epoch_us(min(ts)) start_us, epoch_us(max(ts)) + 21600000000 end_us, count(*) n from s group by user_id, s""")
def user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of users with gaps of six hours (an extension; the same function serves a stream)."""
    found = sessions(_table(spark, sf_dir, "events"))
    return found.select("user_id", F.unix_micros("start").alias("start_us"), F.unix_micros("end").alias("end_us"), "n")


@_query("""select epoch_us(time_bucket(interval 15 minutes, ts)) - d * 900000000 start_us, event_type, count(*) n from events, range(4) r(d) group by all""")
def sliding_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by hours that begin every quarter (an extension)."""
    return sliding(_table(spark, sf_dir, "events")).select(F.unix_micros("start").alias("start_us"), "event_type", "n")


@_query("""select a.event_id, o.event_id came_id, o.event_type note from events a join events o on a.user_id = o.user_id and o.ts between a.ts and a.ts + interval 2 hours
    where a.event_type = 'click' and o.event_type in ('error', 'purchase')""")
def answered_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks with the errors and purchases that came within two hours (an extension; the same function joins streams)."""
    rows = _table(spark, sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp"))
    clicks = rows.filter("event_type = 'click'").select(F.col("user_id").alias("key"), F.struct("at", "event_id").alias("c"), F.col("at").alias("tried"))
    comes = rows.filter("event_type in ('error', 'purchase')").select(F.col("user_id").alias("key"), F.col("at").alias("came"), F.concat_ws(" ", "event_id", "event_type").alias("note"))
    found = answered(clicks.select("key", "tried").distinct(), comes, "2 hours").join(clicks, ["key", "tried"])
    return found.select("c.event_id", F.split("note", " ")[0].cast("bigint").alias("came_id"), F.split("note", " ")[1].alias("note"))


@_query("select event_type, count(distinct user_id) users, true near from events group by 1")
def users_by_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users by type, counted exactly, and whether sketches by day, united, come as near as they should (an extension)."""
    rows = _table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    about = reports.united_counts(reports.distinct_sketches(rows, ["event_type", "day"], "user_id"), ["event_type"])
    exact = rows.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))
    bound = 4 * 1.04 / 64
    return exact.join(about, "event_type").select("event_type", "users", (F.abs(F.col("n") - F.col("users")) <= bound * F.col("users") + 1).alias("near"))
