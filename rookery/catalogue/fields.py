"""Column functions and sources on rows made of the given tables.

What each row has to give is known from how it is made: the SQL works on the parts that a page, a tag list or a log line
was put together from, and never parses what the Spark functions parse.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sources
from ..functions import emails, html, rules, rx, urls, values
from ..operators import merge
from .inline import _at

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _on(rows: str, sql: str):
    """rows: a select in the SQL that both engines share; ``sql`` reads it as ``t``."""

    def register(f: Callable[[DataFrame], DataFrame]) -> Callable:
        names = set(re.findall(r"\{(\w+)\}", rows))
        tables = lambda spark, sf_dir: {n: sources.spread(spark.read.parquet(f"{sf_dir}/{n}.parquet")) for n in names}
        QUERIES[f.__name__] = lambda spark, sf_dir: f(spark.sql(rows, **tables(spark, sf_dir)))
        SQL[f.__name__] = f"with t as ({re.sub(r'{(\w+)}', r'\1', rows)}) {sql}"
        return f

    return register


_K = "cast(p_partkey as bigint)"
# a listing page of four links
_LISTING = f"""select *, '<html><title>Clubs ' || cast(k as string) || '</title><body><p>x</p><a class="n" href="' || h1 || '">' || t1 || '</a> <A HREF=''' || h2 || '''><b>' || t2 || '</b></A><a href="' || h3 || '"> ' || t3 || ' </a>
<a href="#top">Tennis Club top</a><a href="mailto:a@b.es">Tennis Club mail</a><a href="' || h4 || '">' || t4 || '</a></body></html>' page from (
    select {_K} k, 'https://list.example.org/d/' || cast(p_partkey as string) base, 'https://www.club' || cast(p_partkey as string) || '.es/a#frag' h1, 'Club de Padel ' || cast(p_partkey % 50 as string) t1,
    '/inside/' || cast(p_partkey as string) h2, {_at('Tennis Club North,Home tennis club,Municipal Tennis Club,abc,Squash Racquet Club,next', 'p_partkey % 6')} t2,
    {_at('https://facebook.com/x,https://abbeyroad.co.uk/,https://list.example.org/z,http://ABBEYROAD.org/p?q=1', 'p_partkey % 4')} h3, {_at('Abbeyroad Tennis Club,Tennis,Sporting Club de Padel', 'p_partkey % 3')} t3,
    '/page/' || cast(p_partkey % 7 as string) h4, {_at('Next,siguiente,More,Club de Padel 7', 'p_partkey % 4')} t4 from {{part}})"""
_FOUR = """l as (select k, base, 1 i, h1 u, t1 x from t union all select k, base, 2, 'https://list.example.org' || h2, t2 from t
    union all select k, base, 3, case when h3 like 'http://ABBEY%' then 'http://abbeyroad.org/p?q=1' else h3 end, t3 from t union all select k, base, 4, 'https://list.example.org' || h4, t4 from t)"""
_CLUB = values.CLUB_WORD.replace("'", "''")
_PUBLIC = values.PUBLIC.replace("'", "''")


@_on(_LISTING, f""", {_FOUR}, c as (select *, row_number() over (partition by k, x order by i) n from l where length(x) between 4 and 90 and regexp_matches(x, '{_CLUB}', 'i') and not regexp_matches(x, '{_PUBLIC}', 'i')
    and not regexp_matches(x, '^(home|next)', 'i')) select k, string_agg(x || '|' || u || '|' || case when starts_with(u, 'https://list.example.org') then 'in' else 'out' end, ' ; ' order by i) found from c where n = 1 group by k""")  # fmt: skip
def club_candidates(t: DataFrame) -> DataFrame:
    """Links of a listing whose text may name a club."""
    found = html.candidates(F.col("page"), F.col("base"))
    lines = F.transform(found, lambda x: F.concat_ws("|", x["name"], x["url"], F.when(x["internal"], F.lit("in")).otherwise(F.lit("out"))))
    # a filter on ``found`` would be tried before it, on links found a second time
    return t.select("k", F.explode(F.filter(F.array(F.array_join(lines, " ; ")), lambda x: x != "")).alias("found"))


@_on(
    _LISTING,
    f", {_FOUR} select k, string_agg(distinct regexp_extract(u, '//(www\\.)?([^/]*)', 2), ' ' order by regexp_extract(u, '//(www\\.)?([^/]*)', 2)) hosts from l where not starts_with(u, 'https://list.example.org') group by k",
)
def chrome_hosts(t: DataFrame) -> DataFrame:
    """Outside hosts of listing pages."""
    return t.select("k", F.array_join(F.array_sort(html.chrome_hosts(F.col("page"), F.col("base"))), " ").alias("hosts"))


@_on(_LISTING, f""", {_FOUR}, f as (select * from l where not starts_with(u, 'https://list.example.org') and not contains(u, 'facebook') and not contains(u, '.org') and contains(regexp_replace(split_part(u, '/', 3), '[^a-z0-9]', '', 'g'), 'abbeyroad'))
    select t.k, coalesce(min(split_part(u, '#', 1)), '') site from t left join f on f.k = t.k group by 1""")
def outbound_site(t: DataFrame) -> DataFrame:
    """The site of a named club among a page's links; one host belongs to the listing."""
    site = html.outbound_site(F.col("page"), F.col("base"), F.array(F.lit("abbeyroad.org")), F.lit("Abbeyroad Tennis Club"))
    return t.select("k", site.alias("site"))


@_on(
    _LISTING,
    "select k, case when lower(t2) = 'next' and k % 9 <> 0 then 'https://list.example.org' || h2 when t4 in ('Next', 'siguiente') then 'https://list.example.org' || h4 end page from t",
)
def next_page(t: DataFrame) -> DataFrame:
    """The next page of a listing; some have been read."""
    seen = F.when(
        F.col("k") % 9 == 0,
        F.array(F.concat(F.lit("https://list.example.org"), "h2")),
    ).otherwise(F.array().cast("array<string>"))
    return t.select("k", html.next_page(F.col("page"), F.col("base"), seen).alias("page"))


@_on(f"select {_K} k, {_at('/a/../b,c/./d?e#f,//K.es:443/z,../q,?p=2,HTTP://K.es:80,#x', 'p_partkey % 7')} link, 'https://h.es/x/y' || cast(p_partkey as string) base from {{part}}",
     "select k, case k % 7 when 0 then 'https://h.es/b' when 1 then 'https://h.es/x/c/d?e#f' when 2 then 'https://k.es/z' when 3 then 'https://h.es/q' when 4 then base || '?p=2' when 5 then 'http://k.es/' else base || '#x' end url from t")
def url_resolve(t: DataFrame) -> DataFrame:
    """Links made absolute."""
    return t.select("k", urls.resolve(F.col("link"), F.col("base")).alias("url"))


@_on(f"select {_K} k, {_at('www.a.es,https://B.es/p/,x,https://facebook.com/c,HTTP://c.ie; d,  https://e.pt/', 'p_partkey % 6')} || case when p_partkey % 5 = 0 then ' and more' else '' end site from {{part}}",
     "select k, case k % 6 when 0 then 'http://www.a.es' when 1 then 'https://b.es/p/' when 4 then 'http://c.ie' when 5 then 'https://e.pt' else '' end site from t")
def site_normalise(t: DataFrame) -> DataFrame:
    """Web sites from free text."""
    return t.select("k", urls.normalised_site(F.col("site")).alias("site"))


@_on(f"select {_K} k, {_at('info@tegvitoria.com,x@gmail.com,a@Club.ES,b@gov.uk,c@x.gov.br,none,d@yahoo.es', 'p_partkey % 7')} email from {{part}}",
     "select k, case k % 7 when 0 then 'https://tegvitoria.com' when 2 then 'https://club.es' when 3 then 'https://gov.uk' else '' end site from t")
def email_sites(t: DataFrame) -> DataFrame:
    """Web sites that addresses stand for."""
    return t.select("k", emails.site_from_email(F.col("email")).alias("site"))


@_on(f"select {_K} k, {_at('Home - Tennis Club,Club de Padel | Inicio,Welcome to Squash Club,News – Racquet Club,Plain Title,Fast | Slow', 'p_partkey % 6')} || ' ' || cast(p_partkey as string) title from {{part}}",
     """select k, case k % 6 when 0 then 'Tennis Club ' || k when 1 then 'Club de Padel' when 2 then 'Squash Club ' || k when 3 then 'Racquet Club ' || k when 4 then title else 'Fast' end "name" from t""")  # fmt: skip
def title_names(t: DataFrame) -> DataFrame:
    """Names from titles."""
    return t.select("k", html.name_from_title(F.col("title")).alias("name"))


@_on(f"""select *, '<title>' || title || '</title><META property="og:site_name" content="' || site || '"><h1>' || head || '</h1>' page from (select {_K} k, case when p_partkey % 4 = 0 then '' else 'Start ' || cast(p_partkey as string) end title,
        {_at('Abbey Tennis Club,Green Place', 'p_partkey % 2')} site, 'Club ' || cast(p_partkey as string) || ' &amp; Co' head from {{part}})""",
     "select k, case when k % 2 = 0 then site else 'Club ' || k || ' & Co' end \"name\", concat_ws('|', nullif(title, ''), site, 'Club ' || k || ' & Co') candidates from t")
def page_names(t: DataFrame) -> DataFrame:
    """What pages call themselves."""
    found = lambda c: F.struct(html.page_name(F.col("page"), c).alias("name"), F.array_join(c, "|").alias("candidates"))
    return t.select("k", F.inline(F.array(rx.let(html.name_candidates(F.col("page")), found))))


@_on(
    f"select {_K} k, 'A&amp;B&nbsp; &#' || cast(65 + p_partkey % 26 as string) || ';&#233; &copy; x&#' || cast(9731 as string) || ';' x from {{part}}",
    "select k, 'A&B ' || chr((65 + k % 26)::int) || 'é x☃' text from t",
)
def entities(t: DataFrame) -> DataFrame:
    """Entities decoded."""
    return t.select("k", html.decode_entities(F.col("x")).alias("text"))


@_on(f"""select {_K} k, case p_partkey % 5 when 0 then '<meta http-equiv="refresh" content="0; url=/new/' || cast(p_partkey as string) || '">' when 1 then '<META http-equiv=''Refresh'' content=''5;URL=https://o.es/''>' || repeat('x', 1000)
        when 2 then '<meta http-equiv="refresh" content="0;/.well-known/sgcaptcha/">' when 3 then '<p>Are you a human</p>' || repeat('x', 1000) else '<p>plain</p>' end page from {{part}}""",
     "select k, case k % 5 when 0 then 'https://h.es/new/' || k when 1 then 'https://o.es/' else '' end target, k % 5 in (0, 2, 3) challenge from t")
def refresh_targets(t: DataFrame) -> DataFrame:
    """Where pages send a visitor, and which ask for proof of a person."""
    return t.select(
        "k",
        html.refresh_target(F.col("page"), F.lit("https://h.es/x")).alias("target"),
        rules.is_challenge(F.col("page")).alias("challenge"),
    )


@_on(
    f"select {_K} k, {_at('<div id=\"__NEXT_DATA__\">,<div ng-app>,window.__s=1,Window.__s,plain', 'p_partkey % 5')} page from {{part}}",
    "select k, k % 5 < 3 drawn from t",
)
def script_pages(t: DataFrame) -> DataFrame:
    """Pages that a script draws."""
    return t.select("k", rules.drawn_by_script(F.col("page")).alias("drawn"))


@_on(f"""select {_K} k, '<p>' || {_at('Contact:,Secretary -,Presidente:,Email:,gerente:', 'p_partkey % 5')} || '</p>&nbsp;<b>' || {_at('Ana Ruiz,Jo Bell,María José Peña,Tennis Club', 'p_partkey % 4')} || '</b>, rest' page from {{part}}""",
     "select k, case when k % 5 = 3 or k % 4 = 3 then '' else split_part('Ana Ruiz,Jo Bell,María José Peña', ',', (k % 4 + 1)::int) end contact from t")
def contact_names(t: DataFrame) -> DataFrame:
    """Persons named beside a label."""
    return t.select("k", emails.contact_name(F.col("page")).alias("contact"))


@_on(f"""select *, '<a href="mailto:' || e1 || '">x</a> ' || e2 || ' <p>' || e3 || '</p> no-reply@h.es a@example.com logo@2x.png' page from (select {_K} k, 'h' || cast(p_partkey % 9 as string) || '.es' host,
        'Contact@h' || cast(p_partkey % 5 as string) || '.es' e1, 'zed' || cast(p_partkey as string) || '@h' || cast(p_partkey % 9 as string) || '.es' e2, {_at('info [at] x [dot] org,info@x.org', 'p_partkey % 2')} e3 from {{part}})""",
     """, e as (select k, host, 1 i, lower(e1) e from t union all select k, host, 2, e2 from t union all select k, host, 3, 'info@x.org' from t),
    r as (select k, e, row_number() over (partition by k order by not ends_with(e, '@' || host), case when starts_with(e, 'info@') then 0 when starts_with(e, 'contact@') then 1 else 99 end, case when i = 3 and k % 2 = 0 then 9 else i end) n from e)
    select k, max(e) filter (n = 1) email, string_agg(e, ' ' order by n) filter (n between 2 and 4) alt, count(*)::int n from r group by k""")  # fmt: skip
def emails_ranked(t: DataFrame) -> DataFrame:
    """The best address of a page, and the next three."""
    rows = merge.with_emails(t.withColumn("all", emails.extract_emails(F.col("page"), F.concat(F.lit("www."), "host"))), "all")
    return rows.select("k", "email", F.array_join("alt", " ").alias("alt"), F.size("all").alias("n"))


@_on(f"select {_K} k, 'club' || cast(p_partkey % 6 as string) || '.es' site, split('a@x.es,b@club' || cast(p_partkey % 4 as string) || '.es,c@list.org,d@sub.list.org', ',') found, split('a@x.es,z@y.es', ',') listed from {{part}}",
     "select k, case when k % 4 <> k % 6 then '' else 'b@' || site end own, 'b@club' || k % 4 || '.es d@sub.list.org' left_ from t")
def own_addresses(t: DataFrame) -> DataFrame:
    """Addresses on a site's domain, and those that are not the listing's."""
    left = emails.listing_emails(F.col("found"), F.col("listed"), F.lit("list.org"))
    return t.select(
        "k",
        F.coalesce(emails.on_own_domain(F.col("found"), F.col("site")), F.lit("")).alias("own"),
        F.array_join(left, " ").alias("left_"),
    )


@_on(f"""select {_K} k, {_at('Club de Tenis Pontevedra,Mount Schank Tennis Club,Tennis Club,Ábaco Racquet Hub,Royal Green Bowls Town', 'p_partkey % 5')} name, {_at('https://www.pontevedra.es,https://mountness.org,https://abaco-hub.com,https://rgbt.org', 'p_partkey % 4')} url from {{part}}""",
     """, w as (select k, case k % 5 when 0 then ['pontevedra'] when 1 then ['mount', 'schank'] when 2 then [] when 3 then ['abaco'] else ['royal', 'green', 'bowls', 'town'] end tokens,
        case k % 5 when 0 then 'cdtp' when 1 then 'mstc' when 2 then 'tc' when 3 then 'arh' else 'rgbt' end initials, split_part('pontevedraes,mountnessorg,abacohubcom,rgbtorg', ',', (k % 4 + 1)::int) flat from t)
    select k, array_to_string(tokens, ' ') tokens, len(tokens) > 0 and (len(list_filter(tokens, lambda x: contains(flat, x))) > 0 or (length(initials) >= 3 and starts_with(flat, initials))) plausible,
        case when len(tokens) = 0 then 0.0 else len(list_filter(tokens, lambda x: contains('https' || case when k % 4 = 0 then 'www' else '' end || flat, x))) / len(tokens)::double end overlap from w""")  # fmt: skip
def site_plausible(t: DataFrame) -> DataFrame:
    """Whether hosts fit names, by words and by initials."""
    name, url = F.col("name"), F.col("url")
    return t.select(
        "k",
        F.array_join(rules.name_tokens(name), " ").alias("tokens"),
        rules.plausible_site(name, url).alias("plausible"),
        rules.name_overlap(name, url).alias("overlap"),
    )


@_on(f"select {_K} k, {_at('Tennis Club,Court Booking for South Africa,Club Peruano,Padel India,Kenya Squash', 'p_partkey % 5')} name, {_at('ZA,IN,KE', 'p_partkey % 3')} cc from {{part}}",
     "select k, case k % 5 when 1 then nullif('South Africa', case when cc = 'ZA' then 'South Africa' end) when 3 then nullif('India', case when cc = 'IN' then 'India' end) when 4 then nullif('Kenya', case when cc = 'KE' then 'Kenya' end) end other from t")
def other_countries(t: DataFrame) -> DataFrame:
    """Names that have another country's."""
    return t.select("k", rules.names_other_country(F.col("name"), F.col("cc")).alias("other"))


@_on(
    f"select {_K} k, 'https://dir.org/' || {_at('Europe/Spain/Clubs,x/Reino_Unido/,Espa%C3%B1a,South_Africa/y,nowhere', 'p_partkey % 5')} url from {{part}}",
    "select k, split_part('ES,GB,ES,ZA,', ',', (k % 5 + 1)::int) cc from t",
)
def path_countries(t: DataFrame) -> DataFrame:
    """Countries that paths name."""
    return t.select("k", urls.country_of_path(F.col("url")).alias("cc"))


_PAIRS = f"""select {_K} k, {_at('name,official_name,club', 'p_partkey % 3')} k1, 'Tennis ' || cast(p_partkey as string) v1, {_at('sport,leisure', 'p_partkey % 2')} k2, {_at('tennis,sports_centre,table_tennis,soccer; padel', 'p_partkey % 4')} v2, 'alt_name' k3, ' Alt ' v3 from {{part}}"""


@_on(
    _PAIRS,
    """select k, case when k1 = 'club' then 'Alt' else v1 end "name", coalesce((k1 = 'name' and k2 = 'sport' and v2 in ('tennis', 'soccer; padel')) or (k2 = 'leisure' and v2 = 'sports_centre' and k1 = 'name'), false) candidate from t""",
)
def map_candidates(t: DataFrame) -> DataFrame:
    """Names of map elements, and which the map database would return."""
    tags = F.create_map("k1", "v1", "k2", "v2", "k3", "v3")
    return t.select(
        "k",
        rx.pick(tags, "name", "official_name", "alt_name").alias("name"),
        sources.is_map_candidate(tags).alias("candidate"),
    )


@_on(f"""select {_K} k, 200 + cast(p_partkey % 3 as int) * 100 status, {_at('text/html,image/png,,application/xml', 'p_partkey % 4')} content_type, case p_partkey % 5 when 0 then '' when 1 then cast(null as string) when 2 then ' <!DOCTYPE html>x' else 'plain' end html from {{part}}""",
     "select k from t where status < 300 and length(html) > 0 and (content_type in ('text/html', 'application/xml') or (content_type = '' and k % 5 = 2))")
def page_acceptance(t: DataFrame) -> DataFrame:
    """Fetches that count as pages."""
    return sources.accepted_pages(t).select("k")


@_on(f"""select {_K} k, 'h' || cast(p_partkey % 40 as string) || '.es' host, 'https://h' || cast(p_partkey % 40 as string) || '.es/' || {_at('a/b,admin/x,tmp,', 'p_partkey % 4')} url from {{part}}""",
     """, d as (select distinct host, case when cast(substr(split_part(host, '.', 1), 2) as int) % 2 = 0 then '/admin' else '/tmp' end prefix from t)
    select k from t where not exists (select 1 from d where d.host = t.host and starts_with(substr(url, length('https://' || t.host) + 1), prefix))""")  # fmt: skip
def robots_allowed(t: DataFrame) -> DataFrame:
    """Pages that their hosts' robots files let everybody read."""
    number = F.regexp_extract("host", r"\d+", 0).cast("int")
    even = F.lit("User-Agent: BadBot\nDisallow: /\n\nuser-agent: *\n Disallow:  /admin \nDisallow:\nUser-agent: x\nDisallow: /a")
    odd = F.lit("Disallow: /a\r\nUser-agent: * \r\nCrawl-delay: 9\r\ndisallow: /tmp")
    files = t.select("host", F.when(number % 2 == 0, even).otherwise(odd).alias("body")).distinct()
    return sources.allowed_pages(t, sources.robots_rules(files)).select("k")


@_on(f"""select {_K} k, 'q' || cast(p_partkey as string) query, '<a rel="n" href="//r.com/l?uddg=https%3A%2F%2Fa' || cast(p_partkey as string) || '.es%2Fp%23f&amp;r=1"><b>A &amp; B</b>&hellip; ' || cast(p_partkey as string) || '</a><a href="/l?uddg=https%3A%2F%2Fa' || cast(p_partkey as string)
        || '.es%2Fp">again</a><a href="/other">no</a><a href="/l?uddg=ftp%3A%2F%2Fx">ftp</a><a href="/l?uddg=http%3A%2F%2Fb.es">b</a>' html from {{part}}""",
     "select query, 0 \"rank\", 'https://a' || k || '.es/p' url, 'A & B ' || k title from t union all select query, 3, 'http://b.es', 'b' from t")
def search_results(t: DataFrame) -> DataFrame:
    """Results on search pages, each URL once."""
    return sources.search_results(t.select("query", "html"))


@_on(f"select {_K} k, cast(p_partkey % 90 as int) page, '<a href=\"/v?VenueId=V' || cast(p_partkey as string) || '\">x</a><a href=\"/v?VenueId=V' || cast(p_partkey as string) || '&b\">y</a> venueid=no VenueId=W' || cast(p_partkey % 5 as string) html from {{part}}",
     "select page, 'V' || k id from t union all select page, 'W' || k % 5 from t")
def register_ids(t: DataFrame) -> DataFrame:
    """Venues on register pages."""
    return sources.register_ids(t.select("page", "html"))


@_on(f"select {_K} k, '{{{{\"results\":{{{{\"bindings\":[{{{{\"item\":{{{{\"value\":\"i' || cast(p_partkey as string) || '\"}}}},\"itemLabel\":{{{{\"value\":\"' || {_at('Club,Q12,Abbey', 'p_partkey % 3')} || '\"}}}},\"web\":{{{{\"value\":\"https://w.es\"}}}},\"ccode\":{{{{\"value\":\"es\"}}}}}}}},{{{{\"item\":{{{{\"value\":\"n\"}}}}}}}}]}}}}}}}}' value from {{part}}",
     "select 'i' || k item, split_part('Club,Q12,Abbey', ',', (k % 3 + 1)::int) label, 'https://w.es' web, 'ES' cc from t where k % 3 <> 1")
def query_bindings(t: DataFrame) -> DataFrame:
    """Rows of query results that have a site and a name."""
    return sources.bindings(t)


@_on(f"""select {_K} k, '<html><head><title>x</title></head><body>' || cast(p_partkey as string) || '<script id="baked-data">old</script>
</body></html>' page, '["a:<b>' || cast(p_partkey as string) || '"]' data from {{part}}""",
     """select k, '<html><head><title>x</title><script id="baked-data">' || replace(data, '<', chr(92) || 'u003c') || '</script></head><body>' || k || '</body></html>' page from t""")  # fmt: skip
def baked_pages(t: DataFrame) -> DataFrame:
    """Pages with their data in a script element."""
    return t.select("k", sources.baked(F.col("page"), F.col("data")).alias("page"))


@_on(f"""select *, '<title>' || title || ' | LTA</title><div class="c__header">Email</div> <a href="mailto:' || email || '">e</a></div><div class="c__header" x> Phone </div><p>' || phone || '</p></div>' page
        from (select {_K} k, 'Abbey &#x27;' || cast(p_partkey as string) title, 'a' || cast(p_partkey as string) || '@b.uk' email, '01 &#x2B;' || cast(p_partkey as string) phone from {{part}})""",
     "select k, 'Abbey ''' || k \"name\", 'mailto:' || email email, '01 +' || k phone, '' fax from t")
def register_cards(t: DataFrame) -> DataFrame:
    """Fields of contact cards."""
    page = F.col("page")
    return t.select(
        "k",
        html.venue_name(page).alias("name"),
        *(html.card_field(page, f).alias(f.lower()) for f in ("Email", "Phone", "Fax")),
    )


@_on(
    f"select {_K} k, {_at('a%20b+c,%41%C3%A9,%zz,plain', 'p_partkey % 4')} x from {{part}}",
    "select k, case k % 4 when 0 then 'a b+c' when 1 then 'Aé' when 3 then 'plain' end text from t",
)
def percent_decoded(t: DataFrame) -> DataFrame:
    """URL escapes."""
    return t.select("k", rx.percent_decoded(F.col("x")).alias("text"))


@_on(f"select {_K} k, 'añb' || cast(p_partkey as string) x, cast(p_partkey % 3 as int) which from {{part}}", "select k, x text from t")
def decoded_charsets(t: DataFrame) -> DataFrame:
    """Bodies in three character sets."""
    body = F.when(F.col("which") == 0, F.encode("x", "UTF-8")).when(F.col("which") == 1, F.encode("x", "ISO-8859-1")).otherwise(F.encode("x", "UTF-16LE"))
    kind = F.concat(
        F.lit("text/html; charset="),
        F.element_at(F.array(F.lit("utf8"), F.lit("latin1"), F.lit("utf-16le")), F.col("which") + 1),
    )
    return t.select("k", sources.decoded(body, kind).alias("text"))


@_on("select cast(event_id as bigint) ord, event_type kind from {events}", "select ord, kind from t order by ord desc limit 50")
def activity_tail(t: DataFrame) -> DataFrame:
    """The newest lines of a log."""
    return sources.newest(t, "ord", 50)


@_on("select cast(event_id as bigint) ord, event_type kind from {events}", "select ord, kind from t order by ord desc limit 400")
def log_trimmed(t: DataFrame) -> DataFrame:
    """A long log cut to its last lines."""
    return sources.trimmed_log(t, "ord")


@_on(f"select {_K} k, 'ES' cc, 'https://s.es/' || cast(p_partkey as string) url from {{part}}",
     ", l as (select url || '/deep' u from t where k % 4 = 0 union all select url from t where k % 6 = 0) select 'ES  ' || url as value from t where not exists (select 1 from l where starts_with(u, url))")
def seeds_to_append(t: DataFrame) -> DataFrame:
    """Seeds that a list does not have yet."""
    lines = t.filter("k % 4 = 0").select(F.concat(F.lit("ES "), "url", F.lit("/deep")).alias("value"))
    lines = lines.unionByName(t.filter("k % 6 = 0").select(F.concat(F.lit("# old "), "url").alias("value")))
    return sources.new_seeds(t.unionByName(t).select("cc", "url"), lines)
