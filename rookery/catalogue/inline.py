"""Small tables that are written out in the queries, for Spark and for SQL alike."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import spread


def _literal(x: object) -> str:
    if x is None:
        return "null"
    if isinstance(x, bool):
        return str(x).lower()
    if isinstance(x, (list, tuple)):
        return "[" + ", ".join(map(_literal, x)) + "]"
    return "'" + x.replace("'", "''") + "'" if isinstance(x, str) else repr(x)


_KINDS = {"string": "varchar", "array<string>": "varchar[]", "bigint": "bigint", "int": "int", "double": "double", "boolean": "boolean"}


class Table:
    """Some rows for the edges, and ``more``: a select over given tables (as ``{name}``) in the SQL that Spark and DuckDB share."""

    def __init__(self, ddl: str, *rows: tuple, more: str = ""):
        self.ddl, self.rows, self.more = ddl, rows, more
        self.columns = [tuple(x.split()) for x in ddl.split(", ")]

    def spark(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        few = spark.createDataFrame(list(self.rows), self.ddl)
        if not self.more:
            return few
        names = set(re.findall(r"\{(\w+)\}", self.more))
        many = spark.sql(self.more, **{n: spread(spark.read.parquet(f"{sf_dir}/{n}.parquet")) for n in names})
        return few.unionByName(many.select(*(F.col(n).cast(kind).alias(n) for n, kind in self.columns)))

    @property
    def sql(self) -> str:
        def casts(names: list[str]) -> str:
            return ", ".join(f'cast({c} as {_KINDS[kind]}) "{n}"' for c, (n, kind) in zip(names, self.columns, strict=True))

        places = [f"c{i}" for i in range(len(self.columns))]
        rows = ", ".join("(" + ", ".join(map(_literal, r)) + ")" for r in self.rows)
        few = f"select {casts(places)} from (values {rows}) v({', '.join(places)})"
        more = re.sub(r"\{(\w+)\}", r"\1", self.more)
        many = casts([f'"{n}"' for n, _ in self.columns])
        return f"({few} union all select {many} from ({more}))" if more else f"({few})"


_CC, _COUNTRY = "ES,GB,BR,AR,US,AU,PT,MX,IE,CL", "Spain,United Kingdom,Brazil,Argentina,United States,Australia,Portugal,Mexico,Ireland,Chile"
_LANG = "Spanish,English,Portuguese,Spanish,English,English,Portuguese,Spanish,English,Spanish"
_WORD = "Tennis Club,Club de Padel,Squash Centre,Municipal Tennis Centre,Padel Tennis Club,Racquet Academy,Tenis,Universidad Squash,Golf House"
_TLD = "es,co.uk,com.br,com,org,au,pt,tv,ie,cl"
_CITY = "Madrid,Leeds,Santos,Rosario,Austin,Perth,Porto,Toluca,Cork,Arica"


def _at(values: str, index: str) -> str:
    """An entry of a comma-separated list by an expression that counts from 0."""
    return f"split_part('{values}', ',', cast({index} as int) + 1)"


_ROWS = f"""select cast(c_custkey as bigint) k, {_at(_CC, 'c_nationkey % 10')} cc, {_at(_COUNTRY, 'c_nationkey % 10')} country, {_at(_LANG, 'c_nationkey % 10')} lang, {_at(_CITY, 'c_nationkey % 10')} city,
    {_at(_WORD, 'c_custkey % 9')} || ' ' || cast(c_custkey % 700 as string) club, 'https://www.club' || cast(c_custkey % 1100 as string) || '.' || {_at(_TLD, 'c_custkey % 10')} site from {{customer}}"""


def _records(shift: int) -> str:
    """Records made of customers; those of another shift have partly the same keys."""
    return f"""select case when k % 3 = 0 then 'n:' || cc || ':' || lower(replace(club, ' ', '')) || cast(k as string) else 'w:club' || cast(k + {shift} as string) || '.es' end key, 1000 + k ord, case when k % 41 = 0 then '' else club end name,
        cc, country, case when k % 37 = 0 then cast(null as string) else lang end lang, split({_at('Tennis,Padel/Tennis,Squash/Padel,Tennis/Squash/Padel', f'(k + {shift}) % 4')}, '/') sports,
        case when k % 3 = 0 then '' else site end website, case when k % 4 = 0 then '' when k % 4 = 1 then cast(null as string) else 'Info@club' || cast((k + {shift}) % 450 as string) || '.es' end email,
        case when k % 5 = 0 then 'Person ' || cast(k as string) else '' end contact, {_at('map,harvest,prospect,register,leads', 'k % 5')} src, case when k % 6 = 0 then cast(null as string) else city end city, k % 2 = 0 crawled,
        case when k % 7 = 0 then cast(null as boolean) else k % 7 = 1 end stale, case when k % 11 = 0 then cast(null as int) else cast(k % 6 as int) end attempts,
        case when k % 3 = 1 then {_at('unreachable,no email published,homepage,blocked by a challenge page', 'k % 4')} end crawlNote,
        case when k % 8 = 0 then cast(null as string) else '2026-0' || cast(1 + k % 3 as string) || '-' || lpad(cast(1 + k % 28 as string), 2, '0') end lastTried, case when k % 9 = 0 then 1772400000000 + (k % 1000) * 300000 end retryAfter from ({_ROWS})"""


STORE = Table(
    "key string, ord bigint, name string, cc string, country string, lang string, sports array<string>, website string, email string, contact string, src string, city string, crawled boolean, stale boolean, attempts int, crawlNote string, lastTried string, retryAfter bigint",
    (
        "w:a.es",
        1,
        "Club Uno",
        "ES",
        "Spain",
        "Spanish",
        ["Tennis"],
        "https://a.es",
        "Info@a.es",
        "",
        "map",
        "Madrid",
        True,
        False,
        1,
        "homepage",
        "2026-01-02",
        None,
    ),
    (
        "n:ES:clubuno",
        2,
        "Club Uno Tenis",
        "ES",
        "Spain",
        "Spanish",
        ["Padel", "Tennis"],
        "",
        "info@a.es",
        "Ana Ruiz",
        "harvest",
        None,
        True,
        None,
        0,
        None,
        None,
        None,
    ),
    (
        "w:b.co.uk",
        3,
        "B Tennis Club",
        "GB",
        "United Kingdom",
        "English",
        ["Tennis", "Squash"],
        "https://b.co.uk",
        "sec@b.co.uk",
        None,
        None,
        "Leeds",
        True,
        True,
        1,
        "contact",
        "2026-02-01",
        None,
    ),
    (
        "w:c.pt",
        4,
        "Clube C",
        "PT",
        "Portugal",
        "Portuguese",
        ["Padel"],
        "https://c.pt",
        "",
        "",
        "prospect",
        "Porto",
        False,
        None,
        2,
        "unreachable",
        "2026-03-01",
        1772500000000,
    ),
    (
        "w:d.es",
        5,
        "Club D",
        "ES",
        "Spain",
        "Spanish",
        ["Squash"],
        "https://d.es",
        None,
        None,
        "map",
        None,
        True,
        None,
        4,
        "no email published",
        "2026-01-10",
        None,
    ),
    (
        "w:e.br",
        6,
        "Clube E",
        "BR",
        "Brazil",
        "Portuguese",
        ["Tennis"],
        "https://e.br",
        None,
        None,
        "map",
        "Santos",
        False,
        None,
        None,
        None,
        None,
        None,
    ),
    (
        "w:f.ie",
        7,
        "F Club",
        "IE",
        "Ireland",
        "English",
        ["Tennis"],
        "https://f.ie",
        None,
        None,
        "leads",
        None,
        True,
        None,
        4,
        "no email published",
        "2026-03-02",
        None,
    ),
    *(
        (
            f"n:US:x{i}",
            10 + i,
            f"X Club {i}",
            "US",
            "United States",
            "English",
            ["Tennis"],
            "",
            "office@fed.org",
            "",
            "register",
            None,
            True,
            None,
            0,
            None,
            None,
            None,
        ) for i in range(6)
    ),
    *(
        (
            f"n:US:y{i}",
            20 + i,
            f"Y Club {'Y' * (i % 3)}",
            "US",
            "United States",
            "English",
            ["Padel"],
            "",
            "chain@y.com",
            "Bo" if i > 2 else "",
            "register",
            None,
            True,
            None,
            0,
            None,
            None,
            None,
        ) for i in range(5)
    ),
    (
        "n:US:noemail",
        30,
        "",
        "US",
        "United States",
        "English",
        ["Tennis"],
        "",
        "z@z.com",
        "",
        "register",
        None,
        False,
        None,
        3,
        "unreachable",
        "2026-03-03",
        1,
    ),
    more=_records(0),
)
NEW = Table(
    STORE.ddl,
    (
        "w:c.pt",
        1,
        "Clube C",
        "PT",
        "Portugal",
        "Portuguese",
        ["Tennis", "Padel"],
        "https://c.pt/x",
        "geral@c.pt",
        "Rui",
        "map",
        None,
        True,
        None,
        0,
        None,
        None,
        None,
    ),
    ("w:c.pt", 2, "Other C", "PT", "Portugal", "Portuguese", ["Squash"], "", "late@c.pt", "", "map", None, True, None, 0, None, None, None),
    (
        "n:ES:clubuno",
        3,
        "Club Uno",
        "ES",
        "Spain",
        "Spanish",
        ["Squash"],
        "https://uno.es",
        "x@uno.es",
        "Eva",
        "map",
        None,
        True,
        None,
        0,
        None,
        None,
        None,
    ),
    (
        "w:new.ie",
        4,
        "New Club",
        "IE",
        "Ireland",
        "English",
        ["Tennis"],
        "https://new.ie",
        "",
        "",
        "map",
        None,
        False,
        None,
        0,
        None,
        None,
        None,
    ),
    ("w:new.ie", 5, "New Club", "IE", "Ireland", "English", ["Padel"], "", "hi@new.ie", "Jo", "map", None, True, None, 0, None, None, None),
    more=_records(300),
)
CITIES = Table(
    "ord bigint, name string, lat double, lon double, cc string, population bigint",
    (1, "Santos", -23.96, -46.33, "BR", 430000),
    (2, "São Paulo", -23.55, -46.63, "BR", 12000000),
    (3, "Leeds", 53.8, -1.55, "GB", 530000),
    (4, "York", 53.96, -1.08, "GB", 150000),
    (5, "New York Mills", 53.9, -1.1, "GB", 25000),
    (6, "leeds", 53.7, -1.4, "GB", 530000),
    (7, "Tiny", 53.0, -1.0, "GB", 900),
    (8, "Nowhere", 1.0, 1.0, "XX", 90000),
    (9, "Córdoba", 37.88, -4.77, "ES", 320000),
    more=f"""select 100 + k ord, name, lat, lon, cc, pop population from (select cast(p_partkey as bigint) k, 'Town ' || cast(p_partkey % 601 as string) name, 36.0 + (p_partkey % 199) * 0.09 lat, -9.0 + (p_partkey % 157) * 0.08 lon,
        {_at(_CC, 'p_partkey % 10')} cc, 15000 + (p_partkey * 7919) % 90000 pop from {{part}})""",
)
RECORDS = Table(
    "key string, cc string, name string, town string, lat double, lon double, city string",
    ("a", "BR", "Tenis Clube de Santos", None, None, None, None),
    ("b", "GB", "Some Squash Club", "LEEDS", None, None, None),
    ("c", "GB", "Near Club", None, 53.95, -1.09, None),
    ("d", "GB", "New York Mills Padel", "", None, None, None),
    ("e", "GB", "Far Club", None, 50.0, 0.0, None),
    ("f", "ES", "Club Cordoba", None, None, None, None),
    ("g", "ES", "Own", "Córdoba", None, None, "Sevilla"),
    more=f"""select 'c' || cast(k as string) key, cc, case when k % 4 = 0 then 'Club of Town ' || cast(k % 650 as string) else club end name, case when k % 5 = 0 then 'TOWN ' || cast(k % 640 as string) when k % 5 = 1 then '' end town,
        case when k % 3 = 0 then 36.0 + (k % 181) * 0.1 end lat, case when k % 3 = 0 then -9.0 + (k % 149) * 0.085 end lon, case when k % 17 = 0 then city end city from ({_ROWS})""",
)
NAMES = Table(
    "id bigint, name string, website string, email string",
    (1, "Tênis Clube de Santos", "", ""), (2, "Tennisworld", "", ""), (3, "Padel Tennis Club", "", ""), (4, "Tennis and Padel Tennis Club", "", ""),
    (5, "Community Tennis Centre", "", ""), (6, "Círculo de Tenis de Montevideo", "", ""), (7, "Tenis Pontevedra", "", ""), (8, "", "", ""),
    (9, "City Squash", "https://x.gov.uk", ""), (10, "PÁDEL CLUB", "", "a@mil.gob.es"), (11, "Squash Club", "https://s.com", "a@s.com"), (12, "Universidade de Tenis", "", ""),
    more=f"""select 100 + k id, case when k % 50 = 0 then '' else club end name, case when k % 13 = 0 then 'https://x' || cast(k as string) || '.gov.uk' when k % 3 = 0 then '' else site end website,
        case when k % 17 = 0 then 'a@b.edu' when k % 2 = 0 then '' else 'a@club.es' end email from ({_ROWS})""",
)
TAGS = Table("tag string", ("soccer;tennis",), ("tennis;padel",), ("table_tennis",), ("squash",), ("padel; squash",), (None,), ("tennis; padel",),
    more=f"""select {_at('soccer;tennis,tennis;padel,table_tennis,squash,padel; squash,paddle_tennis,tennis; squash,golf', 'p_partkey % 8')} || case when p_partkey % 3 = 0 then ';' || cast(p_partkey as string) else '' end tag from {{part}}""",
)
EDGES = Table("src string, dst string", ("a", "b"), ("b", "c"), ("c", "a"), ("a", "d"), ("d", "e"), ("x", "y"), ("e", "e"),
    more="""select case when p_partkey = 1 then 'a' else 'p' || cast(p_partkey as string) end src, 'p' || cast(2 * p_partkey as string) dst from {part}
        union all select case when p_partkey = 1 then 'a' else 'p' || cast(p_partkey as string) end, 'p' || cast(2 * p_partkey + 1 as string) from {part}""",
)
STATE = Table(
    "cc string, at string, error string, split boolean",
    ("ES", "2026-03-01 00:00:00", None, None), ("GB", "2026-03-02 00:00:00", "timeout", None), ("BR", "2026-03-03 11:50:00", "timeout", None), ("AR", "2026-03-03 11:55:00", "partial", True),
    ("US", "2026-02-01 00:00:00", None, None), ("PT", "2026-02-03 00:00:00", None, None),
    more=f"""select {_at('IN,BO,CA,CO,CR,CU,DO,EC,SV,GQ,GT,HN,MX,NI,PA,PY,PE,PR,UY,VE,CL,IE,AU,NZ,ZA', 'n_nationkey')} cc, '2026-02-' || lpad(cast(1 + n_nationkey as string), 2, '0') || ' 06:00:00' as at,
        case when n_nationkey % 5 = 0 then 'timeout of ' || n_name end as error, case when n_nationkey % 10 = 0 then true end as split from {{nation}}""",
)
RESULTS = Table(
    "lead bigint, query int, rank int, url string, own boolean, local boolean, platform boolean",
    (1, 1, 1, "u1", True, False, False), (1, 2, 3, "u2", True, True, False), (1, 1, 2, "u3", False, False, True), (2, 1, 9, "p1", False, False, True), (2, 1, 4, "p2", False, False, True), (3, 1, 11, "far", True, True, False), (4, 1, 1, "n", False, False, False),
    more="""select 1000 + cast(l_orderkey as bigint) lead, cast(l_linenumber % 2 + 1 as int) query, cast(l_linenumber * 2 as int) rank, 'u' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string) url,
        l_partkey % 5 = 0 own, l_partkey % 2 = 0 local, l_partkey % 3 = 0 platform from {lineitem}""",
)
CODES = Table("code string", ("4324a6b6",), ("1a73747c755a74757f34746b",), ("00616263",), ("",),
    more=f"""select '5a' || lower(hex(c_name)) code from {{customer}}""",
)
HOSTS = Table("name_value string", ("*.padelclub.es\nwww.padelclub.es",), ("mail.padelx.co.uk",), ("padel.com",), ("x@padel.es",), ("PADEL.FM\nclub.padelito.pt",),
    more=f"""select {_at('*.padel,www2.padel,mail.club,PADEL,cpanel.x-padel', 's_suppkey % 5')} || cast(s_suppkey as string) || '.' || {_at(_TLD, 's_suppkey % 10')} name_value from {{supplier}}""",
)
LINES = Table("ord bigint, value string", (1, "# comment"), (2, "ES https://a.es/clubs"), (3, "gb  http://b.co.uk"), (4, "XX https://x.xx"), (5, "AUTO https://auto.org/list"), (6, ""), (7, "ES not a url"),
    more=f"""select 1000 + cast(s_suppkey as bigint) ord, {_at('ES,gb ,# PT,XX,AUTO,', 's_suppkey % 6')} || ' https://h' || cast(s_suppkey as string) || '.com/clubs' value from {{supplier}}""",
)
LOG = Table("ord bigint, value string", (1, "RETRY https://a/1"), (2, "SEED https://a/1"), (3, "THIN https://a/2"), (4, "odd"),
    more=f"""select 1000 + cast(event_id as bigint) ord, {_at('SEED,THIN,RETRY,EXCLUDED', 'event_id % 4')} || ' https://h/' || cast(user_id as string) value from {{events}}""",
)
PLACES = Table(
    "cc string, name string, rank int",
    ("SG", "Singapore", 1),
    ("BR", "São Paulo", 1),
    ("BR", "Santos", 2),
    ("BR", "Recife", 3),
    ("GB", "Leeds", 1),
    ("FR", "Paris", 1),
    more=f"""select {_at(_CC, 'p_partkey % 10')} cc, 'Place ' || cast(p_partkey as string) name, cast(case when p_partkey % 10 in (1, 2) then 100 else 1 end + floor(p_partkey / 10) as int) rank from {{part}}""",
)
STATS = Table("cc string, city string, searches bigint, found bigint", ("SG", "", 6, 2), ("BR", "Santos", 3, 1), ("BR", "", 6, 0), ("BR", "Água Boa", 1, 0), ("BR", "Bagé", 2, 1), ("BR", "São Paulo", 1, 1),
    more=f"""select {_at(_CC, 'c_nationkey % 10')} cc, 'Town ' || cast(c_custkey % 97 as string) city, cast(count(*) as bigint) searches, cast(sum(c_custkey % 3) as bigint) found from {{customer}} group by 1, 2""",
)
ROUND = Table("cc string, city string, searches bigint, found bigint", ("BR", "Santos", 2, 2), ("SG", "", 1, 0), ("GB", "Leeds", 4, 0),
    more=f"""select {_at(_CC, 'c_nationkey % 10')} cc, 'Town ' || cast(c_custkey % 101 as string) city, cast(count(*) as bigint) searches, cast(sum(c_custkey % 2) as bigint) found from {{customer}} where c_custkey % 4 = 0 group by 1, 2""",
)
ASKED = Table("cc string, query string", *(("SG", f"q{i}") for i in range(9)), ("BR", "clube de squash Santos contato"),
    more=f"""select {_at(_CC, 'o_custkey % 10')} cc, 'query ' || cast(o_orderkey as string) query from {{orders}}""",
)
AREAS = Table("cc string, relation bigint, done boolean", ("AU", 2316593, True), ("AU", 2316594, False), ("GB", 2316593, False),
    more=f"""select {_at(_CC, 'p_partkey % 10')} cc, cast(p_partkey as bigint) relation, p_partkey % 4 = 0 done from {{part}}""",
)
LISTED = Table("page int, id string", (1, "A1"), (1, "A2"), (2, "A2"), (2, "B1"),
    more="""select cast(l_suppkey as int) page, 'V' || cast(l_partkey as string) id from {lineitem}""",
)
READ = Table("id string", ("A1",), ("B1",), ("B1",),
    more="""select 'V' || cast(p_partkey as string) id from {part} where p_partkey % 3 = 0""",
)
ERRORS = Table("error string", ("HTTP 504",), ("Query Timed out",), ("HTTP 400",), (None,), ("",),
    more=f"""select {_at('HTTP 504,query TIMED OUT,out of memory,HTTP 400,cut the query short', 'event_id % 5')} || ' ' || cast(event_id as string) error from {{events}}""",
)
LEADS = Table("key string, country string, website string, searched string", ("a", "Spain", "", "2026-01-01"), ("b", "Spain", "https://b.es", "2026-01-02"), ("c", "Chile", None, None), ("d", None, "", ""),
    more=f"""select 'n:' || cc || ':' || cast(k as string) key, case when k % 29 = 0 then '' else country end country, case when k % 3 = 0 then site else '' end website, case when k % 2 = 0 then '2026-0' || cast(1 + k % 3 as string) || '-10' end searched from ({_ROWS})""",
)
_CARD = '<html><title>{0} | LTA</title><body>Tennis courts <div class="c__header">Email</div><a href="mailto:{1}">e</a></div><div class="c__header">Website</div><a href="{2}">w</a></div></body></html>'
VENUES = Table(
    "id string, html string",
    (
        "v1",
        _CARD.format("Abbey Tennis Club", "Sec@abbey.co.uk", "https://abbey.co.uk"),
    ), (
        "v2",
        _CARD.format("3Tenn Bushey", "info@lta.org.uk", "https://3tenn.co.uk/"),
    ), ("v3", _CARD.format("3Tenn Leeds", "noreply@x.uk", "")),
    (
        "v4",
        _CARD.format("Quiet Tennis Club", "test@x.uk", "https://www.lta.org.uk"),
    ), ("v5", None), ("v6", "<p>no title</p>"), ("v7", _CARD.format("3Tenn Mill", "a@mill.co.uk", "https://mill.co.uk")),
)
SITES = Table(
    "url string, html string",
    ("https://3tenn.co.uk/", "<title>Bushey Tennis Club</title><p>Tennis for members</p>"),
    ("https://mill.co.uk", "<title>Mill Courts</title><p>Hire</p>"),
)
