"""Sources and sinks: stores, listings, registers, logs, extracts."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import html, rx, urls, values
from ..operators import ranges
from .json_split import json_store as json_store

CLUB = "key string, ord bigint, name string, cc string, country string, lang string, sports array<string>, website string, email string, alt array<string>, contact string, src string, srcPage string, city string, crawled boolean, stale boolean, restored boolean, attempts int, crawlNote string, lastTried string, retryAfter bigint"
ELEMENT = "type string, id bigint, lat double, lon double, center struct<lat:double,lon:double>, tags map<string,string>"


def countries(spark: SparkSession) -> DataFrame:
    """``cc, name, lang, prio``: the country dimension, some ninety rows."""
    place = {cc: i + 1 for i, cc in enumerate(values.PRIORITY)}
    return spark.createDataFrame(
        [(cc, name, lang, place[cc]) for cc, name, lang in values.COUNTRIES],
        "cc string, name string, lang string, prio int",
    )


def spread(rows: DataFrame) -> DataFrame:
    """The same rows over all shuffle partitions: a small file is one task, however much work there is for each of its rows."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def published_extract(spark: SparkSession, path: str, record: str) -> DataFrame:
    """The records of a published extract ``{"clubs": [...]}``; one without records is refused, as nothing could be restored from it."""
    rows = spark.read.schema(f"clubs array<struct<{record}>>").option("multiLine", True).json(path).select(F.explode("clubs").alias("r")).select("r.*")
    if rows.isEmpty():
        raise ValueError(f"{path}: no published records")
    return rows


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A log of JSON objects, broken lines left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def newest(rows: DataFrame, order: str, n: int) -> DataFrame:
    """The last ``n`` rows, newest first."""
    return rows.orderBy(F.desc(order)).limit(n)


def recent_lines(lines: DataFrame, order: str, n: int = 14) -> DataFrame:
    """The last ``n`` lines of a log that are not blank."""
    return newest(lines.filter(F.trim("value") != ""), order, n)


def seeds(lines: DataFrame) -> DataFrame:
    """``cc, url`` from ``CC URL`` lines; comments, blanks and unknown countries go."""
    line = F.trim("value")
    pattern = r"^(AUTO|[A-Za-z]{2})\s+(https?:\/\/\S+)$"
    rows = lines.filter(~line.startswith("#")).select(
        F.upper(rx.first(line, pattern, 1)).alias("cc"),
        rx.first(line, pattern, 2).alias("url"),
    )
    return rows.filter(F.col("cc").isin("AUTO", *(c for c, *_ in values.COUNTRIES)))


def verdicts(lines: DataFrame, order: str) -> DataFrame:
    """``url, verdict``: the last verdict that a log of ``VERDICT url`` lines has on each page."""
    parts = F.split("value", " ", 2)
    return lines.select(
        F.get(parts, F.lit(1)).alias("url"),
        parts[0].alias("verdict"),
        order,
    ).filter("url is not null").groupBy("url").agg(F.max_by("verdict", order).alias("verdict"))


def geonames(spark: SparkSession, path: str) -> DataFrame:
    """``ord, name, lat, lon, cc, population`` of a tab-separated place list, in the order of its lines; what is no number counts as 0."""
    rows = spark.read.option("sep", "\t").option("quote", "").csv(path)
    return rows.select(
        F.monotonically_increasing_id().alias("ord"),
        F.col("_c1").alias("name"),
        F.expr("try_cast(_c4 as double)").alias("lat"),
        F.expr("try_cast(_c5 as double)").alias("lon"),
        F.col("_c8").alias("cc"),
        F.coalesce(F.expr("try_cast(_c14 as bigint)"), F.lit(0)).alias("population"),
    )


def accepted_pages(fetched: DataFrame, most: int = 4_000_000) -> DataFrame:
    """Fetches that count as pages: success, text or HTML (or no type, but markup), neither empty nor too long."""
    kind = F.coalesce("content_type", F.lit(""))
    typed = rx.like(kind, r"text\/|html|xml") | ((kind == "") & rx.like(F.col("html"), r"^\s*<(!doctype|html)"))
    return fetched.filter(F.col("status").between(200, 299) & typed & F.octet_length("html").between(1, most))


def robots_rules(files: DataFrame) -> DataFrame:
    """``host, prefix``: what robots files ``host, body`` disallow to every robot; a group of named robots is not ours."""
    lines = F.transform(F.split("body", r"\r?\n"), rx.trimmed)
    start = F.struct(F.lit(False).alias("ours"), F.array().cast("array<string>").alias("found"))

    def step(state: Column, line: Column) -> Column:
        prefix = rx.trimmed(F.regexp_replace(line, "^[^:]*:", ""))
        named = rx.like(line, "^user-agent:")
        kept = state["ours"] & rx.like(line, "^disallow:") & (prefix != "")
        ours = F.when(named, rx.like(line, r"\*\s*$")).otherwise(state["ours"])
        return F.struct(
            ours.alias("ours"),
            F.when(kept, F.concat(state["found"], F.array(prefix))).otherwise(state["found"]).alias("found"),
        )

    return files.select("host", F.explode(F.aggregate(lines, start, step)["found"]).alias("prefix"))


def allowed_pages(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Pages whose path begins with no disallowed prefix of their host's ``rules(host, prefix)``."""
    met = F.col("p.host").eqNullSafe(F.col("r.host")) & F.col("p.path").startswith(F.col("r.prefix"))
    return pages.withColumns(
        {"host": urls.host_of(F.col("url")), "path": urls.path_of(F.col("url"))}
    ).alias("p").join(rules.alias("r"), met, "left_anti")


def is_map_candidate(tags: Column) -> Column:
    """The three statements that a map database is asked."""
    named = F.element_at(tags, "name")
    sport = rx.like(F.element_at(tags, "sport"), values.MAP_SPORT, fold=False)
    club = rx.like(F.element_at(tags, "club"), values.MAP_CLUB, fold=False)
    centre = (F.element_at(tags, "leisure") == "sports_centre") & rx.like(named, values.MAP_CENTRE_NAME)
    return F.coalesce(((sport | club) & named.isNotNull()) | centre, F.lit(False))


def certificate_hosts(rows: DataFrame, word: str) -> DataFrame:
    """``host, cc``: distinct hosts with the word in certificate names, in a country of the list."""
    host = F.trim(F.lower(F.col("h")))
    for pattern in (r"^\*\.", r"^www\d*\.", values.PLUMBING):
        host = rx.sub(host, pattern, "")
    found = rows.select(F.explode(F.split("name_value", "\n")).alias("h")).select(host.alias("host"))
    fit = found.filter(F.col("host").contains(".") & F.col("host").rlike("^[a-z0-9.-]+$") & F.col("host").contains(word))
    return fit.select("host", urls.country_of_host(F.col("host")).alias("cc")).filter("cc <> ''").distinct()


def bindings(results: DataFrame) -> DataFrame:
    """``item, label, web, cc`` of query results in ``value``; rows without a site or with a number for a label go."""
    one = "struct<value:string>"
    parsed = F.from_json("value", f"results struct<bindings:array<struct<item:{one},itemLabel:{one},web:{one},ccode:{one}>>>")
    rows = results.select(F.explode(parsed["results"]["bindings"]).alias("b")).select(
        F.col("b.item.value").alias("item"),
        F.col("b.itemLabel.value").alias("label"),
        F.col("b.web.value").alias("web"),
        F.upper("b.ccode.value").alias("cc"),
    )
    return rows.filter("web is not null").filter(~rx.like(F.col("label"), r"^Q\d+$", fold=False))


def search_results(pages: DataFrame) -> DataFrame:
    """``query, rank, url, title`` of result pages ``query, html``, each URL once."""
    pattern = values.RESULT_LINK
    pairs = F.arrays_zip(rx.all_of(F.col("html"), pattern, 1).alias("h"), rx.all_of(F.col("html"), pattern, 2).alias("t"))
    rows = pages.select("query", F.posexplode(pairs).alias("i", "x"))
    url = F.split(rx.percent_decoded(rx.first(F.col("x.h"), values.RESULT_TARGET)), "#")[0]
    title = rx.squeeze(rx.sub(rx.sub(rx.sub(F.col("x.t"), r"<[^>]+>", " "), "&amp;", "&"), "&[a-z]+;", " "))
    found = rows.select("query", "i", url.alias("url"), title.alias("title")).filter(rx.like(F.col("url"), r"^https?:\/\/"))
    first = found.groupBy("query", "url").agg(F.min(F.struct("i", "title")).alias("x"))
    return first.select("query", F.col("x.i").alias("rank"), "url", "x.title")


def register_ids(pages: DataFrame) -> DataFrame:
    """``page, id`` of the venues on register pages."""
    return pages.select("page", F.explode(html.venue_ids(F.col("html"))).alias("id"))


def unread_ids(ids: DataFrame, seen: DataFrame) -> DataFrame:
    """Rows of ``ids(page, id)`` that are still to be read: a walk goes on at the smallest page among them."""
    return ids.join(seen.select("id").distinct(), "id", "left_anti").select("page", "id")


def last_check(lines: DataFrame, order: str, url: str) -> DataFrame:
    """``line``: the last line of a log that has the URL in it; null if none has."""
    return lines.filter(F.col("value").contains(url)).agg(F.max_by("value", order).alias("line"))


def area_id(relation: Column) -> Column:
    """The number under which a map database keeps a relation's area."""
    return relation.cast("bigint") + 3_600_000_000


def is_too_big(error: Column) -> Column:
    """Errors after which a country is asked for area by area."""
    return rx.like(error, values.TOO_BIG)


def open_areas(areas: DataFrame, done: DataFrame) -> DataFrame:
    """Areas ``cc, relation`` of a split country that no earlier scan has finished, with their ``area``."""
    return areas.withColumn("area", area_id(F.col("relation"))).join(done.select("cc", "area").distinct(), ["cc", "area"], "left_anti")


def charset_of(body: Column, content_type: Column) -> Column:
    """The character set that a header, else the first 4,096 bytes of a page, declare; UTF-8 if none does."""
    head = F.decode(F.substring(body, 1, 4096), "ISO-8859-1")
    name = r"""charset=["']?([\w\-]+)"""
    declared = F.coalesce(
        *(
            F.nullif(x, F.lit("")) for x in (
                rx.first(F.coalesce(content_type, F.lit("")), name),
                rx.first(head, "<meta[^>]+" + name),
                rx.first(head, r"""content=["'][^"']*""" + name),
            )
        )
    )
    low = F.lower(F.trim(F.coalesce(declared, F.lit("utf-8"))))
    return F.when(low.isin("iso-8859-1", "latin1", "us-ascii", "ascii"), "windows-1252").when(low == "utf8", "utf-8").otherwise(low)


@F.pandas_udf(StringType())
def _decoded(body: pd.Series, charset: pd.Series) -> pd.Series:
    """Text of bodies in other character sets; null stays null."""

    def one(b: bytes | None, c: str) -> str | None:
        try:
            return None if b is None else b.decode(c if _TEXT.match(c) else "utf-8", "replace").removeprefix("\ufeff")
        except LookupError:
            return b.decode("utf-8", "replace")

    return pd.Series([one(b, c) for b, c in zip(body, charset, strict=True)], dtype=object)


_TEXT = re.compile("(iso-?8859|windows-|cp|koi8|mac|gb|big5|euc|shift.?jis|sjis|utf-16)")
# the characters that windows-1252 has where ISO 8859-1 has controls
_WINDOWS = {b: bytes([b]).decode("cp1252", "ignore") for b in range(0x80, 0xA0)}


def decoded(body: Column, content_type: Column) -> Column:
    """A page's text by its declared character set; what cannot be decoded becomes U+FFFD, an unknown set counts as UTF-8.

    UTF-8 and Western pages stay in the JVM: only bodies in other sets are sent to Python.
    """
    charset = charset_of(body, content_type)
    from_, to = "".join(chr(b) for b, c in _WINDOWS.items() if c), "".join(_WINDOWS.values())
    utf8 = F.regexp_replace(F.make_valid_utf8(body.cast("string")), r"^\x{FEFF}", "")
    other = _decoded(F.when(~charset.isin("utf-8", "windows-1252"), body), charset)
    return F.when(charset == "utf-8", utf8).when(
        charset == "windows-1252",
        F.translate(F.decode(body, "ISO-8859-1"), from_, to),
    ).otherwise(other)


def new_seeds(found: DataFrame, lines: DataFrame) -> DataFrame:
    """``value``: lines to append for ``found(cc, url)`` whose URLs no line of the list has yet, not even as the beginning of another.

    URLs that begin with another come right after it in binary order, so each found one is compared with the next known one.
    """
    known = lines.select(F.regexp_extract("value", r"https?://\S*", 0).alias("url")).filter("url <> ''").distinct()
    first = found.filter("url is not null").groupBy("url").agg(F.min("cc").alias("cc"))
    both = first.withColumn("known", F.lit(False)).unionByName(known.select("url", F.lit(None).cast("string").alias("cc"), F.lit(True).alias("known")))
    after = ranges.next_value(both, [F.col("url"), F.col("known")], F.when(F.col("known"), F.col("url")), "after")
    fit = after.filter(~F.col("known") & ~F.coalesce(F.col("after").startswith(F.col("url")), F.lit(False)))
    return fit.select(F.concat("cc", F.lit("  "), "url").alias("value"))


def trimmed_log(lines: DataFrame, order: str, keep: int = 400) -> DataFrame:
    """A log that is over twice as long as ``keep``, cut to its last lines."""
    return lines.orderBy(F.desc(order)).limit(keep) if lines.limit(2 * keep + 1).count() > 2 * keep else lines


def write_lines(lines: DataFrame, path: str) -> None:
    """A text extract; replaced as a whole by Spark's committer."""
    lines.write.mode("overwrite").text(path)


def baked(page: Column, data: Column) -> Column:
    """A page with its data in a script element, every ``<`` of it escaped; an earlier one is replaced."""
    bare = F.regexp_replace(page, r'(?is)<script id="baked-data".*?</script>\s*', "")
    script = F.concat(F.lit('<script id="baked-data">'), F.replace(data, F.lit("<"), F.lit("\\u003c")), F.lit("</script>"))
    at = F.instr(bare, "</head>")
    return F.when(at > 0, F.concat(F.substr(bare, F.lit(1), at - 1), script, F.substr(bare, at))).otherwise(F.concat(script, bare))
