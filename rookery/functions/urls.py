"""URLs: hosts, origins, resolution, keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rx, values

_PARTS = r"^([A-Za-z][A-Za-z0-9+.-]*:)//(?:[^/?#@]*@)?([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$"


def _part(url: Column, i: int) -> Column:
    return F.coalesce(F.regexp_extract(F.trim(url), _PARTS, i), F.lit(""))


def host_of(url: Column) -> Column:
    """Lower-case host without port and ``www.``; empty if there is none."""
    return F.regexp_replace(F.regexp_replace(F.lower(_part(url, 2)), r":\d*$", ""), r"^www\.", "")


def origin_of(url: Column) -> Column:
    """Scheme and host in lower case, default ports left out; empty for what is no URL."""
    host = F.regexp_replace(F.lower(_part(url, 2)), r":(80|443)?$", "")
    return F.when(host != "", F.concat(F.lower(_part(url, 1)), F.lit("//"), host)).otherwise("")


def path_of(url: Column) -> Column:
    """The path of a web URL, ``/`` where it is empty and for what is no URL."""
    return F.when(_part(url, 3) == "", F.lit("/")).otherwise(_part(url, 3))


def _without_dots(path: Column) -> Column:
    """``.`` and ``..`` segments of a path resolved."""
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)
    kept = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(
            s == "..",
            F.when(F.size(acc) > 1, F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(1)))).otherwise(acc),
        ).when(s == ".", acc).otherwise(F.concat(acc, F.array(s))),
    )
    joined = F.array_join(kept, "/")
    return F.when(last.isin(".", "..") & ~joined.endswith("/"), F.concat(joined, F.lit("/"))).otherwise(joined)


_SEP = "\x01"


def _split(url: Column) -> Column:
    """Scheme, host, path, query and fragment of a web URL by one pattern; an array of one for what is none."""
    return F.split(F.regexp_replace(F.replace(F.trim(url), F.lit(_SEP), F.lit("")), _PARTS, _SEP.join(f"${i}" for i in range(1, 6))), _SEP, -1)


def _origin(parts: Column) -> Column:
    of = lambda host: F.when(host != "", F.concat(F.lower(parts[0]), F.lit("//"), host)).otherwise("")
    return F.when(F.size(parts) == 5, rx.let(F.regexp_replace(F.lower(parts[1]), r":(80|443)?$", ""), of)).otherwise("")


def _tidy(path: Column) -> Column:
    """A path without ``.`` and ``..`` segments; most have none, and most of these no dot at a segment's beginning."""

    def of(path: Column) -> Column:
        dotted = (path.startswith(".") | path.contains("/.")) & path.rlike(r"(^|/)\.\.?(/|$)")
        return F.when(dotted, _without_dots(path)).otherwise(path)

    return rx.let(path, of)


def _bare(link: Column) -> Column:
    """A link up to its query or fragment."""
    return F.substring_index(F.substring_index(link, "?", 1), "#", 1)


def _escaped(text: Column, marks: str) -> Column:
    """Percent escapes for the ``marks``, for spaces and controls, and for all beyond ASCII, by their UTF-8 bytes."""
    each = F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))
    odd = lambda c: c.isin(*marks) | ~c.between("!", "~")
    escape = lambda c: F.regexp_replace(F.hex(F.encode(c, "UTF-8")), "(..)", "%$1")
    return F.array_join(F.transform(each, lambda c: F.when(odd(c), escape(c)).otherwise(c)), "")


def spelled(link: Column) -> Column:
    """A link as browsers spell it: no tabs and line ends, slashes for backslashes, escapes for what a path, query or fragment can't have.

    Only links with such characters are taken apart.  Hosts stay as they are (no IDNA), and so do links of schemes without ``//``.
    """

    def full(link: Column) -> Column:
        front = F.translate(F.regexp_extract(link, r"^[^?#]*", 0), "\\", "/")
        host = F.regexp_extract(front, r"^([A-Za-z][A-Za-z0-9+.-]*:)?//[^/]*", 0)
        path = _escaped(F.substr(front, F.char_length(host) + 1), ' "<>`{}')
        query = _escaped(F.regexp_extract(link, r"^[^?#]*(\?[^#]*)", 1), " \"<>'")
        return F.concat(host, path, query, _escaped(F.regexp_extract(link, r"^[^#]*(#(?s:.*))", 1), ' "<>`'))

    def of(link: Column) -> Column:
        opaque = link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:(?![/\\])")
        odd = link.rlike(r"""[[^!-~]"'<>`{}\\]""")
        bare = F.regexp_replace(link, r"[\t\n\r]+|^[\x00-\x20]+|[\x00-\x20]+\z", "")
        return F.when(~odd | opaque, link).otherwise(rx.let(bare, full))

    return rx.let(F.trim(link), of)


def base_of(base: Column) -> Column:
    """What ``resolved`` needs of a page's URL, found once for all of its links."""

    def of(parts: Column) -> Column:
        path = F.when(F.size(parts) < 5, "/").when(parts[2] == "", "/").otherwise(parts[2])
        return F.struct(
            _origin(parts).alias("origin"),
            F.regexp_replace(path, "[^/]*$", "").alias("folder"),
            _bare(base).alias("bare"),
            F.regexp_extract(base, r"\?[^#]*", 0).alias("query"),
        )

    return rx.let(_split(base), of)


def resolved(link: Column, base: Column) -> Column:
    """An absolute URL for a link on the page of ``base_of``; null if either is no web URL."""

    def whole(parts: Column) -> Column:
        path = F.when(parts[2] == "", "/").otherwise(parts[2])
        return F.when(F.size(parts) == 5, F.concat(_origin(parts), _tidy(path), parts[3], parts[4])).otherwise("/")

    def of(link: Column) -> Column:
        return rx.let(_bare(link), lambda bare: split(link, bare))

    def split(link: Column, bare: Column) -> Column:
        tail = F.substr(link, F.char_length(bare) + 1)
        full = F.when(link.startswith("//"), F.concat(F.regexp_extract(base["origin"], "^[a-z]+:", 0), link)).otherwise(link)
        path = F.when(bare.startswith("/"), bare).otherwise(F.concat(base["folder"], bare))
        same = F.concat(base["bare"], F.when(link.startswith("#"), base["query"]).otherwise(""), tail)
        named = link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:")
        out = (
            F.when(link.startswith("//") | link.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), rx.let(_split(full), whole))
            .when(named, link)
            .when(bare == "", same)
            .otherwise(F.concat(base["origin"], _tidy(path), tail))
        )
        return F.when((base["origin"] != "") | named, out)

    return rx.let(spelled(link), of)


def resolve(link: Column, base: Column) -> Column:
    """An absolute URL for a link on a page; null if either is no web URL."""
    return rx.let(base_of(base), lambda b: resolved(link, b))


def country_of_host(host: Column) -> Column:
    """Country of a host's top-level domain; empty for generic and vanity domains."""
    known = {cc.lower(): cc for cc, *_ in values.COUNTRIES if cc.lower() not in values.VANITY_TLDS} | {"uk": "GB"}
    table = F.create_map(*(F.lit(x) for pair in known.items() for x in pair))
    bare = F.split(F.regexp_replace(F.lower(F.trim(host)), r"^[a-z]+://(www\.)?|^www\.", ""), "[:/?#]")[0]
    return F.when(bare.contains("."), F.coalesce(F.element_at(table, F.element_at(F.split(bare, r"\."), -1)), F.lit(""))).otherwise("")


def normalised_site(text: Column) -> Column:
    """A crawlable web site from a free-text field: origin and path; empty for social pages and what is no URL."""
    word = F.split(F.trim(text), rf"[{rx.SPACE},;]+")[0]
    url = F.when(rx.like(word, r"^www\."), F.concat(F.lit("http://"), word)).otherwise(word)
    ok = rx.like(url, r"^https?:\/\/") & host_of(url).contains(".") & ~rx.like(host_of(url), values.SOCIAL_HOST)
    return F.when(ok, F.concat(origin_of(url), F.when(path_of(url) == "/", "").otherwise(path_of(url)))).otherwise("")


def key_for(website: Column, email: Column, cc: Column, name: Column, by_email: bool) -> Column:
    """Store key: by host, else (map imports only, ``by_email``) by address, else by country and name."""
    host = host_of(website)
    named = F.concat(F.lit("n:"), F.coalesce(cc, F.lit("")), F.lit(":"), F.coalesce(rx.slug(name), F.lit("")))
    mailed = F.when(F.lit(by_email) & (F.coalesce(email, F.lit("")) != ""), F.concat(F.lit("e:"), email))
    return F.coalesce(F.when(host != "", F.concat(F.lit("w:"), host)), mailed, named)


def country_of_path(url: Column) -> Column:
    """Country that the first naming part of a path stands for; empty if none does."""
    known = {name.replace(" ", "_"): cc for cc, name, _ in values.COUNTRIES} | values.COUNTRY_ALIASES
    table = F.create_map(*(F.lit(x) for pair in known.items() for x in pair))
    hits = F.filter(
        F.transform(F.split(url, "/"), lambda p: F.element_at(table, F.coalesce(rx.percent_decoded(p), p))),
        lambda x: x.isNotNull(),
    )
    return F.coalesce(F.get(hits, F.lit(0)), F.lit(""))
