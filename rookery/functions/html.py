"""Text, titles and links of pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules, rx, urls, values

def _plain(text: Column) -> Column:
    """Tags and entities as spaces, ``&amp;`` as itself, squeezed; patterns are tried only where their first character is."""

    def entities(t: Column) -> Column:
        return F.when(t.contains("&"), rx.sub(rx.sub(rx.sub(t, r"&nbsp;", " "), r"&amp;", "&"), r"&[a-z]+;", " ")).otherwise(t)

    bare = rx.let(text, lambda t: F.when(t.contains("<"), rx.sub(t, r"<[^>]+>", " ")).otherwise(t))
    return rx.squeeze(rx.let(bare, entities))


def anchors(html: Column) -> Column:
    """``array<struct<href, inner>>`` of all links in order, page-internal and non-web ones left out; the page is read once for each of the two."""
    pair = lambda href, inner: F.struct(href.alias("href"), inner.alias("inner"))
    both = F.zip_with(rx.all_of(html, values.ANCHOR, 1), rx.all_of(html, values.ANCHOR, 2), pair)
    return F.filter(both, lambda x: ~rx.like(x["href"], values.SKIPPED_SCHEME))


def links(html: Column, base: Column) -> Column:
    """``array<struct<url, text>>`` of a page's links with absolute URLs; the page's own URL is taken apart once."""

    def found(b: Column) -> Column:
        return F.transform(anchors(html), lambda x: F.struct(urls.resolved(x["href"], b).alias("url"), _plain(x["inner"]).alias("text")))

    return F.filter(rx.let(urls.base_of(base), found), lambda x: x["url"].isNotNull())


def decode_entities(text: Column) -> Column:
    """``&amp;``, ``&nbsp;`` and decimal entities decoded, other named ones as spaces, squeezed."""

    def joined(parts: Column) -> Column:
        head = F.get(parts, F.lit(0))
        tail = F.transform(
            F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))),
            lambda p: F.concat(_char(F.regexp_extract(p, r"^\d+", 0)), F.regexp_replace(p, r"^\d+;", "")),
        )
        return F.concat(head, F.array_join(tail, ""))

    def decoded(t: Column) -> Column:
        base = rx.sub(rx.sub(t, "&amp;", "&"), "&nbsp;", " ")
        return rx.sub(rx.let(F.split(base, r"&#(?=\d+;)"), joined), r"&[a-z]+;", " ")

    return rx.squeeze(rx.let(text, lambda t: F.when(t.contains("&"), decoded(t)).otherwise(t)))


def _char(number: Column) -> Column:
    """The character of a code unit below 65,536, by its two UTF-16 bytes."""
    return F.decode(F.unhex(F.lpad(F.hex((number.cast("long") % 65536)), 4, "0")), "UTF-16BE")


def text_of(html: Column) -> Column:
    """Visible text: scripts, styles and tags as spaces, runs of white space as one (not trimmed)."""
    bare = rx.sub(rx.sub(rx.sub(html, r"<script[\s\S]*?<\/script>", " "), r"<style[\s\S]*?<\/style>", " "), r"<[^>]+>", " ")
    return rx.sub(bare, r"\s+", " ")


def card_text(html: Column) -> Column:
    """As ``text_of``, with the four entities that register cards use."""
    out = text_of(html)
    for a, b in (("&#x27;", "'"), (r"&#x2B;", "+"), ("&amp;", "&"), ("&nbsp;", " ")):
        out = rx.sub(out, a, b)
    return rx.sub(out, r"\s+", " ")


def title_of(html: Column) -> Column:
    """A page's title, else its first heading; empty if it has neither, null for no page."""
    head = rx.sub(rx.first(html, values.H1), r"<[^>]+>", " ")
    return decode_entities(rx.let(rx.first(html, values.TITLE), lambda title: F.when(F.trim(title) != "", title).otherwise(head)))


def name_candidates(html: Column) -> Column:
    """Every place where a page names itself, best first."""
    meta = rx.all_of(html, values.NAMING_META)
    named = F.transform(meta, lambda m: rx.first(m, values.META_CONTENT))
    h1 = rx.sub(rx.first(html, values.H1), r"<[^>]+>", " ")
    return F.transform(F.filter(F.concat(F.array(rx.first(html, values.TITLE)), named, F.array(h1)), lambda x: x != ""), decode_entities)


def name_from_title(title: Column) -> Column:
    """The segment of a title that names a club, else the first; empty if there is none."""

    def clean(t: Column) -> Column:
        t = F.trim(rx.sub(F.trim(t), values.TITLE_PREFIX, ""))
        t = F.trim(rx.sub(t, values.TITLE_SUFFIX, ""))
        return F.substring(rx.squeeze(t), 1, 90)

    parts = F.filter(
        F.transform(
            F.split(F.coalesce(title, F.lit("")), rf"[|\x{{2013}}\x{{2014}}\x{{00B7}}\x{{2022}},]|[{rx.SPACE}]+-[{rx.SPACE}]+"),
            clean,
        ),
        lambda x: x != "",
    )
    first = lambda x: F.get(x, F.lit(0))
    return rx.let(parts, lambda p: F.coalesce(first(F.filter(p, lambda x: rx.like(x, values.CLUB_WORD))), first(p), F.lit("")))


def page_name(html: Column, found: Column | None = None) -> Column:
    """The name that a page gives itself: the first candidate with a club word, else the title's; ``found``: its candidates, if at hand."""
    named = F.filter(F.transform(name_candidates(html) if found is None else found, name_from_title), lambda x: x != "")
    return F.coalesce(F.get(F.filter(named, lambda x: rx.like(x, values.CLUB_WORD)), F.lit(0)), name_from_title(title_of(html)))


def venue_ids(html: Column) -> Column:
    """Ids of the venues that a register page links to, each once in their order."""
    return F.array_distinct(rx.all_of(html, values.VENUE_ID, 1, fold=False))


def venue_name(html: Column) -> Column:
    """A venue page's title without the register's name; empty if there is none."""
    return F.trim(rx.sub(card_text(rx.first(html, values.TITLE)), values.VENUE_TITLE_SUFFIX, ""))


def card_field(html: Column, label: str) -> Column:
    """A labelled field of a contact card: its link, else its text; empty if the label is missing."""

    def of(block: Column) -> Column:
        return rx.let(rx.first(block, r'href="([^"]+)"', fold=False), lambda href: F.when(href != "", href).otherwise(F.trim(card_text(block))))

    return rx.let(rx.first(html, values.CARD_BLOCK.format(label=label)), of)


def refresh_target(html: Column, base: Column) -> Column:
    """Where a meta refresh leads; empty if nowhere or to a challenge."""
    to = F.trim(rx.first(html, values.META_REFRESH))
    return F.when((to == "") | rx.like(to, r"captcha|challenge|\.well-known"), "").otherwise(F.coalesce(urls.resolve(to, base), F.lit("")))


def next_page(html: Column, base: Column, seen: Column) -> Column:
    """The next page of a listing that is not among ``seen``; null at the end."""
    rel = rx.first(html, values.REL_NEXT)
    by_rel = F.when(rel != "", urls.resolve(rel, base))
    by_text = F.get(
        F.filter(links(html, base), lambda x: rx.like(x["text"], values.NEXT_TEXT) & ~F.array_contains(seen, x["url"])),
        F.lit(0),
    )["url"]
    return F.coalesce(F.when(~F.array_contains(seen, by_rel), by_rel), by_text)


def one_a_text(fit: Column, base: Column) -> Column:
    """``array<struct<name, url, internal>>`` of a page's links ``fit``, the first of each text; the links are found once."""

    def first(fit: Column, names: Column, origin: Column) -> Column:
        own = F.filter(fit, lambda x, i: F.array_position(names, x["text"]) == i + 1)
        return F.transform(own, lambda x: F.struct(x["text"].alias("name"), x["url"].alias("url"), x["url"].startswith(origin).alias("internal")))

    def of(fit: Column) -> Column:
        return rx.let(F.transform(fit, lambda x: x["text"]), lambda names: rx.let(urls.origin_of(base), lambda origin: first(fit, names, origin)))

    return rx.let(fit, of)


def candidates(html: Column, base: Column) -> Column:
    """Links of a listing whose text may name a club: ``name, url, internal``, one for each text (the first)."""
    fit = F.filter(
        links(html, base),
        lambda x: F.char_length(x["text"]).between(4, 90) & ~rx.like(x["text"], values.NAVIGATION) & rx.like(x["text"], values.CLUB_WORD) & ~rx.like(x["text"], values.PUBLIC),
    )
    return one_a_text(fit, base)


def _outside(html: Column, base: Column) -> Column:
    """Absolute URLs of a page's links that lead out of its site; what stands in the links is not looked at."""
    hrefs = F.filter(rx.all_of(html, values.ANCHOR, 1), lambda x: ~rx.like(x, values.SKIPPED_SCHEME))

    def found(b: Column) -> Column:
        return F.filter(F.transform(hrefs, lambda x: urls.resolved(x, b)), lambda x: x.isNotNull() & ~x.startswith(b["origin"]))

    return rx.let(urls.base_of(base), found)


def chrome_hosts(html: Column, base: Column) -> Column:
    """Hosts outside the site that a listing page links to."""
    return F.filter(F.array_distinct(F.transform(_outside(html, base), urls.host_of)), lambda h: h != "")


def outbound_site(html: Column, base: Column, chrome: Column, name: Column) -> Column:
    """The first outside link that looks like the named club's own site; empty if none does."""

    def fit(known: Column) -> Column:
        def own(x: Column) -> Column:
            host = lambda h: ~F.array_contains(chrome, h) & ((known["name"] == "") | rules.plausible_host(known, h))
            return rx.like(x, r"^https?:\/\/") & ~rx.like(x, values.SKIPPED_LINK) & rx.let(urls.host_of(x), host)

        return F.filter(_outside(html, base), own)

    return F.coalesce(F.split(F.get(rx.let(rules.name_parts(name), fit), F.lit(0)), "#")[0], F.lit(""))


def contact_pages(html: Column, base: Column, most: int = 8) -> Column:
    """Where a site may say how to reach it: its own links that look so, then guessed paths, each once, ``most`` at most."""
    origin = urls.origin_of(base)
    fit = F.filter(
        links(html, origin),
        lambda x: x["url"].startswith(origin) & (rx.like(x["url"], values.CONTACT_LINK) | rx.like(x["text"], values.CONTACT_LINK)),
    )
    guessed = F.array(*(F.concat(origin, F.lit(p)) for p in values.CONTACT_PATHS))
    return F.slice(F.array_distinct(F.concat(F.transform(fit, lambda x: x["url"]), guessed)), 1, most)
