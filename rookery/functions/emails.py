"""Addresses on pages: found in four ways, cleaned, filtered and ranked."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rx, values


def cf_decode(code: Column) -> Column:
    """A hex string whose first byte is the key of an exclusive or with the others; empty if it is too short."""
    number = lambda i: F.conv(F.substr(code, i, F.lit(2)), 16, 10).cast("int")
    at = F.sequence(F.lit(3), F.char_length(code) - 1, F.lit(2))
    text = F.array_join(F.transform(at, lambda i: F.chr(number(i).bitwiseXOR(number(F.lit(1))))), "")
    return F.when(F.char_length(code) >= 4, text).otherwise("")


def _plain(html: Column) -> Column:
    """Spelt-out addresses written as such."""
    out = html
    for pattern, to in values.SPELT_OUT:
        out = rx.sub(out, pattern, to)
    return out


# what a page needs to have anything spelt out: the patterns without the white space around them
_SPELT = "|".join(p.removeprefix(r"\s*").removesuffix(r"\s*") for p, _ in values.SPELT_OUT)
# no character of an address before its @ can be the @, so nothing is given back there
_SCAN = values.EMAIL.replace("+@", "++@", 1)


def raw_emails(html: Column) -> Column:
    """Distinct lower-case addresses before any of them is judged; broken escapes drop their candidate.

    Pages without an ``@`` and without anything spelt out, which most are, are not searched for addresses.
    """
    none = F.array().cast("array<string>")
    hidden = F.filter(F.transform(rx.all_of(html, values.CF_EMAIL, 1), cf_decode), lambda x: x.contains("@"))
    linked = F.transform(rx.all_of(html, values.MAILTO, 1), rx.percent_decoded)
    written = F.when(html.contains("@"), rx.all_of(html, _SCAN)).otherwise(none)
    spelt = F.when(rx.like(html, _SPELT), rx.all_of(_plain(html), _SCAN)).otherwise(none)
    return F.array_distinct(F.transform(F.array_compact(F.concat(hidden, linked, written, spelt)), F.lower))


def is_usable(email: Column) -> Column:
    """Well formed, not too long, no placeholder and no address that nobody reads."""
    return rx.like(email, rf"^{values.EMAIL}$") & (F.char_length(email) < 80) & ~rx.like(email, values.JUNK_EMAIL) & ~rx.like(email, values.NO_REPLY)


def ranked(emails: Column, host: Column) -> Column:
    """The site's own domain first, then by role, then in the order found."""
    bare = F.regexp_replace(F.lower(F.coalesce(host, F.lit(""))), r"^www\.", "")
    roles = F.array(*(F.lit(r) for r in values.ROLES))

    def key(e: Column, i: Column) -> Column:
        foreign = F.when((bare != "") & e.endswith(F.concat(F.lit("@"), bare)), 0).otherwise(1)
        place = F.array_position(roles, F.split(e, "@")[0])
        return F.struct(foreign.alias("f"), F.when(place == 0, 99).otherwise(place - 1).alias("r"), i.alias("i"), e.alias("e"))

    return F.transform(F.array_sort(F.transform(emails, key)), lambda x: x["e"])


def extract_emails(html: Column, host: Column) -> Column:
    """All usable addresses of a page, best first."""
    clean = F.transform(raw_emails(html), lambda e: F.regexp_replace(rx.sub(e, r"^[^a-z0-9]+|[^a-z0-9._%+\-@]+$", ""), r"\.\z", ""))
    return ranked(F.array_distinct(F.filter(clean, is_usable)), host)


def contact_name(html: Column) -> Column:
    """A person named beside a label such as ``Contact:``; empty if there is none to be sure of."""
    text = rx.sub(rx.sub(rx.sub(html, r"<[^>]+>", " "), "&nbsp;", " "), r"\s+", " ")
    name = F.trim(rx.first(text, values.CONTACT_NAME))
    return F.when(F.char_length(name).between(4, 60) & ~rx.like(name, values.NOT_A_CONTACT), name).otherwise("")


def site_from_email(email: Column) -> Column:
    """The web site that an address's domain stands for; empty for free mail and public bodies."""
    domain = F.lower(F.coalesce(F.get(F.split(email, "@"), F.lit(1)), F.lit("")))
    ok = ~domain.isin(values.FREEMAIL) & rx.like(domain, r"^[a-z0-9.\-]+\.[a-z]{2,}$") & ~rx.like(domain, values.PUBLIC_DOMAIN)
    return F.when(ok, F.concat(F.lit("https://"), domain)).otherwise("")


def listing_emails(emails: Column, on_listing: Column, listing_host: Column) -> Column:
    """Addresses that are the entity's own: not on the listing page and not on the listing's domain."""
    return F.filter(F.array_except(emails, on_listing), lambda e: ~e.endswith(F.concat(F.lit("@"), listing_host)))


def on_own_domain(emails: Column, site_host: Column) -> Column:
    """The first address on a site's domain; null if none is."""
    return F.get(F.filter(emails, lambda e: (site_host != "") & e.endswith(F.concat(F.lit("@"), site_host))), F.lit(0))
