"""Verdicts on listing pages and on the venues of a register."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import emails, html, rules, rx, urls, values


_SPORT = "|".join((values.TENNIS, values.PADEL, values.PADEL_TENNIS, values.SQUASH))


def _club_like(name: Column, website: Column) -> Column:
    """Whether a text names a private club with a racket sport; what most texts fail is asked first."""
    none = F.lit("")
    likely = F.char_length(name).between(4, 90) & rx.like(name, _SPORT) & rx.like(F.concat(name, F.lit("  ")), values.CLUB_WORD)
    return likely & rules.private_gate(name, website, none)["ok"]


def club_links(links: Column, base: Column) -> Column:
    """Of a page's ``links`` those whose text alone names a private club with a racket sport: ``name, url, internal``, one for each text (the first)."""
    return html.one_a_text(F.filter(links, lambda x: _club_like(x["text"], F.lit(""))), base)


def link_counts(page: Column, base: Column) -> Column:
    """``struct<links, internal, external>``: all links of a page, and those that name clubs inside and outside its site; links are found once."""

    def counted(links: Column) -> Column:
        return rx.let(club_links(links, base), lambda clubs: of(links, clubs))

    def of(links: Column, clubs: Column) -> Column:
        inside = F.size(F.filter(clubs, lambda x: x["internal"]))
        return F.struct(F.size(links).alias("links"), inside.alias("internal"), (F.size(clubs) - inside).alias("external"))

    return rx.let(html.links(page, base), counted)


def category_pages(pages: DataFrame, least: int = 5) -> DataFrame:
    """``url, clubs, subcategories, emails, verdict`` of directory pages ``url, html``.

    ``clubs`` counts links out of the site that name private clubs; ``subcategories`` are the distinct relevant branches inside it.
    A page is RETRY if it could not be read, EXCLUDED by its category, SEED with ``least`` clubs, else THIN.
    """
    rows = pages.select(
        "url",
        "html",
        html.links(F.coalesce("html", F.lit("")), F.col("url")).alias("links"),
        urls.origin_of(F.col("url")).alias("origin"),
    )
    inside = F.filter(
        "links",
        lambda x: x["url"].startswith(F.col("origin")) & rx.like(
            x["url"],
            r"\/(en|es|pt)\/(Sports|Regional|Deportes|Esportes)\/",
            fold=False,
        ) & rx.like(x["url"], values.RELEVANT),
    )
    clubs = F.size(F.filter("links", lambda x: ~x["url"].startswith(F.col("origin")) & _club_like(x["text"], x["url"])))
    found = F.size(emails.extract_emails(F.coalesce("html", F.lit("")), urls.host_of(F.col("url"))))
    verdict = F.when(F.coalesce("html", F.lit("")) == "", "RETRY").when(
        rx.like(F.col("url"), values.EXCLUDED_CATEGORY),
        "EXCLUDED",
    ).when(F.col("clubs") >= least, "SEED").otherwise("THIN")
    out = rows.withColumns({"clubs": clubs, "emails": found})
    return out.select(
        "url",
        "clubs",
        F.array_distinct(F.transform(inside, lambda x: F.regexp_replace(F.split(x["url"], "#")[0], r"/\z", ""))).alias("subcategories"),
        "emails",
        verdict.alias("verdict"),
    )


def checked(pages: DataFrame) -> DataFrame:
    """``url, links, internal, external, emails, verdict`` of pages ``url, html, allowed`` proposed as seeds.

    Rejected in order: not allowed by robots rules, unreadable, without a club-like link (``/js`` if scripts seem to draw it).
    """
    page = F.coalesce("html", F.lit(""))
    rows = pages.select(
        "url",
        "html",
        "allowed",
        link_counts(page, F.col("url")).alias("c"),
        F.size(emails.extract_emails(page, urls.host_of(F.col("url")))).alias("emails"),
    ).select("*", "c.*")
    verdict = (
        F.when(~F.coalesce("allowed", F.lit(True)), "REJECT robots")
        .when(page == "", "REJECT unreadable")
        .when((F.col("internal") + F.col("external") == 0) & rules.drawn_by_script(page), "REJECT empty/js")
        .when(F.col("internal") + F.col("external") == 0, "REJECT empty")
        .when((F.col("emails") >= 3) | (F.col("external") >= 3), "GOOD")
        .otherwise("MAYBE")
    )
    return rows.select("url", "links", "internal", "external", "emails", verdict.alias("verdict"))


def from_register(venues: DataFrame, vetted: DataFrame, chars: int | None = 20_000) -> DataFrame:
    """``id, name, sports, website, email, reason`` of register pages ``id, html``; '' is no reason against the venue.

    ``vetted(url, name, sports, website, reason)`` is what ``records.vet`` says of the venues' own sites, one row for a site;
    it is asked only where the register's own words fail the private gate.  Sports are sought in the first ``chars``
    characters of a page's text, as the results to be matched have it; None takes the whole text.
    """
    page = F.coalesce("html", F.lit(""))
    email = F.lower(F.trim(rx.sub(html.card_field(page, "Email"), "^mailto:", "")))
    own = lambda s: rx.like(s, r"^https?:\/\/") & ~rx.like(urls.host_of(s), values.REGISTER_SITES)
    site = rx.let(F.trim(html.card_field(page, "Website")), lambda s: F.when(own(s), s).otherwise(""))
    rows = venues.select(
        "id",
        (page != "").alias("read"),
        html.venue_name(page).alias("name"),
        (html.card_text(page) if chars is None else F.substring(html.card_text(page), 1, chars)).alias("body"),
        email.alias("card"),
        site.alias("site"),
    )
    host = F.coalesce(F.get(F.split("card", "@"), F.lit(1)), F.lit(""))
    good = F.col("card").contains("@") & ~rx.like(F.col("card"), values.REGISTER_JUNK) & ~rx.like(host, values.REGISTER_MAIL) & ~rx.like(host, values.PUBLIC_DOMAIN)
    rows = rows.withColumns(
        {
            "sports": rules.detect_sports(F.concat_ws(" ", "name", "body")),
            "email": F.when(good, F.col("card")).otherwise(""),
            "gate": rules.private_gate(F.col("name"), F.col("site"), F.lit(""))["reason"],
        }
    )
    second = vetted.select(F.col("url").alias("v_url"), F.struct("name", "sports", "website", "reason").alias("v"))
    rows = rows.join(second, (F.col("gate") != "") & (F.col("site") != "") & (F.col("site") == F.col("v_url")), "left")
    saved = (F.col("gate") != "") & (F.col("v.reason") == "")
    taken = {
        c: F.when(saved, F.col(f"v.{c}")).otherwise(F.col(o)) for c, o in (("name", "name"), ("sports", "sports"), ("website", "site"))
    }
    told = F.concat(F.col("gate"), F.lit("; its site: "), F.coalesce("v.reason", F.lit("site unreachable")))
    reason = (
        F.when(~F.col("read"), "unreachable")
        .when(F.col("name") == "", "no name on the page")
        .when(F.size("sports") == 0, "no racket sport on the page")
        .when((F.col("gate") != "") & (F.col("site") == ""), F.col("gate"))
        .when((F.col("gate") != "") & ~F.coalesce(saved, F.lit(False)), told)
        .when((F.col("email") == "") & (taken["website"] == ""), "no email and no website")
        .otherwise("")
    )
    return rows.select("id", *(taken[c].alias(c) for c in ("name", "sports", "website")), "email", reason.alias("reason"))
