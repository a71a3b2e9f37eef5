"""Which sports, which kind of body, which site: rules with their reasons."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rx, urls, values


def detect_sports(text: Column) -> Column:
    """Tennis, Padel, Squash as a text has them; tennis that is only part of the first padel tennis does not count."""

    def found(t: Column, both: Column) -> Column:
        rest = rx.sub(t, rf"^([\s\S]*?)({values.PADEL_TENNIS})", "$1 ")
        return F.array(
            F.when(rx.like(t, values.TENNIS) & ~(both & ~rx.like(rest, values.TENNIS)), F.lit("Tennis")),
            F.when(both | rx.like(t, values.PADEL), F.lit("Padel")),
            F.when(rx.like(t, values.SQUASH), F.lit("Squash")),
        )

    whole = F.coalesce(text, F.lit(""))
    return F.array_compact(rx.let(whole, lambda t: rx.let(rx.like(t, values.PADEL_TENNIS), lambda both: found(t, both))))


def sports_from_tag(tag: Column) -> Column:
    """Sports of a semicolon list.  As in the data this feeds, tennis beside padel does not count."""
    t = F.lower(F.coalesce(tag, F.lit("")))
    rest = F.regexp_replace(t, r"^(.*?)(^|;)tennis(;|$)", "$1")
    alone = rx.like(t, r"(^|;|\s)tennis(;|$|\s)") & ~rx.like(rest, "padel|paddle")
    word = rx.like(t, r"\btennis\b") & ~rx.like(t, "padel|paddle")
    return F.array_compact(
        F.array(
            F.when(alone | word, F.lit("Tennis")),
            F.when(rx.like(t, "padel|paddle"), F.lit("Padel")),
            F.when(rx.like(t, "squash"), F.lit("Squash")),
        )
    )


def private_gate(name: Column, website: Column, email: Column, operator: Column | None = None, description: Column | None = None) -> Column:
    """``struct<ok, reason>``: the first reason against a private club, in fixed order; empty if it is one."""
    none = F.lit("")
    text = F.concat_ws(
        " ",
        F.coalesce(name, none),
        F.coalesce(operator, none) if operator is not None else none,
        F.coalesce(description, none) if description is not None else none,
    )
    domain = F.coalesce(F.get(F.split(email, "@"), F.lit(1)), none)
    reason = (
        F.when(F.trim(F.coalesce(name, none)) == "", "no name")
        .when(rx.like(text, values.PUBLIC), F.concat(F.lit("public/institutional: "), rx.first(text, values.PUBLIC, 0)))
        .when(rx.like(website, values.PUBLIC_DOMAIN), "public domain")
        .when(rx.like(domain, values.PUBLIC_DOMAIN), "public email domain")
        .when(~rx.like(text, values.CLUB_WORD), "no club signal in name")
        .otherwise("")
    )
    return F.struct((reason == "").alias("ok"), reason.alias("reason"))


def is_challenge(html: Column) -> Column:
    """A page that asks for proof of a person, instead of the site."""
    short = (F.char_length(html) < 900) & rx.like(html, r"""http-equiv=["']refresh""")
    return F.coalesce(short | rx.like(html, values.CHALLENGE), F.lit(False))


def name_tokens(name: Column) -> Column:
    """Distinctive words of a name."""
    return F.filter(
        F.split(rx.strip_accents(F.coalesce(name, F.lit(""))), "[^a-z0-9]+"),
        lambda t: (F.char_length(t) >= 4) & ~t.isin(values.STOPWORDS),
    )


def name_parts(name: Column) -> Column:
    """``struct<name, tokens, initials>`` of a name, which ``plausible_host`` asks for: found once for any number of hosts."""
    words = F.filter(F.split(rx.strip_accents(F.coalesce(name, F.lit(""))), "[^a-z0-9]+"), lambda w: w != "")
    initials = F.array_join(F.transform(words, lambda w: F.substring(w, 1, 1)), "")
    return F.struct(F.coalesce(name, F.lit("")).alias("name"), name_tokens(name).alias("tokens"), initials.alias("initials"))


def plausible_host(parts: Column, host: Column) -> Column:
    """Whether a host has a distinctive word of a name of ``name_parts``, or begins with its initials."""
    tokens, initials = parts["tokens"], parts["initials"]

    def of(flat: Column) -> Column:
        return (flat != "") & (F.size(tokens) > 0) & (
            F.exists(tokens, lambda t: flat.contains(t)) | ((F.char_length(initials) >= 3) & flat.startswith(initials))
        )

    return rx.let(F.regexp_replace(host, "[^a-z0-9]", ""), of)


def plausible_site(name: Column, url: Column) -> Column:
    """Whether a host has a distinctive word of a name, or begins with its initials."""
    return rx.let(name_parts(name), lambda parts: plausible_host(parts, urls.host_of(url)))


def name_overlap(name: Column, text: Column) -> Column:
    """Share of a name's distinctive words that a text has; 0 if it has no such words."""
    flat = F.regexp_replace(rx.strip_accents(F.coalesce(text, F.lit(""))), "[^a-z0-9]", "")
    tokens = name_tokens(name)
    return F.when(F.size(tokens) == 0, F.lit(0.0)).otherwise(F.size(F.filter(tokens, lambda t: flat.contains(t))) / F.size(tokens))


def phrases(text: Column, words: int) -> Column:
    """All stretches of up to ``words`` consecutive words of a text in lower case, with what stands between the words; of ASCII word characters."""

    def of(parts: Column) -> Column:
        stretch = lambda n: F.transform(
            F.sequence(F.lit(1), F.greatest(F.size(parts) - (n - 1), F.lit(1))), lambda i: F.array_join(F.slice(parts, i, F.lit(n)), "")
        )
        return F.concat(*(stretch(2 * k - 1) for k in range(1, words + 1)))

    parts = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("[A-Za-z0-9_]+|[^A-Za-z0-9_]+"), F.lit(0))
    return F.transform(rx.let(parts, lambda x: F.when(F.size(x) > 0, of(x)).otherwise(x)), F.lower)


def names_other_country(name: Column, cc: Column) -> Column:
    """The first country of the table other than ``cc`` that a name has as whole words; null if none.

    The stretches of words of a name are met with the set of country names, whatever their number.
    """
    place = {n.lower(): i for i, (_, n, _) in enumerate(values.COUNTRIES)}
    longest = max(len(re.findall("[a-z0-9_]+", n)) for n in place)
    known = F.array(*(F.lit(n) for n in place))
    at = F.create_map(*(F.lit(x) for pair in place.items() for x in pair))
    codes, names = (F.array(*(F.lit(c[k]) for c in values.COUNTRIES)) for k in (0, 1))

    def first(found: Column) -> Column:
        others = F.filter(F.transform(found, lambda n: F.element_at(at, n)), lambda i: F.get(codes, i) != F.coalesce(cc, F.lit("")))
        return F.get(names, F.array_min(others))

    return rx.let(F.array_intersect(known, phrases(name, longest)), lambda x: F.when(F.size(x) > 0, first(x)))


def normalised_reason(reason: Column, places: bool = True) -> Column:
    """A rejection's reason without its particulars: the first quoted text and, with ``places``, all after `` to ``."""
    out = rx.sub(reason, r"^([^\x22]*?) *\x22[^\x22]*\x22", "$1", fold=False)
    return rx.trimmed(rx.sub(out, " to .*$", "", fold=False) if places else out)


def drawn_by_script(html: Column) -> Column:
    """A page whose content is most likely drawn by a script."""
    return rx.like(html, values.DRAWN_BY_SCRIPT, fold=False)
