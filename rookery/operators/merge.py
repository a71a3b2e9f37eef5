"""Keyed upserts with rules per source, the published view, and restoring from it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rx, urls


@dataclass(frozen=True)
class Rule:
    """What a known record takes from a new one: blanks that are filled, and whether sports are united."""

    fills: tuple[str, ...] = ()
    sports: bool = False
    email_crawls: bool = False


RULES = {
    "harvest": Rule(("email", "website"), True, True),
    "register": Rule(("email", "website")),
    "prospect": Rule(("website",)),
    "leads": Rule(("email", "website"), False, True),
    "map": Rule(("email", "website", "contact"), True, True),
    "catalogue": Rule((), True),
    "certificates": Rule(),
    "map_leads": Rule(),
}


def filled(c: Column) -> Column:
    """The value, or null where it is blank."""
    return F.when(F.coalesce(c, F.lit("")) != "", c)


def ordered_union(rows: DataFrame, keys: list[str], values: str, order: list[str]) -> DataFrame:
    """Distinct array elements of each key in the order they first come; a group is as large as its distinct elements."""
    each = rows.select(*keys, F.struct(*order).alias("o"), F.posexplode(values).alias("i", "x"))
    first = each.groupBy(*keys, "x").agg(F.min(F.struct("o", "i")).alias("at"))
    return first.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda y: y["x"]).alias(values))


def upsert(store: DataFrame, new: DataFrame, source: str) -> DataFrame:
    """Merges ``new`` into ``store`` by ``key``; both have the same columns with ``key, ord, email, website, contact, sports, crawled``.

    Rows of a key are folded with the stored one first and new ones by ``ord``: the first supplies every column, the source's
    rule says what later ones add.  A stored key is never made anew.  One exchange on the key, partial sums before it.
    """
    rule = RULES[source]
    both = store.withColumn("side", F.lit(0)).unionByName(new.withColumn("side", F.lit(1)))
    at = F.struct("side", "ord")
    rest = [c for c in store.columns if c != "key"]
    found = both.groupBy("key").agg(
        F.min_by(F.struct(*rest), at).alias("base"),
        *(F.min_by(filled(F.col(c)), F.when(filled(F.col(c)).isNotNull(), at)).alias(f"first_{c}") for c in rule.fills),
    )
    fill = {c: F.coalesce(filled(F.col(f"base.{c}")), F.col(f"first_{c}"), F.col(f"base.{c}")) for c in rule.fills}
    if rule.email_crawls:
        gained = filled(F.col("base.email")).isNull() & F.col("first_email").isNotNull()
        fill["crawled"] = F.when(gained, F.lit(True)).otherwise(F.col("base.crawled"))
    if rule.sports:
        found = found.join(ordered_union(both, ["key"], "sports", ["side", "ord"]), "key", "left")
        fill["sports"] = F.coalesce("sports", "base.sports")
    return found.select("key", *(fill.get(c, F.col(f"base.{c}")).alias(c) for c in rest))


def fold(rows: DataFrame) -> DataFrame:
    """Records of ``rows`` by ``key``, with ``side``, the number of the batch that a row came with, and ``source``, the batch's rule (null for stored ones).

    The same as one ``upsert`` after another in the order of ``side``, in one exchange: the first row of a key supplies every
    column, and each later one adds what the rule of its own source lets it add.
    """
    at, none = F.struct("side", "ord"), F.lit(False)

    def has(test) -> Column:
        return F.coalesce(F.col("source").isin(*(s for s, r in RULES.items() if test(r))), none)

    rest = [c for c in rows.columns if c not in ("key", "side", "source")]
    fills = sorted({c for r in RULES.values() for c in r.fills})
    given = {c: filled(F.col(c)).isNotNull() & has(lambda r, c=c: c in r.fills) for c in fills}
    found = rows.groupBy("key").agg(
        F.min_by(F.struct(*rest), at).alias("base"),
        *(F.min_by(filled(F.col(c)), F.when(given[c], at)).alias(f"first_{c}") for c in fills),
        F.min_by(has(lambda r: r.email_crawls), F.when(given["email"], at)).alias("crawls"),
    )
    first = rows.groupBy("key").agg(F.min(at).alias("first"))
    united = rows.join(first, "key").filter((at == F.col("first")) | has(lambda r: r.sports)).drop("first")
    found = found.join(ordered_union(united, ["key"], "sports", ["side", "ord"]), "key", "left")
    fill = {c: F.coalesce(filled(F.col(f"base.{c}")), F.col(f"first_{c}"), F.col(f"base.{c}")) for c in fills}
    gained = filled(F.col("base.email")).isNull() & F.col("first_email").isNotNull() & F.col("crawls")
    fill["crawled"] = F.when(gained, F.lit(True)).otherwise(F.col("base.crawled"))
    fill["sports"] = F.coalesce("sports", "base.sports")
    return found.select("key", *(fill.get(c, F.col(f"base.{c}")).alias(c) for c in rest))


def publishable(store: DataFrame, most: int = 5) -> DataFrame:
    """One row per address: ``name, sports, contact, email, lang, country, src, stale``.

    Rows need a name, an address, a language and a sport.  Of the rows of an address the first by ``ord`` supplies language,
    country, source and staleness; sports are united in order; the contact is the first that is not blank; the name is the
    longest, the earlier of equals.  Addresses of more than ``most`` rows belong to a directory and go.
    """
    fit = store.filter(
        filled(F.col("name")).isNotNull() & filled(F.col("email")).isNotNull() & filled(F.col("lang")).isNotNull() & (F.size("sports") > 0)
    )
    fit = fit.withColumn("email", F.lower("email")).select("ord", "name", "sports", "contact", "email", "lang", "country", "src", "stale")
    folded = fit.groupBy("email").agg(
        F.min_by(F.struct("lang", "country", "src", F.coalesce("stale", F.lit(False)).alias("stale")), "ord").alias("x"),
        F.coalesce(F.min_by("contact", F.when(filled(F.col("contact")).isNotNull(), F.col("ord"))), F.lit("")).alias("contact"),
        F.max_by("name", F.struct(F.char_length("name"), -F.col("ord"))).alias("name"),
        F.count("*").alias("n"),
    )
    kept = folded.filter(F.col("n") <= most)
    out = kept.join(ordered_union(fit, ["email"], "sports", ["ord"]), "email")
    return out.select("name", "sports", "contact", "email", "x.lang", "x.country", "x.src", "x.stale")


def published_order() -> list[Column]:
    """Country, then name, by Unicode collation."""
    return [F.collate("country", "UNICODE"), F.collate("name", "UNICODE")]


def collision_keys(rows: DataFrame, base: str, order: list[str]) -> DataFrame:
    """``key``: the base key, with ``#2``, ``#3`` and so on for later rows of it."""
    n = F.row_number().over(Window.partitionBy(base).orderBy(*order))
    return rows.withColumn("key", F.when(n == 1, F.col(base)).otherwise(F.concat(base, F.lit("#"), n.cast("string"))))


def free_keys(rows: DataFrame, base: str, order: list, taken: DataFrame) -> DataFrame:
    """``rows`` with ``key``: for each in turn the first of ``base``, ``base#2``, ``base#3``, ... that neither ``taken(key)`` nor an earlier row has."""
    # number of a taken key within its base; the base itself is the first
    number = F.coalesce(F.regexp_extract("key", r"#([1-9]\d*)\z", 1).try_cast("bigint"), F.lit(1))
    found = taken.filter("key is not null").select(
        F.when(F.col("key").rlike(r"#[1-9]\d*\z") & (number > 1), F.regexp_replace("key", r"#\d+\z", "")).otherwise(F.col("key")).alias("_b"),
        F.when(F.col("key").rlike(r"#[1-9]\d*\z") & (number > 1), number).otherwise(F.lit(1)).alias("_n"),
    ).distinct()
    turn = F.row_number().over(Window.partitionBy(base).orderBy(*order)).cast("bigint")
    numbered = rows.withColumn("_turn", turn)
    wanted = numbered.groupBy(F.col(base).alias("_b")).agg(F.count("*").alias("rows"))
    held = found.join(wanted, "_b").groupBy("_b").agg(F.count("*").alias("held"))
    # the first free numbers of a base are among as many as it has rows and taken keys
    most = F.col("rows") + F.coalesce("held", F.lit(0))
    numbers = wanted.join(held, "_b", "left").select("_b", F.explode(F.sequence(F.lit(1).cast("bigint"), most)).alias("_n"))
    free = numbers.join(found, ["_b", "_n"], "left_anti")
    free = free.withColumn("_turn", F.row_number().over(Window.partitionBy("_b").orderBy("_n")).cast("bigint")).withColumnRenamed("_b", base)
    key = F.when(F.col("_n") == 1, F.col(base)).otherwise(F.concat(base, F.lit("#"), F.col("_n").cast("string")))
    return numbered.join(free, [base, "_turn"]).withColumn("key", key).drop("_turn", "_n")


def restored(published: DataFrame, store: DataFrame, countries: DataFrame, order: list | None = None) -> DataFrame:
    """Published rows whose address the store lacks, as records with their country's code and a key that nothing else has.

    Rows without an address and of countries that are not wanted go.  Rows whose names give one key are numbered in their
    ``order`` (by address if none is given), on from the keys that the store has.  Other columns of the rows stay.
    """
    known = store.select(F.lower("email").alias("email")).filter(filled(F.col("email")).isNotNull()).distinct()
    missing = published.withColumn("email", F.lower("email")).filter(filled(F.col("email")).isNotNull()).join(known, "email", "left_anti")
    wanted = F.broadcast(countries.select(F.lower("name").alias("low"), F.col("cc").alias("code")))
    coded = missing.join(wanted, F.lower("country") == F.col("low")).withColumn("cc", F.col("code")).drop("low", "code")
    keyed = coded.withColumn("base", urls.key_for(F.lit(""), F.lit(""), F.col("cc"), F.col("name"), by_email=False))
    out = free_keys(keyed, "base", order or ["email"], store.select("key")).drop("base")
    return out.withColumns(
        {
            "contact": F.coalesce("contact", F.lit("")),
            "src": F.coalesce(filled(F.col("src")), F.lit("restored")),
            "stale": F.coalesce("stale", F.lit(False)),
            "crawled": F.lit(True),
            "attempts": F.lit(0),
            "restored": F.lit(True),
        }
    )


def new_only(rows: DataFrame, known: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is not known yet."""
    return rows.join(known.select(*on).distinct(), on, "left_anti")


def in_sync(queue: DataFrame, seeds: DataFrame, on: list[str], seeds_read: bool) -> DataFrame:
    """Queue rows that are still among the seeds; all of them where no seeds could be read."""
    return queue.join(seeds.select(*on).distinct(), on, "left_semi") if seeds_read else queue


def with_emails(rows: DataFrame, emails: str) -> DataFrame:
    """``rows`` with ``email``, the best of an array of addresses, and ``alt``, the next three."""
    return rows.withColumns({"email": F.get(emails, F.lit(0)), "alt": F.slice(emails, 2, 3)})


def with_leads(store: DataFrame, leads: DataFrame) -> DataFrame:
    """``store`` with ``town, lat, lon`` of the lead that has a record's country and name; null where there is none."""
    own = urls.key_for(F.lit(""), F.lit(""), F.col("cc"), F.col("name"), by_email=False)
    there = leads.select(F.col("key").alias("lead"), "town", "lat", "lon")
    return store.drop("town", "lat", "lon").withColumn("lead", own).join(there, "lead", "left").drop("lead")


def queue_after(queue: DataFrame, seeds: DataFrame, on: list[str]) -> DataFrame:
    """The queue after a look at the seeds: those that went are dropped, new ones come in with nulls for the rest.

    Where no seeds could be read, the queue stays as it is.
    """
    read = not seeds.isEmpty()
    return in_sync(queue, seeds, on, read).unionByName(new_only(seeds.dropDuplicates(on), queue, on), allowMissingColumns=True)


def latest_element(elements: DataFrame) -> DataFrame:
    """Map elements of several statements by type and id: the last one's content at the first one's place."""
    rest = [c for c in elements.columns if c not in ("type", "id", "ord")]
    return elements.groupBy("type", "id").agg(
        F.max_by(F.struct(*rest), "ord").alias("x"),
        F.min("ord").alias("ord"),
    ).select("type", "id", "ord", "x.*")


def csv_lines(published: DataFrame) -> DataFrame:
    """The five columns of the extract as one line each, without a header."""
    cells = [F.col("name"), F.array_join("sports", "+"), F.coalesce("contact", F.lit("")), F.col("email"), F.col("country")]
    return published.select(F.concat_ws(",", *(rx.csv_cell(c) for c in cells)).alias("value"))
