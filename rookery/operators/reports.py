"""Counts and coverage reports.  Each is a grouped sum, with what is ordered given an explicit last key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ranges

from .merge import filled


SPORTS = ("Tennis", "Padel", "Squash")


def has(c: str) -> Column:
    return filled(F.col(c)).isNotNull()


def country_counts(store: DataFrame) -> DataFrame:
    """Records, addresses and queued records by country, and in all (null country)."""
    queued = ~has("email") & has("website") & (F.coalesce("attempts", F.lit(0)) < 4)
    return store.rollup("country").agg(
        F.count("*").alias("total"),
        F.count_if(has("email")).alias("with_email"),
        F.count_if(queued).alias("queued"),
    )


def crawl_buckets(store: DataFrame, now: Column) -> DataFrame:
    """Ready, waiting and exhausted records that lack an address; a record may wait and be exhausted."""
    open_ = ~has("email") & has("website")
    worn = F.coalesce("attempts", F.lit(0)) >= 4
    waits = F.coalesce("retryAfter", F.lit(0)) > now
    return store.agg(
        F.count_if(open_ & ~worn & ~waits).alias("ready"),
        F.count_if(open_ & waits).alias("waiting"),
        F.count_if(open_ & worn).alias("exhausted"),
    )


def top_reasons(rows: DataFrame, reason: Column, order: str, n: int) -> DataFrame:
    """The ``n`` most frequent reasons; of equal ones the first met."""
    counts = rows.withColumn("reason", reason).filter(has("reason")).groupBy("reason").agg(
        F.count("*").alias("n"),
        F.min(order).alias("first"),
    )
    return counts.orderBy(F.desc("n"), "first", "reason").limit(n).select("reason", "n")


def by_country(published: DataFrame) -> DataFrame:
    """Published records by country."""
    return published.groupBy("country").agg(F.count("*").alias("n"))


def by_sport(published: DataFrame, sports: tuple[str, ...] = SPORTS) -> DataFrame:
    """Counts of the fixed sports, zero where there is none, in one row without a join."""
    return published.agg(*(F.count_if(F.array_contains("sports", s)).alias(s) for s in sports))


def country_slots(store: DataFrame) -> DataFrame:
    """Coverage of each country: what is known, what was read, by sport and by source; records without a country fall out."""
    store = store.filter(has("country"))
    totals = store.groupBy("country").agg(
        F.count("*").alias("clubs"),
        F.count_if(has("email")).alias("emails"),
        F.count_if(has("website")).alias("sites"),
        F.count_if(has("crawlNote")).alias("read"),
        F.count_if(F.col("crawlNote") == "unreachable").alias("unreachable"),
        F.count_if(F.col("crawlNote") == "no email published").alias("no_address"),
        *(F.count_if(F.array_contains("sports", s)).alias(s.lower()) for s in SPORTS),
    )
    source = store.filter(has("email")).groupBy("country", F.coalesce("src", F.lit("?")).alias("src")).agg(F.count("*").alias("n"))
    sources = source.groupBy("country").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("src", "n")))).alias("sources"))
    return totals.join(sources, "country", "left")


def import_summary(priority: DataFrame, state: DataFrame) -> DataFrame:
    """Imported, failed and pending countries, and the latest error."""
    joined = priority.join(state.withColumn("known", F.lit(True)), "cc", "left")
    done = F.col("known").isNotNull() & ~has("error")
    return joined.agg(
        F.count_if(done).alias("imported"),
        F.count_if(has("error")).alias("failed"),
        F.count_if(F.col("known").isNull()).alias("pending"),
        F.count("*").alias("total"),
        F.max_by("error", F.when(has("error"), F.col("at"))).alias("last_error"),
    )


def leads_summary(leads: DataFrame) -> DataFrame:
    """Leads in all, those searched and those left; nulls and blanks count as not searched."""
    return leads.agg(F.count("*").alias("total"), F.count_if(has("searched")).alias("searched"), F.count_if(~has("searched")).alias("left"))


def seeds_summary(queue: DataFrame) -> DataFrame:
    """Seeds in all, at work and exhausted, and the pages they gave; a null ``done`` is at work."""
    return queue.agg(
        F.count("*").alias("total"),
        F.count_if(~F.coalesce("done", F.lit(False))).alias("working"),
        F.count_if("done").alias("exhausted"),
        F.coalesce(F.sum("pagesRead"), F.lit(0)).alias("pages"),
    )


def mine_summary(state: DataFrame) -> DataFrame:
    """Mined words, pages they have queued and records they have added; nulls count as none."""
    return state.agg(
        F.count("*").alias("patterns"),
        F.coalesce(F.sum(F.size(F.coalesce("pending", F.array()))), F.lit(0)).alias("queued"),
        F.coalesce(F.sum("added"), F.lit(0)).alias("added"),
    )


def leads_by_country(leads: DataFrame) -> DataFrame:
    """Leads of each country: all, searched, and with a site."""
    return leads.filter(has("country")).groupBy("country").agg(
        F.count("*").alias("leads"),
        F.count_if(has("searched")).alias("searched"),
        F.count_if(has("website")).alias("found"),
    )


def site_summary(published: DataFrame) -> DataFrame:
    """One row of the site's figures: ``count, byCountry, bySport``; the records themselves are written as rows beside it."""
    places = published.groupBy("country").agg(
        F.count("*").alias("n"),
        *(F.count_if(F.array_contains("sports", s)).alias(s) for s in SPORTS),
    )
    return places.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("count"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("country", "n")))).alias("byCountry"),
        F.create_map(*(x for s in SPORTS for x in (F.lit(s), F.coalesce(F.sum(s), F.lit(0))))).alias("bySport"),
    )


def site_lines(published: DataFrame) -> DataFrame:
    """``ord, value``: the site's file as lines, figures first, then one record a line in the published order.

    ``published`` has ``name, sports, contact, email, lang, country, src, stale``; an empty one gives a file without records.
    """
    figures = F.to_json(F.struct("count", "byCountry", "bySport"))
    head = site_summary(published).select(F.lit(0).cast("bigint").alias("ord"), F.concat(F.regexp_replace(figures, r"\}\z", ""), F.lit(',"clubs":[')).alias("value"))
    order = [F.collate("country", "UNICODE"), F.collate("name", "UNICODE"), F.col("email")]
    rows = ranges.placed(published, order).withColumn("record", F.to_json(F.struct(*published.columns), {"ignoreNullFields": "false"}))
    comma = F.when(F.col("place") > 1, F.lit(",")).otherwise("")
    body = rows.select(F.col("place").cast("bigint").alias("ord"), F.concat(comma, "record").alias("value"))
    tail = head.select(F.lit((1 << 63) - 1).alias("ord"), F.lit("]}").alias("value"))
    return head.unionByName(body).unionByName(tail)


def seed_counts_line(counts: DataFrame) -> DataFrame:
    """``line``: ``CC×n`` of all countries, most first."""
    all_ = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "cc")))
    return counts.agg(F.array_join(F.transform(all_, lambda x: F.concat(x["cc"], F.lit("×"), (-x["m"]).cast("string"))), " ").alias("line"))


def seeds_by_country(queue: DataFrame, countries: DataFrame) -> DataFrame:
    """Seeds of each country; seeds without a fixed country fall out."""
    return queue.join(F.broadcast(countries), "cc").groupBy("cc").agg(F.count("*").alias("n"))


def city_emails(store: DataFrame) -> DataFrame:
    """Addresses by country and city; records without a city or an address go."""
    return store.filter(has("country") & has("city") & has("email")).groupBy("country", "city").agg(F.count("*").alias("emails"))


def city_coverage(stats: DataFrame, emails: DataFrame) -> DataFrame:
    """``country, city, searches, found, emails`` over the union of both sides' cities."""
    return emails.join(stats, ["country", "city"], "full").select(
        "country",
        "city",
        *(F.coalesce(c, F.lit(0)).alias(c) for c in ("searches", "found", "emails")),
    )


def import_totals(state: DataFrame) -> DataFrame:
    """``added, merged, failed`` over all countries' imports, ``failed`` naming those with an error in order."""
    failed = F.array_join(F.array_sort(F.collect_list(F.when(has("error"), F.col("cc")))), " ")
    return state.agg(F.coalesce(F.sum("added"), F.lit(0)).alias("added"), F.coalesce(F.sum("merged"), F.lit(0)).alias("merged"), failed.alias("failed"))


def import_counters(outcomes: DataFrame) -> DataFrame:
    """Counts of a map import by outcome."""
    of = lambda kind: F.count_if(F.col("outcome") == kind)
    return outcomes.agg(
        F.count("*").alias("seen"),
        of("added").alias("added"),
        of("merged").alias("merged"),
        of("rejected").alias("rejected"),
        of("lead").alias("leads"),
        F.count_if(has("email")).alias("with_email"),
    )


def restore_counters(published: DataFrame, store: DataFrame, countries: DataFrame) -> DataFrame:
    """What a restore would do, in one pass over the joined rows."""
    known = store.select(F.lower("email").alias("e"), F.lit(True).alias("known")).distinct()
    named = countries.select(F.lower("name").alias("c"), F.lit(True).alias("wanted"))
    rows = published.join(known, F.lower("email") == F.col("e"), "left").join(F.broadcast(named), F.lower("country") == F.col("c"), "left")
    new = F.col("known").isNull()
    return rows.agg(
        F.count("*").alias("total"),
        F.count_if(~new).alias("already"),
        F.count_if(new & F.col("wanted").isNotNull()).alias("to_add"),
        F.count_if(new & F.col("wanted").isNull()).alias("unknown_country"),
    )


def status(
    store: DataFrame,
    leads: DataFrame,
    queue: DataFrame,
    mine: DataFrame,
    priority: DataFrame,
    imports: DataFrame,
    now: Column,
) -> DataFrame:
    """``section, value``: the sections of a status report, each as JSON."""

    def section(name: str, one_row: DataFrame) -> DataFrame:
        return one_row.select(
            F.lit(name).alias("section"),
            F.to_json(F.struct(*one_row.columns), {"ignoreNullFields": "false"}).alias("value"),
        )

    reasons = top_reasons(store, F.col("crawlNote"), "ord", 6)
    listed = reasons.agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "reason"))).alias("all"))  # six rows
    listed = listed.select(F.transform("all", lambda x: F.struct(x["reason"].alias("reason"), (-x["m"]).alias("n"))).alias("reasons"))
    parts = {
        "crawl": crawl_buckets(store, now),
        "reasons": listed,
        "imports": import_summary(priority, imports),
        "leads": leads_summary(leads),
        "seeds": seeds_summary(queue),
        "mine": mine_summary(mine),
    }
    out = None
    for name, rows in parts.items():
        out = section(name, rows) if out is None else out.unionByName(section(name, rows))
    return out


def by_emails(slots: DataFrame) -> list[Column]:
    """The order of countries in a report: most addresses first."""
    return [F.desc("emails"), F.col("country")]


def page_audit(pages: DataFrame) -> DataFrame:
    """``pages(page, links, internal, external, emails)``, all counts, with a verdict."""
    good = (F.col("emails") >= 3) | (F.col("external") >= 3)
    return pages.select("page", "links", "internal", "external", "emails", F.when(good, "GOOD").otherwise("MAYBE").alias("verdict"))


def distinct_sketches(rows: DataFrame, keys: list[str], value: str, size: int = 12) -> DataFrame:
    """``keys, sketch``: a sketch of the distinct values of each group (an extension); sketches can be united, and do not grow.

    ``size`` is the binary logarithm of a sketch's registers; a count is off by about ``1.04 / sqrt(2 ** size)`` of itself.
    """
    return rows.groupBy(*keys).agg(F.hll_sketch_agg(value, size).alias("sketch"))


def united_counts(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, n``: estimated distinct values over all sketches that share ``keys``, such as the days of a range."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n"))
