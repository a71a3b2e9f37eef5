"""What is due, in which order, and what an attempt does to a record.  ``now`` is always given, in milliseconds or as a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules, rx, urls, values
from .merge import filled

DAY, MINUTE = 86_400_000, 60_000


def _n(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0))


def reopened(store: DataFrame, now: Column) -> DataFrame:
    """Settled records whose last attempt is over 30 days old, or has no date, get one more."""
    open_ = filled(F.col("email")).isNull() & filled(F.col("website")).isNotNull()
    tried = F.unix_millis(F.to_timestamp("lastTried"))
    old = F.coalesce(now - tried > 30 * DAY, F.lit(True))
    return store.withColumn("attempts", F.when(open_ & (_n("attempts") >= 4) & old, F.lit(3)).otherwise(_n("attempts")))


def crawl_due(store: DataFrame, now: Column) -> DataFrame:
    """Records to crawl now: no address, a site, under four attempts and no wait left."""
    return reopened(store, now).filter(
        filled(F.col("email")).isNull() & filled(F.col("website")).isNotNull() & (F.col("attempts") < 4) & (_n("retryAfter") <= now)
    )


def after_attempt(attempts: Column, note: Column, now: Column) -> Column:
    """``struct<attempts, retryAfter, crawled>`` after an attempt's outcome; null parts stay as they are."""
    more = F.coalesce(attempts, F.lit(0)) + 1
    challenged, silent, missed = note == "blocked by a challenge page", note == "no email published", note.isin("unreachable", "bad url")
    count = F.when(challenged, F.greatest(more - 1, F.lit(0))).when(silent, F.lit(4)).otherwise(more)
    wait = F.when(challenged, now + 360 * MINUTE).when(missed, now + more * 10 * MINUTE)
    return F.struct(count.alias("attempts"), wait.alias("retryAfter"), F.when(~challenged & ~missed, F.lit(True)).alias("crawled"))


def leads_due(leads: DataFrame, now: Column) -> DataFrame:
    """Leads never searched, or searched in vain 30 days ago or more."""
    age = now - F.unix_millis(F.to_timestamp("searched"))
    return leads.filter(filled(F.col("searched")).isNull() | (filled(F.col("website")).isNull() & (age >= 30 * DAY)))


def workable(queue: DataFrame, pages: int) -> DataFrame:
    """``url, place``: seeds that are not done, the least recently run first, as far as a budget of pages goes (one for each)."""
    rows = queue.filter(~F.coalesce("done", F.lit(False))).select("url", F.coalesce("lastRun", F.lit("")).alias("lastRun"), F.lit(1).alias("cost"))
    return budget_prefix(rows, F.col("lastRun"), ["lastRun", "url"], "cost", pages).select("url", (F.col("spent") + 1).cast("bigint").alias("place"))


def lead_queries(leads: DataFrame) -> DataFrame:
    """``key, query, place``: what is asked for each lead ``key, name, town``: name and town, then the name, each once."""
    both = F.trim(F.concat_ws(" ", filled(F.trim("name")), filled(F.trim("town"))))
    fit = leads.filter(F.size(rules.name_tokens(F.col("name"))) > 0)
    return fit.select("key", F.posexplode(F.array_distinct(F.array(both, F.trim("name")))).alias("place", "query"))


def leads_reset(leads: DataFrame) -> DataFrame:
    """Leads searched in vain count as never searched."""
    again = filled(F.col("searched")).isNotNull() & filled(F.col("website")).isNull()
    blank = lambda c: F.when(~again, F.col(c)).alias(c)
    return leads.select(*(blank(c) if c in ("searched", "searchNote") else c for c in leads.columns))


def requeued(store: DataFrame) -> DataFrame:
    """Records given up on start anew, without a wait or a note."""
    again = filled(F.col("email")).isNull() & filled(F.col("website")).isNotNull() & (
        (F.col("crawlNote") == "no email published") | (_n("attempts") >= 3)
    )
    again = F.coalesce(again, F.lit(False))
    new = {"attempts": F.when(again, 0).otherwise(_n("attempts")), "crawled": F.when(again, F.lit(False)).otherwise(F.col("crawled"))}
    new |= {c: F.when(~again, F.col(c)) for c in ("crawlNote", "retryAfter")}
    return store.select(*(new[c].alias(c) if c in new else c for c in store.columns))


def next_countries(priority: DataFrame, state: DataFrame, now: Column, n: int) -> DataFrame:
    """``cc, tier``: never imported or failed ones by priority (fresh failures wait, unless partial), then the oldest imports."""
    rows = priority.join(state, "cc", "left")
    failed = filled(F.col("error")).isNotNull()
    at = F.unix_millis(F.to_timestamp("at"))
    waits = failed & ~F.coalesce("split", F.lit(False)) & (now - at < 20 * MINUTE)
    tier = F.when(F.col("at").isNull() | (failed & ~waits), 1).when(~failed, 2)
    ranked = rows.withColumn("tier", tier).filter("tier is not null")
    return ranked.orderBy("tier", F.when(F.col("tier") == 1, F.col("prio")).otherwise(at), "prio").limit(n).select("cc", "tier")


def least_recent(rows: DataFrame, column: str, *last: str) -> DataFrame:
    """Never run first, then the least recently run."""
    return rows.orderBy(F.coalesce(F.col(column).cast("string"), F.lit("")), *last)


def prospect_order(countries: DataFrame, state: DataFrame, round_no: int) -> DataFrame:
    """``cc, prio, place``: odd rounds take ``countries(cc, prio)`` by priority, even ones the one of ``state(cc, last)`` that waited longest."""
    rows = countries.join(state.select("cc", "last"), "cc", "left")
    order = [F.col("prio")] if round_no % 2 else [F.coalesce("last", F.lit("")), F.col("prio")]
    return rows.select("cc", "prio", F.row_number().over(Window.orderBy(*order)).alias("place"))  # some ninety rows


def phase_order(round_no: int) -> tuple[str, str]:
    """The phase that goes first, by the round's parity."""
    return ("crawl", "prospect") if round_no % 2 == 0 else ("prospect", "crawl")


def epoch_state(state: DataFrame, epoch: int) -> DataFrame:
    """``state(cc, epoch, queriesDone, cityStats, ...)`` where progress of another epoch is forgotten."""
    stale = ~F.col("epoch").eqNullSafe(F.lit(epoch))
    new = {c: F.when(~stale, F.col(c)) for c in ("queriesDone", "cityStats")} | {"epoch": F.lit(epoch)}
    return state.select(*(new[c].alias(c) if c in new else c for c in state.columns))


def failure_wait(failures: Column) -> Column:
    """Milliseconds to rest after so many failed rounds in a row: five seconds each, a minute at most."""
    return F.least(F.lit(60_000), 5_000 * failures)


def budget_prefix(rows: DataFrame, coarse: Column, order: list[str], cost: str, budget: float) -> DataFrame:
    """Rows in order until their costs so far reach the budget (the row that reaches it stays).

    ``coarse`` is a value that rises with the order, such as its day: running sums are taken within a value and on the
    values' own sums, so no task sees all rows.
    """
    dealt = rows.withColumn("coarse", coarse)
    sums = dealt.groupBy("coarse").agg(F.sum(cost).alias("here"))
    before = sums.select("coarse", (F.sum("here").over(Window.orderBy("coarse")) - F.col("here")).alias("before"))  # a row for each value
    inside = F.coalesce(F.sum(cost).over(Window.partitionBy("coarse").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return dealt.join(before.filter(F.col("before") < budget), "coarse").withColumn("spent", F.col("before") + inside).filter(F.col("spent") < budget).drop("coarse", "before")


def failure_runs(rows: DataFrame, key: list[str], order: list[str], ok: Column, least: int) -> DataFrame:
    """Runs of ``least`` or more consecutive failures: ``key, run, length``."""
    run = F.sum(F.when(ok, 1).otherwise(0)).over(Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumns({"ok": ok, "run": run}).filter(~F.col("ok")).groupBy(*key, "run").agg(F.count("*").alias("length")).filter(F.col("length") >= least)


def judged_results(leads: DataFrame, results: DataFrame) -> DataFrame:
    """``key, query, rank, url, own, local, platform`` of search results, as ``pick_site`` needs them.

    ``leads(key, name, cc)`` and ``results(key, query, rank, url, title)``.  Results that are never a club's site go, and so
    do leads whose names have no distinctive word.  An own domain is named by its origin.  A page of a club platform
    counts only if its path or title has every distinctive word of the name.
    """
    fit = leads.filter(F.size(rules.name_tokens(F.col("name"))) > 0).select("key", "name", "cc")
    rows = results.filter(~rx.like(F.col("url"), values.NOT_A_CLUB_SITE)).withColumn("origin", urls.origin_of(F.col("url"))).filter("origin <> ''").join(fit, "key")
    own = rules.plausible_site(F.col("name"), F.col("origin"))
    path = F.substr("url", F.char_length("origin") + 1)
    named = (rules.name_overlap(F.col("name"), path) == 1) | (rules.name_overlap(F.col("name"), F.col("title")) == 1)
    local = F.coalesce(urls.country_of_host(urls.host_of(F.col("origin"))) == F.col("cc"), F.lit(False))
    rows = rows.withColumns({"own": own, "local": local, "platform": ~own & rx.like(F.col("origin"), values.CLUB_PLATFORM) & named})
    return rows.select(
        "key",
        "query",
        "rank",
        F.when(F.col("own"), F.col("origin")).otherwise(F.col("url")).alias("url"),
        "own",
        "local",
        "platform",
    )


def sites_found(leads: DataFrame, results: DataFrame) -> DataFrame:
    """``key, url, note`` for every lead of ``leads(key, name, cc)`` that was searched: its site, or why there is none."""
    picked = pick_site(judged_results(leads, results), ["key"])
    answered = results.select("key").distinct().withColumn("answered", F.lit(True))
    rows = leads.select("key", "name").join(picked, "key", "left").join(answered, "key", "left")
    note = (
        F.when(F.size(rules.name_tokens(F.col("name"))) == 0, "name too generic to search")
        .when(F.col("tier") == 3, F.concat(F.lit("club platform page "), F.col("url")))
        .when(F.col("url").isNotNull(), F.concat(F.lit("own domain "), F.col("url")))
        .when(F.col("answered").isNull(), "search engine did not answer")
        .otherwise("no result matching the name")
    )
    return rows.select("key", F.coalesce("url", F.lit("")).alias("url"), note.alias("note"))


def pick_site(results: DataFrame, key: list[str]) -> DataFrame:
    """The best search result of each lead: ``key, url, tier``.

    ``results`` has ``query, rank, url, own (plausible), local (of the lead's country), platform`` and is cut to the first
    ten of a query.  An own domain in the country, else an own domain, else a platform page; then by query and rank.
    """
    tier = F.when(F.col("own") & F.col("local"), 1).when(F.col("own"), 2).when(F.col("platform"), 3)
    fit = results.filter(F.col("rank") <= 10).withColumn("tier", tier).filter("tier is not null")
    return fit.groupBy(*key).agg(
        F.min_by(F.struct("url", "tier"), F.struct("tier", "query", "rank")).alias("x")
    ).select(*key, "x.url", "x.tier")
