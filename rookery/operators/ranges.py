"""Work in one global order that no single task sees as a whole: places, and breakers that open after failures in a row.

Rows are dealt to ranges of the order and written once, so that later passes see the same ranges.  Each range is summed up in
a few numbers that can be joined to those of its neighbours; the driver runs over these, one or two rows for each range, and
what came before a range is joined back to its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.files import shared_folder


def ranged(rows: DataFrame, order: list[Column], ranges: int | None = None) -> DataFrame:
    """``row`` (all columns), ``o0, o1, ...`` (the order) and ``range``, which rises with it; equal rows are in one range.

    Written to the shared folder, so that the ranges stay what they are however often the result is read.
    """
    spark = rows.sparkSession
    path = shared_folder(spark, "ranges")
    names = [f"o{i}" for i in range(len(order))]
    flat = rows.select(F.struct(*rows.columns).alias("row"), *(c.alias(n) for c, n in zip(order, names, strict=True)))
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = flat.repartitionByRange(n, *names).withColumn("range", F.spark_partition_id())
    dealt.write.parquet(path)
    return spark.read.schema(dealt.schema).parquet(path)


def placed(rows: DataFrame, order: list[Column], ranges: int | None = None) -> DataFrame:
    """``rows`` with ``place``, counted from 1 in an order that should leave no ties: counts for each range, and numbers within it."""
    dealt = ranged(rows, order, ranges)
    counts = {r.range: r.n for r in dealt.groupBy("range").agg(F.count("*").alias("n")).collect()}  # a row for each range
    before, total = [], 0
    for k in sorted(counts):
        before.append((k, total))
        total += counts[k]
    offsets = F.broadcast(rows.sparkSession.createDataFrame(before, "range int, before long"))
    within = Window.partitionBy("range").orderBy(*(f"o{i}" for i in range(len(order))))
    found = dealt.join(offsets, "range").select("row", (F.col("before") + F.row_number().over(within)).alias("at"))
    return found.select(*(F.col(f"row.{c}") for c in rows.columns if c != "place"), F.col("at").alias("place"))


def _after(s: int, opens: int, x, k: int) -> tuple[int, int]:
    """Failures in a row and openings at the end of a part that begins with these."""
    return ((s + x.lead) % k if x.lead == x.n else x.trail % k), opens + (s + x.lead) // k + x.inner


def breaker(rows: DataFrame, order: list[Column], ok: Column, k: int, keys: list[str] | None = None, ranges: int | None = None) -> DataFrame:
    """``rows`` with ``streak, opened, pauses``: how a breaker that opens at the ``k``-th failure in a row sees attempts in their order.

    ``streak`` counts failures in a row up to this one, anew after each opening (0 for a success); ``opened`` says that the
    breaker opens after this row; ``pauses`` counts the openings before it.  An attempt whose outcome is null has failed.
    With ``keys`` each key has a breaker of its own.  A phase that stops at the first opening keeps the rows without a
    pause before them; one that rests and goes on starts each row ``pauses`` rests later.  The order should leave no ties.
    """
    # the outcome travels with the order; it decides nothing there, as ties are not meant to be
    by = [F.struct(F.lit(0), *(keys or [])), *order, F.coalesce(ok, F.lit(False))]
    dealt = ranged(rows, by, ranges).withColumnsRenamed({"o0": "key", f"o{len(by) - 1}": "ok"})
    own = Window.partitionBy("range", "key").orderBy(*(f"o{i}" for i in range(1, len(by) - 1)))
    upto, earlier = (own.rowsBetween(Window.unboundedPreceding, end) for end in (0, -1))
    runs = dealt.withColumn("i", F.row_number().over(own).cast("long"))
    runs = runs.withColumn("last", F.max(F.when(F.col("ok"), F.col("i"))).over(upto))
    # failures in a row within the range and key, and whether no success came before in it
    runs = runs.withColumns({"local": F.col("i") - F.coalesce("last", F.lit(0)), "leading": F.col("last").isNull()})
    sums = runs.groupBy("range", "key").agg(
        F.count("*").alias("n"),
        F.count_if("leading").alias("lead"),
        (F.count("*") - F.coalesce(F.max("last"), F.lit(0))).alias("trail"),
        F.count_if(~F.col("leading") & ~F.col("ok") & (F.col("local") % k == 0)).alias("inner"),
    )
    part = F.struct("key", "n", "lead", "trail", "inner")
    edges = sums.groupBy("range").agg(F.min_by(part, "key").alias("first"), F.max_by(part, "key").alias("last"))
    before, held = [], None
    for r in sorted(edges.collect(), key=lambda r: r.range):  # two sums for each range
        s, opens = held[1] if held and held[0] == r.first.key else (0, 0)
        before.append((r.range, r.first.key, s, opens))
        one = r.first.key == r.last.key
        held = (r.last.key, _after(s, opens, r.first, k) if one else _after(0, 0, r.last, k))
    kind = sums.schema["key"].dataType.simpleString()
    known = rows.sparkSession.createDataFrame(before, f"range int, key {kind}, s long, opens long").alias("b")
    met = (F.col("r.range") == F.col("b.range")) & F.col("r.key").eqNullSafe(F.col("b.key"))
    none = lambda c: F.coalesce(c, F.lit(0))
    joined = runs.alias("r").join(F.broadcast(known), met, "left").select("r.*", none("b.s").alias("s"), none("b.opens").alias("opens"))
    run = F.when(F.col("leading"), F.col("s") + F.col("local")).otherwise(F.col("local"))
    joined = joined.withColumn("streak", F.when(F.col("ok"), F.lit(0)).otherwise((run - 1) % k + 1).cast("long"))
    pauses = F.col("opens") + none(F.sum((F.col("streak") == k).cast("long")).over(earlier))
    out = joined.withColumn("pauses", pauses)
    kept = [F.col(f"row.{c}") for c in rows.columns if c not in ("streak", "opened", "pauses")]
    return out.select(*kept, "streak", (F.col("streak") == k).alias("opened"), "pauses")


def until_open(rows: DataFrame, order: list[Column], ok: Column, k: int, keys: list[str] | None = None) -> DataFrame:
    """The attempts that are made by a phase that ends at the ``k``-th failure in a row."""
    return breaker(rows, order, ok, k, keys).filter("pauses = 0").select(*rows.columns)


def _carried(rows: DataFrame, order: list[Column], value: Column, name: str, keys: list[str], ranges: int | None, ahead: bool) -> DataFrame:
    """``rows`` with the nearest ``value`` that is not null at or before each row of its key (``ahead``: at or after it)."""
    by = [F.struct(F.lit(0), *keys), *order, value]
    dealt = ranged(rows, by, ranges).withColumnsRenamed({"o0": "key", f"o{len(by) - 1}": "value"})
    turned = [F.desc(f"o{i}") if ahead else F.asc(f"o{i}") for i in range(1, len(by) - 1)]
    upto = Window.partitionBy("range", "key").orderBy(*turned).rowsBetween(Window.unboundedPreceding, 0)
    inside = dealt.withColumn("near", F.last("value", ignorenulls=True).over(upto))
    # of each range the keys at both ends and the values that they hand on
    at = F.struct(*(f"o{i}" for i in range(1, len(by) - 1)))
    nearest = (F.min_by if ahead else F.max_by)("value", F.when(F.col("value").isNotNull(), at))
    sums = dealt.groupBy("range", "key").agg(nearest.alias("given"))
    part = F.struct("key", "given")
    edges = sums.groupBy("range").agg(F.min_by(part, "key").alias("first"), F.max_by(part, "key").alias("last"))
    before, held = [], None
    for r in sorted(edges.collect(), key=lambda r: -r.range if ahead else r.range):  # two values for each range
        near, far = (r.last, r.first) if ahead else (r.first, r.last)
        got = held[1] if held and held[0] == near.key else None
        before.append((r.range, near.key, got))
        held = (far.key, far.given if far.given is not None or far.key != near.key else got)
    kinds = ", ".join(f"{n} {dealt.schema[c].dataType.simpleString()}" for n, c in (("key", "key"), ("got", "value")))
    known = rows.sparkSession.createDataFrame(before, f"range int, {kinds}").alias("b")
    met = (F.col("r.range") == F.col("b.range")) & F.col("r.key").eqNullSafe(F.col("b.key"))
    joined = inside.alias("r").join(F.broadcast(known), met, "left")
    kept = [F.col(f"r.row.{c}") for c in rows.columns if c != name]
    return joined.select(*kept, F.coalesce("r.near", "b.got").alias(name))


def next_value(rows: DataFrame, order: list[Column], value: Column, name: str, keys: list[str] | None = None, ranges: int | None = None) -> DataFrame:
    """``rows`` with the first ``value`` that is not null at or after each row in the order (of its key)."""
    return _carried(rows, order, value, name, keys or [], ranges, True)


def last_value(rows: DataFrame, order: list[Column], value: Column, name: str, keys: list[str] | None = None, ranges: int | None = None) -> DataFrame:
    """``rows`` with the last ``value`` that is not null at or before each row in the order (of its key)."""
    return _carried(rows, order, value, name, keys or [], ranges, False)


def as_of(events: DataFrame, states: DataFrame, keys: list[str], at: str, since: str, ranges: int | None = None) -> DataFrame:
    """``events`` with ``state``, the row of ``states`` with the same keys that held at the event's time ``at``: the last with ``since`` at or before it.

    Of states of one time the greatest row counts.  Events before the first state, without a time or without a key have a null
    ``state``; states without a time or a key count for nothing.  A key that holds most rows is dealt to many tasks.
    """
    state = F.struct(*states.columns)
    none = F.lit(None)
    fit = states.filter(F.col(since).isNotNull())
    for c in keys:
        fit = fit.filter(F.col(c).isNotNull())
    each = events.select(*keys, F.struct(*events.columns).alias("event"), F.col(at).alias("t"), none.cast(fit.select(state.alias("s")).schema["s"].dataType).alias("held"))
    held = fit.select(*keys, none.cast(each.schema["event"].dataType).alias("event"), F.col(since).cast(each.schema["t"].dataType).alias("t"), state.alias("held"))
    order = [F.col("t"), F.col("event").isNotNull(), F.col("held")]
    found = last_value(each.unionByName(held), order, F.col("held"), "state", keys, ranges).filter("event is not null")
    return found.select(*(F.col(f"event.{c}") for c in events.columns if c != "state"), "state")
