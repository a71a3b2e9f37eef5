"""Rounds over arriving records, state by key, and event-time windows (an extension)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import merge, schedule
from ..sources.keyed_store import KeyedStore


def tumbling(events: DataFrame, width: str = "1 hour", late: str | None = None) -> DataFrame:
    """Events, their users' values and kinds by window and type; the same for a table and for a stream with a watermark."""
    rows = events.withColumn("at", F.col("ts").cast("timestamp"))
    if late:
        rows = rows.withWatermark("at", late)
    out = rows.groupBy(F.window("at", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("window.start").alias("start"), "event_type", "n", "total")


def sliding(events: DataFrame, width: str = "1 hour", step: str = "15 minutes", late: str | None = None) -> DataFrame:
    """Events by overlapping windows and type: each row counts in every window that it lies in."""
    rows = events.withColumn("at", F.col("ts").cast("timestamp"))
    if late:
        rows = rows.withWatermark("at", late)
    out = rows.groupBy(F.window("at", width, step), "event_type").agg(F.count("*").alias("n"))
    return out.select(F.col("window.start").alias("start"), "event_type", "n")


def sessions(events: DataFrame, gap: str = "6 hours", late: str | None = None) -> DataFrame:
    """``user_id, start, end, n``: the events of each user that follow each other within ``gap``; ``end`` is that much after the last."""
    rows = events.filter("user_id is not null").withColumn("at", F.col("ts").cast("timestamp"))
    if late:
        rows = rows.withWatermark("at", late)
    out = rows.groupBy(F.session_window("at", gap), "user_id").agg(F.count("*").alias("n"))
    return out.select("user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def answered(attempts: DataFrame, outcomes: DataFrame, within: str = "1 hour", late: str | None = None) -> DataFrame:
    """``key, tried, came, note``: attempts ``key, tried`` with the outcomes ``key, came, note`` that came no later than ``within`` after them.

    The same for tables and for streams; with ``late`` Spark forgets what no later row can meet.
    """
    if late:
        attempts, outcomes = attempts.withWatermark("tried", late), outcomes.withWatermark("came", late)
    a, o = attempts.alias("a"), outcomes.alias("o")
    met = (F.col("a.key") == F.col("o.key")) & (F.col("came") >= F.col("tried")) & (F.col("came") <= F.col("tried") + F.expr(f"interval {within}"))
    return a.join(o, met).select("a.key", "tried", "came", "note")


def dropped(query: StreamingQuery) -> int:
    """Rows that a query's state operators have dropped because they came too late."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])


def first_seen(stream: DataFrame, keys: list[str], late: str = "30 days") -> DataFrame:
    """Each key once, with state that ends after ``late``."""
    return stream.withWatermark("at", late).dropDuplicatesWithinWatermark(keys)


def rounds(arrivals: DataFrame, store_path: str, source: str, checkpoint: str, once: bool = True, buckets: int = 64) -> StreamingQuery:
    """Adds each micro-batch of keyed records to a ``KeyedStore``: a batch writes its own rows and what they make outgrow its base.

    The store knows the stream by its checkpoint folder, so a batch that is repeated after a failure changes nothing.
    """
    store = KeyedStore(arrivals.sparkSession, store_path, arrivals.schema, buckets)

    def merged(batch: DataFrame, number: int) -> None:
        store.add(batch, source, checkpoint, number)

    writer = arrivals.writeStream.foreachBatch(merged).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="20 seconds")).start()


def attempted(store: DataFrame, outcomes: DataFrame, now: int) -> DataFrame:
    """The store after a round of attempts ``outcomes(key, note, email)``: the state of each record by its outcome."""
    after = schedule.after_attempt(F.col("attempts"), F.col("note"), F.lit(now))
    rows = store.join(outcomes.withColumnRenamed("email", "got"), "key", "left").withColumn("a", F.when(F.col("note").isNotNull(), after))
    new = {
        "attempts": F.coalesce("a.attempts", "attempts"),
        "retryAfter": F.coalesce("a.retryAfter", "retryAfter"),
        "crawled": F.coalesce("a.crawled", "crawled"),
        "crawlNote": F.coalesce("note", "crawlNote"),
        "email": F.coalesce(merge.filled(F.col("email")), "got"),
        "lastTried": F.when(
            F.col("note").isNotNull(),
            F.date_format(F.timestamp_millis(F.lit(now)), "yyyy-MM-dd"),
        ).otherwise(F.col("lastTried")),
    }
    return rows.select(*(new.get(c, F.col(c)).alias(c) for c in store.columns))
