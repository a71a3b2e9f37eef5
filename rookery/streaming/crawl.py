"""The crawl state of each record over a stream of attempts, with timers for what opens again.

An attempt counts only if its record is open: fewer than four attempts, and no wait left.  What an outcome does is the rule of
``schedule.after_attempt``; a record that is settled is opened for one more attempt ``reopen`` days after its last one.
Spark keeps a few numbers for each key in its state store and one timer: when the wait ends, or when the record opens again.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from ..functions import values
from ..operators.schedule import DAY, MINUTE

STATE = "attempts bigint, retryAfter bigint, note string, lastTried bigint, made bigint, seen bigint, step bigint"
OUTPUT = f"key string, kind string, at bigint, {STATE}"


class CrawlState(StatefulProcessor):
    """Rows ``key, at, note, number`` of a key, in the order of ``at`` and ``number`` within a batch.

    Sends the key's state after every batch that has rows of it, and a row of kind ``due`` when a timer says that it may
    be tried again.  ``seen`` counts its rows and ``made`` the attempts among them that were made; ``step`` rises with every
    row sent.  Rows without a time go.
    """

    def __init__(self, reopen: float = 30):
        self.reopen = int(reopen * DAY)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("crawl", STATE)

    def _now(self) -> dict[str, Any]:
        names = [x.split()[0] for x in STATE.split(", ")]
        found = self.state.get()
        return dict(zip(names, found if found is not None else (0, 0, "", -1, 0, 0, 0), strict=True))

    def _tried(self, s: dict[str, Any], at: int, note: str) -> None:
        s["seen"] += 1
        if s["attempts"] >= values.MOST_ATTEMPTS and at - s["lastTried"] > self.reopen:
            s["attempts"] = values.MOST_ATTEMPTS - 1
        if s["attempts"] >= values.MOST_ATTEMPTS or s["retryAfter"] > at:
            return
        more = s["attempts"] + 1
        if note == values.CHALLENGED:
            s["retryAfter"] = at + values.CHALLENGE_MINUTES * MINUTE
        else:
            s["attempts"] = values.MOST_ATTEMPTS if note == values.SILENT else more
            if note in values.MISSED:
                s["retryAfter"] = at + more * values.RETRY_MINUTES * MINUTE
        s["note"], s["lastTried"] = note, at
        s["made"] += 1

    def _sent(self, key: Any, kind: str, at: int, s: dict[str, Any]) -> Row:
        s["step"] += 1
        self.state.update(tuple(s.values()))
        return Row(key=key[0], kind=kind, at=at, **s)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        s, at = self._now(), -1
        for at, _, note in sorted((int(r.at_ms), r.number, r.note or "") for r in rows if r.at_ms is not None):
            self._tried(s, at, note)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        opens = s["lastTried"] + self.reopen + 1 if s["attempts"] >= values.MOST_ATTEMPTS else s["retryAfter"]
        if opens > at and opens > timerValues.getCurrentWatermarkInMs():
            self.handle.registerTimer(opens)
        yield self._sent(key, "state", at, s)

    def handleExpiredTimer(self, key: Any, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        s, at = self._now(), expiredTimerInfo.getExpiryTimeInMs()
        if s["attempts"] >= values.MOST_ATTEMPTS:
            s["attempts"] = values.MOST_ATTEMPTS - 1
        yield self._sent(key, "due", at, s)

    def close(self) -> None:
        """Nothing is held beyond the state store."""


@contextmanager
def _state_store(spark: SparkSession):
    """Timers and value state need the RocksDB store; the session's own choice comes back afterwards."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def crawl_states(attempts: DataFrame, late: str = "0 seconds", reopen: float = 30) -> DataFrame:
    """The stream of states (``OUTPUT``) of ``attempts(key, at, note, number)``, where ``at`` is a time; other columns are dropped.

    Attempts that come ``late`` behind the newest time are dropped, as timers may have passed them.
    """
    rows = attempts.select("key", "at", "note", "number", F.unix_millis("at").alias("at_ms")).withWatermark("at", late)
    return rows.groupBy("key").transformWithState(CrawlState(reopen), OUTPUT, "Update", "EventTime")


def replay(attempts: DataFrame, out: str, checkpoint: str, late: str = "0 seconds", reopen: float = 30) -> StreamingQuery:
    """Runs what is there of the stream and ends; the states go to Parquet under ``out``, a folder for each batch, so that a batch that is repeated replaces its own."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    with _state_store(attempts.sparkSession):
        query = crawl_states(attempts, late, reopen).writeStream.outputMode("update").foreachBatch(write)
        query = query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    return query


def latest_states(spark: SparkSession, out: str, kind: str | None = None) -> DataFrame:
    """The last state of each key that a replay has written; of a ``kind`` only, if one is named."""
    schema = f"{OUTPUT}, batch int"
    fields = [x.split()[0] for x in STATE.split(", ")]
    rows = spark.read.schema(schema).parquet(out)
    rows = rows.filter(F.col("kind") == kind) if kind else rows
    return rows.groupBy("key").agg(F.max_by(F.struct(*fields), "step").alias("x")).select("key", "x.*")
