"""Crawl state by key over a stream: the rules of single attempts, timers, restarts."""

import datetime as dt

from pyspark.sql import functions as F

from rookery.functions import values
from rookery.operators import schedule
from rookery.streaming import crawl

KIND = "key string, at timestamp, note string, number bigint, state string"
START = dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc)


def at(days):
    return START + dt.timedelta(days=days)


def ms(days):
    return int(at(days).timestamp() * 1000)


def replayed(spark, folder, parts, **options):
    for n, rows in enumerate(parts):
        spark.createDataFrame([(*r, "clash") for r in rows], KIND).coalesce(1).write.parquet(f"{folder}/in/part={n}")
        stream = spark.readStream.schema(KIND).parquet(f"{folder}/in/part=*")
        crawl.replay(stream, f"{folder}/out", f"{folder}/check", **options)
    return spark.read.schema(f"{crawl.OUTPUT}, batch int").parquet(f"{folder}/out")


def test_states_timers_and_restart(spark, tmp_path):
    parts = [
        [("quiet", at(0), values.SILENT, 1), ("wait", at(0), "unreachable", 2), ("wait", at(0.001), "unreachable", 3), (None, at(0), "homepage", 4)],
        # beyond the wait of the second, and the 30 days of the first
        [("other", at(40), None, 5), ("other", None, "homepage", 6), ("wait", at(40), values.CHALLENGED, 7)],
        [("quiet", at(41), "homepage", 8), ("quiet", at(41), "homepage", 9), ("late", at(1), "homepage", 10)],
    ]
    rows = replayed(spark, tmp_path, parts).collect()
    due = {(r.key, r.at, r.attempts) for r in rows if r.kind == "due"}
    assert due == {("quiet", ms(30) + 1, 3), ("wait", ms(40.25), 1)}
    last = {r.key: r for r in crawl.latest_states(spark, f"{tmp_path}/out").collect()}
    assert (last["quiet"].attempts, last["quiet"].made, last["quiet"].seen) == (4, 2, 3)
    assert (last["wait"].attempts, last["wait"].retryAfter, last["wait"].made, last["wait"].seen) == (1, ms(40) + 360 * 60_000, 2, 3)
    assert (last["other"].attempts, last["other"].note) == (1, "")
    assert "late" not in last and last[None].attempts == 1


def test_one_attempt_equals_the_column_rule(spark):
    notes = [*values.MISSED, values.CHALLENGED, values.SILENT, "homepage", ""]
    rows = [(a, n) for a in range(4) for n in notes]
    after = schedule.after_attempt(F.col("a"), F.col("n"), F.lit(1000)).alias("x")
    want = spark.createDataFrame(rows, "a int, n string").select("a", "n", after).collect()
    for r in want:
        s = {"attempts": r.a, "retryAfter": 0, "note": "", "lastTried": -1, "made": 0, "seen": 0, "step": 0}
        crawl.CrawlState()._tried(s, 1000, r.n)
        assert (s["attempts"], s["retryAfter"]) == (r.x.attempts, r.x.retryAfter or 0), r
