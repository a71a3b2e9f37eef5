"""Periodic runs against every stretch tried one by one."""

import hashlib
import random
import re
from fractions import Fraction
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from rookery.llm import periodic_runs as P
from rookery.llm.queries import QUERIES


def brute(w):
    """All runs: for each period the maximal stretches, and of equal stretches the smallest period."""
    best = {}
    for q in range(1, len(w) // P.FOLD + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(P.LEAST, P.FOLD * q):
                best.setdefault((i, length), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in best.items()), key=lambda x: (x[0], x[2]))


def texts(seed):
    r = random.Random(seed)
    yield []
    yield ["a"] * r.randint(1, 40)
    yield ["a", "b"] * r.randint(1, 30)
    for _ in range(60):
        letters = "abc"[: r.randint(1, 3)]
        yield [r.choice(letters) for _ in range(r.randint(0, 80))]
    for _ in range(30):
        unit = [r.choice("abcde") for _ in range(r.randint(1, 9))]
        head = [r.choice("abcde") for _ in range(r.randint(0, 20))]
        yield head + unit * r.randint(2, 9) + unit[: r.randint(0, len(unit))] + head[: r.randint(0, 20)] + unit * r.randint(0, 6)


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_all_stretches(seed):
    all_texts = list(texts(seed))
    flat = [x for w in all_texts for x in w]
    codes = np.array([ord(x) for x in flat], dtype=np.int64)
    first = np.cumsum([0, *map(len, all_texts)])
    start, length, period = P.find_runs(codes, first)
    got = list(zip(start.tolist(), length.tolist(), period.tolist()))
    want = [(int(first[i]) + s, n, q) for i, w in enumerate(all_texts) for s, n, q in brute(w)]
    assert got == want


def test_one_word_many_times_is_found_in_little_time():
    n = 200_000
    start, length, period = P.find_runs(np.zeros(n, dtype=np.int64), np.array([0, n]))
    assert (start.tolist(), length.tolist(), period.tolist()) == ([0], [n], [1])


def plain_row(doc_id, text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    n = len(w)
    if doc_id is not None and n:
        h = crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
    said = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    numbers = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *numbers, hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


FIELDS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_query_equals_plain_rows(spark, tmp_path):
    r = random.Random(5)
    rows = [(None, "a a a a a a a"), (None, None), (1, None), (2, ""), (3, " \t\n"), (4, "x"), (7, "la " * 5000), (7, "la " * 5000)]
    rows += [(i, " ".join(r.choice(["ä", "b", " ", "dd", "e\x00"]) for _ in range(r.randint(0, 90))) + "\n") for i in range(100, 400)]
    rows += [(i, " \x0b".join(w)) for i, w in enumerate(texts(9), 1000)]
    docs = spark.createDataFrame([(*x, 1, "clash") for x in rows], "doc_id long, text string, runs int, collapsed string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(x[c] for c in FIELDS) for x in QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()]
    key = lambda x: [(v is None, v or 0) for v in x[:6]] + list(x[6:])
    assert sorted(got, key=key) == sorted((plain_row(*x) for x in rows), key=key)


def test_empty_table_and_collapsed_text(spark):
    empty = spark.createDataFrame([], "doc_id int, text string")
    assert P.periodic_runs(empty).collect() == []
    docs = spark.createDataFrame([(1, "so la la la la la la end"), (2, "a b a b a b a b a")], "doc_id long, text string")
    got = {x.doc_id: (x.collapsed, [tuple(y) for y in x.runs]) for x in P.periodic_runs(docs).collect()}
    assert got == {1: ("so la end", [(1, 6, 1)]), 2: ("a b", [(0, 9, 2)])}
    assert P.periodic_runs(docs).select(F.max("n_words")).first()[0] == 9
