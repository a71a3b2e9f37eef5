"""The divergence audit against SQL and plain integers, over many sources, blocks and tiles."""

import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from rookery.llm import divergence
from rookery.llm.queries import QUERIES, SQL
from tests.oracle import plain

DOCS = "doc_id long, text string, lang string, source string, item string, rank int"


def asked(spark, folder, rows):
    spark.createDataFrame([(*x, "clash", 1) for x in rows], DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    return QUERIES["op13_source_divergence"](spark, str(folder)).toPandas()


def test_odd_documents_equal_sql(spark, tmp_path):
    r = random.Random(1)
    words = ["Über", "über", "a'b", "x1y", "naïve", "ÉTÉ", "b", "B", "z\x7fz", " q", "日本", "e", "f"]
    rows = [(i, " ".join(r.choices(words, k=r.randint(0, 12))), r.choice(["en", None, "xx"]), r.choice(["s", "t", None, "é", "u"])) for i in range(150)]
    rows += [(None, None, "en", "silent"), (7, "", "quiet", "a"), (8, None, "quiet", "b"), (9, "word word", "rare", "one"), (9, "word word", "rare", "one")]
    rows += [(10, "many " * 20_000, "en", "s")] * 3 + [(11, "hot cold", "en", "h")] * 40
    got = asked(spark, tmp_path, rows)
    db = duckdb.connect()
    db.sql(f"create view documents as from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert plain(got) == plain(db.sql(SQL["op13_source_divergence"]).df())
    quiet = got[got.lang == "quiet"]
    assert sorted(zip(quiet.source, quiet.part, quiet.item, quiet.value)) == [("a", "pair", "b", 0), ("b", "pair", "a", 0)]
    assert set(got[got.lang == "rare"].source) == set()  # one source: no pair, and no kept term


def test_empty_table(spark, tmp_path):
    assert len(asked(spark, tmp_path, [])) == 0


@pytest.mark.parametrize("tile, cells", [(512, 1 << 20), (3, 50)])
def test_tiles_and_blocks_equal_plain_integers(spark, monkeypatch, tile, cells):
    monkeypatch.setattr(divergence, "TILE", tile)
    monkeypatch.setattr(divergence, "CELLS", cells)
    r = random.Random(2)
    terms = [chr(97 + i) * j for i in range(20) for j in (1, 2, 3)]
    rows = [(i, " ".join(r.choices(terms[: 10 + 5 * (i % 10)], k=30)), "en", f"s{i % 10}") for i in range(200)]
    docs = spark.createDataFrame([(*x, "clash", 1) for x in rows], DOCS)
    got = divergence.audit(docs, least_docs=10, top=3, entries=40).collect()
    count, seen = defaultdict(Counter), Counter()
    for _, text, _, source in rows:
        count[source].update(text.split())
        seen.update(set(text.split()))
    kept = sorted(t for t in seen if seen[t] >= 10)
    everything = Counter({t: sum(c[t] for c in count.values()) for t in kept})

    def shares(c):
        n = sum(c[t] for t in kept)
        return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

    p, q = {s: shares(c) for s, c in count.items()}, shares(everything)
    f = lambda a, b: (a - b) ** 2 // (a + b)
    want = []
    for s in p:
        pair = sorted(((-sum(f(p[s][t], p[o][t]) for t in kept), o) for o in p if o != s))
        own = sorted((-f(p[s][t], q[t]), t) for t in kept if count[s][t] and p[s][t] > q[t])[:3]
        want += [("en", s, part, item, -v, i) for part, x in (("pair", pair), ("term", own)) for i, (v, item) in enumerate(x, 1)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_frequencies_of_large_counts_are_exact():
    r = random.Random(4)
    for _ in range(200):
        total = r.randint(1, 8 * 10**15)
        n, kept = r.randint(0, total), r.randint(1, 10**6)
        got = divergence.frequency(np.array([n]), np.array([total]), kept)
        assert got.tolist() == [1 + 10**9 * (n + 2) // (total + 2 * kept)]
