"""Nearest vectors against all pairs, with copies, ties, odd vectors and several lengths."""

import math
import random

import duckdb
import numpy as np
from pyspark.sql import functions as F

from rookery.llm import vector_search as V
from rookery.llm.queries import QUERIES, SQL
from tests.oracle import plain

KIND = "vec_id long, embedding array<float>, label int"


def asked(spark, folder, rows, kind=KIND):
    spark.createDataFrame(rows, kind).repartition(3).write.parquet(f"{folder}/embeddings.parquet")
    got = QUERIES["op11_nearest_vectors"](spark, str(folder)).toPandas()
    db = duckdb.connect()
    db.sql(f"create view embeddings as from read_parquet('{folder}/embeddings.parquet/*.parquet')")
    return got, db.sql(SQL["op11_nearest_vectors"]).df()


def test_odd_vectors_equal_sql(spark, tmp_path):
    r = random.Random(3)
    some = lambda n: [r.gauss(0, 1) for _ in range(n)]
    rows = [(i, some(16), 0) for i in range(400)]
    copy, nan, inf = some(16), float("nan"), float("inf")
    rows += [(i, copy, 1) for i in range(1000, 1300)]
    rows += [(i, [2.0 * x for x in copy], 1) for i in range(1300, 1310)]
    rows += [(2000, None, 0), (2001, [], 0), (2050, [0.0] * 16, 0), (2051, [nan] + copy[1:], 0), (2052, [inf] + copy[1:], 0), (2100, [None] + copy[1:], 0)]
    rows += [(None, copy, 0), (3000, some(3), 0), (3001, some(3), 0), (3050, some(7), 0)]  # 3050 has no neighbour
    rows += [(50, rows[50][1], 0), (1, rows[1][1], 0)]  # repeated rows
    got, want = asked(spark, tmp_path, rows)
    assert plain(got) == plain(want)
    near = got[got.query_id == 1000].sort_values("rank")
    assert near.vec_id.tolist() == [1001, 1002, 1003, 1004, 1005] and near.score.tolist() == [1.0] * 5
    assert 3050 not in set(got.query_id) and len(got[got.query_id == 3000]) == 1


def test_empty_table_and_doubles(spark, tmp_path):
    got, want = asked(spark, tmp_path, [])
    assert len(got) == len(want) == 0
    big = spark.createDataFrame([(0, [1e300, 1e300]), (1, [1e-300, 2e-300]), (2, [-1e300, 1e308])], "vec_id long, vector array<double>")
    back = V.nearest(big.withColumns({"code": F.lit(1), "query": F.lit("x"), "score": F.lit(2)}), F.col("vec_id") == 0, k=5).collect()
    assert [(x.rank, x.vec_id) for x in back] == [(1, 1), (2, 2)]
    assert math.isclose(back[0].score, 3 / math.sqrt(10))


def test_of_several_vectors_of_one_id_the_smallest_takes_part(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (1, [0.0, 1.0]), (1, [0.0, 1.0])]
    back = V.nearest(spark.createDataFrame(rows, "vec_id int, vector array<float>"), F.col("vec_id") == 0).collect()
    assert [(x.vec_id, x.score) for x in back] == [(1, 0.0)]


def test_estimates_are_within_their_bounds_and_recall_is_high(spark):
    random_ = np.random.default_rng(1)
    x = random_.standard_normal((3000, 64))
    turned = V._unit(x) @ V.rotation(64, 256)
    assert np.allclose(V.rotation(64, 256) @ V.rotation(64, 256).T, np.eye(64))
    scalar = np.abs(turned).sum(axis=1) / 16
    estimate = (np.sign(turned) / 16) @ turned[:50].T / scalar[:, None]
    error = np.abs(estimate - turned @ turned[:50].T) / (np.sqrt(1 - scalar**2) / scalar / np.sqrt(255))[:, None]
    assert (error > 4).mean() < 3e-4 and (error > 1).mean() > 0.1  # bounds hold and are not idle
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    table = spark.createDataFrame(rows, "vec_id long, vector array<double>").repartition(4)
    got = {(r.query_id, r.vec_id) for r in V.nearest(table, F.col("vec_id") % 50 == 0).collect()}
    u = x / np.linalg.norm(x, axis=1)[:, None]
    s = u[::50] @ u.T
    s[np.arange(60), np.arange(0, 3000, 50)] = -2
    want = {(50 * i, j) for i, row in enumerate(np.argsort(-s, axis=1)[:, :5].tolist()) for j in row}
    assert len(got) == len(want) and len(got & want) / len(want) >= 0.99


def test_several_slabs_and_blocks_give_the_same(spark, monkeypatch):
    r = np.random.default_rng(2)
    table = pa_table = [(i, v.tolist()) for i, v in enumerate(r.standard_normal((500, 8)))]
    whole, parts = V.Best(3, 5), V.Best(3, 5)
    x = np.array([v for _, v in pa_table])
    ids = np.arange(len(table))
    codes = np.packbits(V._unit(x) @ V.rotation(8, 64) > 0, axis=1)
    scalar = np.abs(V._unit(x) @ V.rotation(8, 64)).sum(axis=1) / 8
    whole = V._slab_best(ids, x, codes, scalar, ids[:3], x[:3], 5, 4.0)
    monkeypatch.setattr(V, "CELLS", 60)
    parts = V._slab_best(ids, x, codes, scalar, ids[:3], x[:3], 5, 4.0)
    assert whole.id.tolist() == parts.id.tolist() and whole.score.tolist() == parts.score.tolist()
