"""Nearest vectors by cosine: randomly rotated one-bit codes choose, exact scores decide.

Each vector is divided by its length, rotated at random into ``bits`` dimensions and reduced to the signs of its
coordinates, packed into bits, with one scalar: the inner product of the vector with its own sign vector.  The inner product
of a query with the sign vector, divided by that scalar, estimates the cosine without bias, and its error is that of one
coordinate of a random unit vector times ``sqrt(1 - scalar^2) / scalar``.  A vector is scored exactly if its estimate plus
``spread`` standard errors reaches the k-th best exact score so far; with a spread of 4 a neighbour is passed over with a
chance of 3e-5.  More bits than dimensions make errors smaller.

Queries lie in a table in the shared folder.  A task takes a slab of ``SLAB`` values of indexed vectors, reads the queries
in blocks, and sends the k best of its slab for each query; Spark merges these.  No row of pairs and no code is
shuffled.  A task holds one slab, one block of queries and one matrix of ``CELLS`` estimates.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import bound_batches, cut, open_folder

#: Values (vectors times dimensions) of a slab, estimates of a matrix, queries of a block.
SLAB = 8 << 20
CELLS = 4 << 20
QUERIES = 1024
_SEED = 20240117


@cache
def rotation(dims: int, bits: int) -> np.ndarray:
    """``dims`` random orthonormal rows of ``bits`` coordinates, the same in every task."""
    random = np.random.default_rng((_SEED, dims, bits)).standard_normal((bits, dims))
    return np.linalg.qr(random)[0].T


def _code_bits(dims: int, bits: int) -> int:
    return 64 * -(-max(dims, bits) // 64)


def vectors_by_length(ids: pa.Array, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length of vectors: their places in the column, ids, and a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column, ids = column.combine_chunks(), ids.combine_chunks()
    at = np.asarray(column.offsets).astype(np.int64)
    flat = np.asarray(column.values).astype(np.float64)
    size = np.diff(at)
    ids = np.asarray(ids).astype(np.int64)
    for n in np.unique(size).tolist():
        rows = np.flatnonzero(size == n)
        yield rows, ids[rows], flat[at[rows][:, None] + np.arange(n)]


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two, so that squares neither overflow nor vanish; cosines stay exactly as they are."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def _unit(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _encode(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes: list[bytes] = [b""] * len(batch)
            scalar = np.zeros(len(batch))
            for rows, _, x in vectors_by_length(batch.column("vec_id"), batch.column("vector")):
                width = _code_bits(x.shape[1], bits)
                turned = _unit(x) @ rotation(x.shape[1], width)
                packed = np.packbits(turned > 0, axis=1)
                scalar[rows] = np.abs(turned).sum(axis=1) / np.sqrt(width)
                for i, code in zip(rows.tolist(), packed, strict=True):
                    codes[i] = code.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("vector"), batch.column("query"), pa.array(codes, pa.binary()), pa.array(scalar)],
                ["vec_id", "vector", "query", "code", "scalar"],
            )

    return run


def index(vectors: DataFrame, is_query: Column, bits: int = 256) -> DataFrame:
    """``vec_id, vector, query, code, scalar``: a code for every vector that takes part, one for each id.

    Rows without an id, and vectors that are null, empty, all zero or hold null or non-finite components take no part.  Of
    several vectors of one id the smallest takes part.
    """
    spark = vectors.sparkSession
    bound_batches(spark)
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("vector"),
        F.coalesce(is_query, F.lit(False)).alias("query"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
    several = cut(rows.groupBy("vec_id").count().filter("count > 1").select("vec_id"), "several")
    if not several.isEmpty():
        one = rows.join(several, "vec_id", "left_semi").groupBy("vec_id").agg(F.min("vector").alias("vector"), F.max("query").alias("query"))
        rows = rows.join(several, "vec_id", "left_anti").unionByName(one)
    kind = rows.schema["vector"].dataType.simpleString()
    return rows.mapInArrow(_encode(bits), f"vec_id long, vector {kind}, query boolean, code binary, scalar double")


def _first_copies(x: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the vectors, but of equal ones only those with the ``most`` smallest ids: no others can be among the best."""
    rows = np.ascontiguousarray(x).view(np.uint64)
    factors = np.random.default_rng(_SEED).integers(1, 1 << 63, rows.shape[1], dtype=np.uint64) | np.uint64(1)
    key = (rows * factors).sum(axis=1, dtype=np.uint64)
    order = np.lexsort((ids, key))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (rows[order[1:]] != rows[order[:-1]]).any(axis=1)
    first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return np.sort(order[np.arange(len(order)) - first < most])


class Best:
    """The k best of the candidates seen so far, for each query of a block."""

    def __init__(self, queries: int, k: int):
        self.query = np.zeros(0, dtype=np.int64)
        self.score, self.id = np.zeros(0), np.zeros(0, dtype=np.int64)
        self.least = np.full(queries, -np.inf)  # the k-th best score, once there are k
        self.k = k

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        query, score, ids = np.append(self.query, query), np.append(self.score, score), np.append(self.id, ids)
        order = np.lexsort((ids, -score, query))
        query = query[order]
        place = np.arange(len(order)) - np.searchsorted(query, query)
        order, query = order[place < self.k], query[place < self.k]
        self.query, self.score, self.id = query, score[order], ids[order]
        full = place[place < self.k] == self.k - 1
        self.least[query[full]] = self.score[full]


def _cosines(x: np.ndarray, y: np.ndarray, xx: np.ndarray, yy: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Cosines of the pairs ``x[i], y[j]``, in double precision; a pair's value does not depend on its place."""
    out = np.empty(len(i))
    some = max(1, CELLS // x.shape[1])
    for a in range(0, len(i), some):
        s = slice(a, a + some)
        out[s] = (x[i[s]] * y[j[s]]).sum(axis=1) / np.sqrt(xx[i[s]] * yy[j[s]])
    return out


def _slab_best(ids, x, codes, scalar, query_ids, y, k: int, spread: float) -> Best:
    """The k best of a slab for each query of a block; an id is no neighbour of its own."""
    width, best = 8 * codes.shape[1], Best(len(y), k)
    x, y = _scaled(x), _scaled(y)
    xx, yy = (x * x).sum(axis=1), (y * y).sum(axis=1)
    turned = ((y / np.sqrt(yy)[:, None]) @ rotation(y.shape[1], width)).T.astype(np.float32) / np.float32(np.sqrt(width))
    error = spread * np.sqrt(np.maximum(0, 1 - scalar**2) / max(1, width - 1)) / scalar + 1e-5
    by_id = np.argsort(query_ids)
    some = max(1, CELLS // max(1, len(y)))
    for a in range(0, len(x), some):
        part = np.arange(a, min(a + some, len(x)))
        signs = np.unpackbits(codes[part], axis=1).astype(np.float32) * 2 - 1
        estimate = (signs @ turned) / scalar[part, None].astype(np.float32)
        own = np.minimum(np.searchsorted(query_ids, ids[part], sorter=by_id), len(y) - 1)
        same = np.flatnonzero(query_ids[by_id[own]] == ids[part])
        estimate[same, by_id[own[same]]] = -np.inf
        # the best by estimate first, so that the others have a score to reach
        top = np.argpartition(-estimate, min(k, len(part)) - 1, axis=0)[:k]
        i, j = top.ravel(), np.tile(np.arange(len(y)), len(top))
        real = estimate[i, j] > -np.inf
        i, j = i[real], j[real]
        best.add(j, _cosines(x, y, xx, yy, part[i], j), ids[part[i]])
        estimate[i, j] = -np.inf
        i, j = np.nonzero((estimate > -np.inf) & (estimate + error[part, None].astype(np.float32) >= best.least.astype(np.float32)))
        best.add(j, _cosines(x, y, xx, yy, part[i], j), ids[part[i]])
    return best


def _query_blocks(uri: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    fs, root = open_folder(uri)
    for f in sorted(fs.get_file_info(pafs.FileSelector(root)), key=lambda f: f.base_name):
        if f.is_file and f.base_name.endswith(".parquet"):
            with fs.open_input_file(f.path) as file:
                for batch in pq.ParquetFile(file).iter_batches(batch_size=QUERIES):
                    for _, ids, y in vectors_by_length(batch.column("vec_id"), batch.column("vector")):
                        yield ids, y


def _search(uri: str, k: int, spread: float):
    def slabs(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        """Parts of each length of vectors, of ``SLAB`` values each: ids, vectors, codes, scalars."""
        waiting: dict[int, list] = {}
        for batch in batches:
            code, scalar = batch.column("code").to_pylist(), np.asarray(batch.column("scalar"))
            for rows, ids, x in vectors_by_length(batch.column("vec_id"), batch.column("vector")):
                packed = np.frombuffer(b"".join(code[i] for i in rows.tolist()), dtype=np.uint8).reshape(len(rows), -1)
                parts = waiting.setdefault(x.shape[1], [])
                parts.append((ids, x, packed, scalar[rows]))
                if sum(p[1].size for p in parts) >= SLAB:
                    yield waiting.pop(x.shape[1])
        yield from waiting.values()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in slabs(batches):
            ids, x, codes, scalar = (np.concatenate(p) for p in zip(*parts, strict=True))
            rows = _first_copies(x, ids, k + 1)
            ids, x, codes, scalar = ids[rows], x[rows], codes[rows], scalar[rows]
            for query_ids, y in _query_blocks(uri):
                if y.shape[1] == x.shape[1]:
                    best = _slab_best(ids, x, codes, scalar, query_ids, y, k, spread)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(query_ids[best.query]), pa.array(best.id), pa.array(best.score)],
                        ["query_id", "vec_id", "score"],
                    )

    return run


def search(indexed: DataFrame, k: int = 5, spread: float = 4.0) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest of all indexed vectors to each query; ``indexed`` should be a written table.

    Nearest first, ties to the smaller id.  A vector is no neighbour of its own, nor of vectors of another length; a query
    with fewer than ``k`` candidates has them all, one without candidates has no row.
    """
    queries = cut(indexed.filter("query").select("vec_id", "vector"), "vectors")
    found = indexed.select("vec_id", "vector", "code", "scalar").mapInArrow(
        _search(queries._rookery_path, k, spread), "query_id long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, bits: int = 256, spread: float = 4.0) -> DataFrame:
    """Indexes ``vectors(vec_id, vector)`` and searches it for the rows that ``is_query`` chooses; other columns are dropped.

    An empty table, or one without queries, gives an empty result.
    """
    return search(cut(index(vectors, is_query, bits), "codes"), k, spread)
