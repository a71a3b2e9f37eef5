"""Benchmark passages in documents: q-gram lemma filtering, then banded alignment.

Texts are compared as code points with A-Z lower-cased and runs of white space as one space.  An item of ``m`` characters is
found where some part of a document is within ``e = rate * m`` edits of it.  By the q-gram lemma such a part shares at
least ``m - q + 1 - q * e`` q-grams with the item, and all of them lie within a band of ``e + 1`` diagonals.  So:

1.  a table of the items' q-grams tells which places of a document have one (a bit table first, then a sorted array).  The
    length q is 8, and less for items so short that the lemma would say nothing at 8: the longest with ``q * (e + 1) <= m``;
2.  every shared q-gram votes for its diagonal in two tilings of bands of ``2 (e + 1)`` diagonals that overlap by half, so
    that each run of ``e + 1`` diagonals lies in a band; bands with too few votes are dropped (votes are added up in
    a small hashed table first, whose sums are never too low, then exactly);
3.  the rest is verified by a dynamic programme over the band's diagonals that allows any start and end in the document.

Documents are never shuffled.  Items lie in the shared folder in blocks of bounded size, which the tasks read from there; each
block goes against all documents in a pass of its own, so a benchmark of ``BLOCK_CHARS`` characters takes one.  Votes are
counted for a part of a text at a time, so that a text and an item of one repeated letter stay within bounds too.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .storage import bound_batches, open_folder, scratch

Q = 8
#: Characters of items that go to the tasks at once.
BLOCK_CHARS = 4_000_000
_TABLE_BITS = 22
_VOTE_BITS = 20
#: Places of a text that vote at once, and how many votes they may have (more only where one item's length of them has).
_SLOTS = 1 << 20
_VOTES = 4 << 20
_END = 0x110000  # matches no character


def normalised(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points as they are compared, and where each was in the text."""
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    low = np.where((raw >= 0x41) & (raw <= 0x5A), raw + np.uint32(0x20), raw)
    blank = (raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D))
    keep = ~blank
    keep[1:] |= blank[1:] & ~blank[:-1]
    low[blank] = 0x20
    at = np.flatnonzero(keep)
    return low[at], at


def _grams(x: np.ndarray, q: int) -> np.ndarray:
    n = max(len(x) - q + 1, 0)
    h = np.zeros(n, dtype=np.uint64)
    for i in range(q):
        h = W.join(h, x[i : i + n].astype(np.uint64))
    return h


def _edits(m: np.ndarray, rate: float) -> np.ndarray:
    return np.floor(m * rate + 1e-9).astype(np.int64)


class Items:
    """Q-gram index of some items that have one q."""

    def __init__(self, places: list[int], codes: list[np.ndarray], rate: float, q: int):
        self.places, self.codes, self.q = np.array(places), codes, q
        self.m = np.array([len(c) for c in self.codes], dtype=np.int64)
        self.e = _edits(self.m, rate)
        self.least = self.m - q + 1 - q * self.e
        self.wide = 2 * (self.e + 1)
        grams = [_grams(c, q) for c in self.codes]
        gram = np.concatenate([np.zeros(0, dtype=np.uint64), *grams])
        sizes = np.array([len(g) for g in grams], dtype=np.int64)
        item, place = np.repeat(np.arange(len(codes)), sizes), W.ragged_arange(np.zeros(len(grams), dtype=np.int64), sizes)
        order = np.argsort(gram, kind="stable")
        self.item, self.place = item[order], place[order]
        self.gram, self.first = np.unique(gram[order], return_index=True)
        self.first = np.append(self.first, len(gram))
        self.table = np.zeros(1 << _TABLE_BITS, dtype=bool)
        self.table[(self.gram >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)] = True
        self.reach = int(self.m.max(initial=0))

    def shared(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of ``x`` with a q-gram of the items, and which."""
        g = _grams(x, self.q)
        at = np.flatnonzero(self.table[(g >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)])
        found = np.minimum(np.searchsorted(self.gram, g[at]), len(self.gram) - 1)
        hit = self.gram[found] == g[at]
        return at[hit], found[hit]

    def parts(self, at: np.ndarray, found: np.ndarray, n: int) -> Iterator[tuple[int, int]]:
        """Parts of the places ``0 .. n`` that vote at once."""
        votes = np.concatenate([[0], np.cumsum(self.first[found + 1] - self.first[found])])
        low = 0
        while low < n:
            i = int(np.searchsorted(at, low))
            most = int(np.searchsorted(votes, votes[i] + _VOTES, side="right")) - 1  # hits up to here are few enough
            high = int(at[most]) if most < len(at) else n
            high = min(max(high, low + 4 * self.reach + int(self.wide.max())), low + _SLOTS, n)
            yield low, high
            low = high

    def bands(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Items and first diagonals of the bands of ``x`` with enough votes."""
        items, diagonals = [], []
        hits, grams = self.shared(x)
        for low, high in self.parts(hits, grams, len(x)):  # bands across parts are met by the overlap
            a, b = np.searchsorted(hits, [low - self.reach - int(self.wide.max()), high + self.reach])
            at, found = hits[a:b], grams[a:b]
            sizes = self.first[found + 1] - self.first[found]
            each = W.ragged_arange(self.first[found], sizes)
            item, diagonal = self.item[each], np.repeat(at, sizes) - self.place[each]
            for shift in (0, 1):
                half = self.wide[item] // 2
                band = (diagonal + self.reach + 2 * half + shift * half) // self.wide[item]
                key = W.mix(band.astype(np.uint64) * np.uint64(len(self.m)) + item.astype(np.uint64))
                slot = (key >> np.uint64(64 - _VOTE_BITS)).astype(np.int64)
                maybe = np.bincount(slot, minlength=1 << _VOTE_BITS)[slot] >= self.least[item] if len(slot) else np.zeros(0, dtype=bool)
                span = len(x) + 8 * (self.reach + 1)  # more than the highest band
                pairs, count = np.unique(item[maybe] * span + band[maybe], return_counts=True)
                pairs = pairs[count >= self.least[pairs // span]]
                i, b = pairs // span, pairs % span
                items.append(i)
                diagonals.append(b * self.wide[i] - self.reach - self.wide[i] - shift * (self.wide[i] // 2))
        if not items:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        both = np.unique(np.stack([np.concatenate(items), np.concatenate(diagonals)]), axis=1)
        return both[0], both[1]


def aligned(
    item: np.ndarray,
    x: np.ndarray,
    low: np.ndarray,
    first: np.ndarray,
    stop: np.ndarray,
    width: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fewest edits, begin and end in ``x`` of the item on diagonals ``low .. low + width`` within ``first .. stop``, for many bands.

    A value holds edits and the start of the best path, so that one minimum decides on both.
    """
    m, unit = len(item), 1 << 40
    place = low[:, None] + np.arange(m + width + 1)
    region = np.where((place >= first[:, None]) & (place < stop[:, None]), x[np.clip(place, 0, len(x) - 1)], _END)
    step = np.arange(width + 1, dtype=np.int64) * unit
    value = np.tile(np.arange(width + 1, dtype=np.int64), (len(low), 1))
    for i in range(m):
        cost = value + (region[:, i : i + width + 1] != item[i]) * unit
        cost[:, :-1] = np.minimum(cost[:, :-1], value[:, 1:] + unit)  # a character of the item is missing
        value = np.minimum.accumulate(cost - step, axis=1) + step  # characters of the text too many
    best = value.argmin(axis=1)
    edits, start = np.divmod(value[np.arange(len(low)), best], unit)
    return edits, np.clip(low + start, first, stop), np.clip(low + m + best, first, stop)


@lru_cache(maxsize=2)
def _index(uri: str, block: int, rate: float) -> tuple[list[int | None], list[Items]]:
    """The ids of a block of items, and their indexes by q."""
    fs, root = open_folder(uri)
    rows = pq.read_table(f"{root}/block={block}", filesystem=fs, partitioning=None).to_pylist()
    rows.sort(key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"]))
    codes = [normalised(r["text"].strip(" \t\n\v\f\r"))[0] for r in rows]
    m = np.array([len(c) for c in codes], dtype=np.int64)
    q = np.minimum(m // (_edits(m, rate) + 1), Q)
    parts = [Items(own.tolist(), [codes[i] for i in own], rate, int(k)) for k in np.unique(q) if k for own in [np.flatnonzero(q == k)]]
    return [r["item_id"] for r in rows], parts


def _verified(index: Items, x: np.ndarray, edge: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
    """Row, item, edits, begin and end in the row of every band of ``x`` that holds its item; rows end before a gap."""
    item, diagonal = index.bands(x)
    first, last = (
        np.searchsorted(edge, np.maximum(v, 0), side="right") - 1 for v in (diagonal, diagonal + index.m[item] + index.wide[item])
    )
    n = np.minimum(last, len(edge) - 2) - first + 1  # a band may touch several documents
    row = W.ragged_arange(first, n)
    item, diagonal = np.repeat(item, n), np.repeat(diagonal, n)
    for i in np.unique(item).tolist():
        own = np.flatnonzero(item == i)
        width = int(index.wide[i])
        at_once = max(1, (1 << 20) // (len(index.codes[i]) + width))
        for low in range(0, len(own), at_once):
            some = own[low : low + at_once]
            begin, stop = edge[row[some]], edge[row[some] + 1] - 1
            edits, a, b = aligned(index.codes[i], x, diagonal[some], begin, stop, width)
            for k in np.flatnonzero(edits <= index.e[i]).tolist():
                yield int(row[some[k]]), i, int(edits[k]), int(a[k] - begin[k]), int(b[k] - begin[k])


def _search(uri: str, block: int, rate: float, best_only: bool):
    """best_only: of the parts found for a document and an item only the one with the fewest edits, and of those the first."""
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("begin", pa.int64()), ("end", pa.int64()), ("edits", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gap = np.full(1, _END, dtype=np.uint32)
        ids, indexes = _index(uri, block, rate)
        for batch in batches:
            for c in W.chunks(batch.column("text")):
                codes, places = [], []
                for a, b in zip(c.at[:-1].tolist(), c.at[1:].tolist(), strict=True):
                    x, at = normalised(c.buf[a:b].tobytes().decode("utf-8", "replace"))
                    codes += [x, gap]
                    places.append(at)
                edge = np.cumsum([0, *(len(p) + 1 for p in places)])
                x = np.concatenate(codes)
                best: dict[tuple[int, ...], tuple[int, int, int]] = {}
                for index in indexes:
                    for row, i, *got in _verified(index, x, edge):
                        key = (row, int(index.places[i]), *([] if best_only else [got[1]]))
                        best[key] = min(best.get(key, tuple(got)), tuple(got))
                rows = []
                for (row, i, *_), (edits, begin, stop) in sorted(best.items()):
                    at = places[row]
                    first = int(at[begin]) if begin < len(at) else 0
                    end = int(at[stop - 1]) + 1 if stop > begin else first
                    rows.append((batch.column("doc_id")[c.row0 + row].as_py(), ids[i], first, end, edits))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v, t.type) for v, t in zip(zip(*rows, strict=True), schema, strict=True)],
                        schema=schema,
                    )

    return run, "doc_id long, item_id long, begin long, end long, edits int"


def matches(docs: DataFrame, benchmark: DataFrame, rate: float = 0.1, best_only: bool = False) -> DataFrame:
    """``doc_id, item_id, begin, end, edits``: parts of documents within ``rate`` edits a character of a benchmark item.

    ``begin`` and ``end`` count characters of the original text.  Null and empty texts match nothing, and nothing matches
    items that are null, empty or white.  A part may be reported for several starts; with ``best_only`` a document and an
    item have one row.  Repeated documents are searched each, repeated items once.  Other columns are dropped.  Empty
    tables give an empty table.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"),
        "text",
    ).filter(F.col("text").rlike(r"[^\x20\x09-\x0D]")).distinct()
    total = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    blocks = -(-total // BLOCK_CHARS)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = spark.createDataFrame([], "doc_id long, item_id long, begin long, end long, edits int")
    if not blocks:
        return out
    uri = scratch(spark, "items")
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).cast("int"))
    dealt.repartition(blocks, "block").write.partitionBy("block").parquet(uri)
    for block in sorted(r.block for r in dealt.select("block").distinct().collect()):  # numbers of blocks
        out = out.unionByName(rows.mapInArrow(*_search(uri, block, rate, best_only)))
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = 0.1) -> DataFrame:
    """One row for each document and item that it has: ``doc_id, item_id, edits`` (the fewest), ``begin, end`` (of those)."""
    best = F.min(F.struct("edits", "begin", "end")).alias("x")
    return matches(docs, benchmark, rate, best_only=True).groupBy("doc_id", "item_id").agg(best).select(
        "doc_id",
        "item_id",
        "x.edits",
        "x.begin",
        "x.end",
    )
