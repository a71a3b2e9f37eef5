"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

How many pieces there are of each length is a table of at most ``capacity`` rows.  The plan is made on it, for whole
classes of equal sequences at a time, so that planning costs the same for a thousand documents or a billion:

*   pieces above a third of the capacity go at most twice into a sequence: from the longest down, each is matched with
    the longest other one that still fits (greedy matching);
*   the others go, from the longest down, into the sequence whose gap they fit best; when none has room, into new ones.

The plan is a table of slots: the pieces of one length ranked ``from .. from + count`` go to consecutive sequences at
one offset.  Ranks within a length come from counts by length and shard, summed over shards, and from row numbers within
a shard.  Pieces are dealt to shards in turn when they are written, so a length that a third of all pieces share is split
over all shards, whatever their ids are.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .storage import bound_batches, cut
from .tokens import CHUNK_BYTES, binary_rows, row_tokens

Slot = tuple[int, int, int, int, int]  # length, first rank, count, first sequence, offset


def plan(counts: dict[int, int], capacity: int) -> list[Slot]:
    """Slots for ``counts`` pieces by length.  Best fit, longest first, with long pieces matched in pairs before."""
    left = {n: c for n, c in counts.items() if c}
    if any(n < 1 or n > capacity for n in left):
        raise ValueError("lengths must be from 1 to the capacity")
    groups: list[tuple[tuple[int, ...], int]] = []  # lengths in equal sequences, how many of them
    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        n = large[-1]
        if not left[n]:
            large.pop()
            continue
        # the longest partner that fits, which may be as long itself
        i = bisect_left(large, capacity - n + 1) - 1
        while i >= 0 and (not left[large[i]] or (large[i] == n and left[n] < 2)):
            i -= 1
        if i < 0:
            groups.append(((n,), left[n]))
            left[n] = 0
        else:
            other = large[i]
            times = left[n] // 2 if other == n else min(left[n], left[other])
            groups.append(((n, other), times))
            left[n] -= times
            left[other] -= times
    gaps: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    sizes: list[int] = []

    def put(lengths: tuple[int, ...], times: int) -> None:
        gap = capacity - sum(lengths)
        if times:
            if gap not in gaps:
                gaps[gap] = []
                insort(sizes, gap)
            gaps[gap].append((lengths, times))

    for lengths, times in groups:
        put(lengths, times)
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        rest = left[n]
        while rest:
            i = bisect_left(sizes, n)
            if i == len(sizes):
                each = capacity // n
                put((n,) * each, rest // each)
                put((n,) * (rest % each), 1 if rest % each else 0)
                break
            gap = sizes[i]
            lengths, times = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], sizes[i]
            each = gap // n
            whole = min(times, rest // each)
            put(lengths + (n,) * each, whole)
            rest -= whole * each
            times -= whole
            if times and rest < each:
                put(lengths + (n,) * rest, 1)
                times, rest = times - 1, 0
            put(lengths, times)
    slots: list[Slot] = []
    rank: dict[int, int] = {}
    sequence = 0
    for lengths, times in (x for gap in sizes for x in gaps[gap]):
        offset = 0
        for n in lengths:
            slots.append((n, rank.get(n, 0), times, sequence, offset))
            rank[n] = rank.get(n, 0) + times
            offset += n
        sequence += times
    return slots


def _pieces(path: str, capacity: int, end: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in W.chunks(batch.column("text"), limit=CHUNK_BYTES):
                ids, at = row_tokens(path, c)
                n = np.diff(at) + 1
                data = np.full(int(n.sum()), end, dtype="<u4")  # each document, then the end id
                begin = np.cumsum(n) - n
                data[W.ragged_arange(begin, n - 1)] = ids
                pieces = -(-n // capacity)
                row = np.repeat(np.arange(len(n)), pieces)
                piece = W.ragged_arange(np.zeros(len(n), dtype=np.int64), pieces)
                start = piece * capacity
                length = np.minimum(n[row] - start, capacity)
                offsets = np.append(begin[row] + start, len(data))
                raw = data.tobytes()
                crc = [crc32(raw[4 * a : 4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                doc = batch.column("doc_id").take(pa.array(row + c.row0))
                out = {
                    "doc_id": doc,
                    "piece": pa.array(piece.astype(np.int32)),
                    "start": pa.array(start),
                    "length": pa.array(length),
                    "ids_crc32": pa.array(crc, pa.int64()),
                }
                yield pa.RecordBatch.from_pydict(out | ({"ids": binary_rows(data, offsets)} if keep_ids else {}))

    return run, "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if keep_ids else "")


def tokenised_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end: int = 0, keep_ids: bool = True) -> DataFrame:
    """Pieces of at most ``capacity`` ids of each ``docs(doc_id, text)``: its ids, then ``end``.

    Null and empty texts give one piece with the end id alone.  ``ids`` are little-endian unsigned 32-bit.  Null and repeated
    ids are cut like others; other columns are dropped.
    """
    bound_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(*_pieces(tokenizer, capacity, end, keep_ids))


def best_fit(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, which replace columns of these names.

    Needs ``doc_id, piece, start, length``.  Repeated rows are packed as often as they are there.  An empty table gives an
    empty table.
    """
    spark = pieces.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset")]
    own = F.struct(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names))).alias("own")  # so that no name clashes
    turn = F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int").alias("shard")
    dealt = cut(pieces.select("doc_id", "piece", "start", "length", turn, own), "pieces")
    counts = dealt.groupBy("length", "shard").agg(F.count("*").alias("here"))
    before = counts.select(
        "length",
        "shard",
        (F.sum("here").over(Window.partitionBy("length").orderBy("shard")) - F.col("here")).alias("before"),
    )
    total = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("here").alias("n")).collect()}  # at most capacity rows
    slots = sorted(plan(total, capacity))
    table = np.array(slots, dtype=np.int64).reshape(-1, 5)
    key = table[:, 0] * (1 << 44) + table[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = np.asarray(batch.column("length")), np.asarray(batch.column("rank"))
            slot = np.searchsorted(key, length * (1 << 44) + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("own"), pa.array(table[slot, 3] + rank - table[slot, 1]), pa.array(table[slot, 4])],
                names=["own", "sequence_id", "offset"],
            )

    number = F.row_number().over(Window.partitionBy("length", "shard").orderBy("doc_id", "piece", "start"))
    ranked = dealt.withColumn("number", number).join(before, ["length", "shard"])
    ranked = ranked.select("own", F.col("length").cast("long").alias("length"), (F.col("before") + F.col("number") - 1).alias("rank"))
    placed = ranked.mapInArrow(place, f"own {dealt.schema['own'].dataType.simpleString()}, sequence_id long, offset long")
    return placed.select(*(F.col(f"own.c{i}").alias(c) for i, c in enumerate(names)), "sequence_id", "offset")


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end: int = 0, keep_ids: bool = True) -> DataFrame:
    """Tokenises, cuts and packs ``docs(doc_id, text)``; see ``tokenised_pieces`` and ``best_fit``."""
    return best_fit(tokenised_pieces(docs, tokenizer, capacity, end, keep_ids), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids, doc_ids``: the token ids of each sequence, bounded by the capacity."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id")))
    joined = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    ids = F.aggregate("parts", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"]))
    return joined.select("sequence_id", ids.alias("ids"), F.col("parts.doc_id").alias("doc_ids"))
