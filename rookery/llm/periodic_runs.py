"""Runs of repeated words within a text, found by divide and conquer on interned words (Main and Lorentz).

A run is a stretch of words with smallest period ``q``, at least ``max(LEAST, FOLD * q)`` long, that no neighbouring word
extends.  Each text is halved again and again.  A run that crosses the middle of a part, and the middle of no larger part,
lies in that part as a whole; it has a full period on one side of the middle, and the words that agree with those a
period further are counted by Z-functions of the two halves, read forwards and backwards.  What a neighbour beyond the
part still extends crosses the middle of a larger part and is found there; of equal stretches that with the smallest period
stays.

Z-functions cost a step of Python for each word and level, so the middles of all parts of a level are screened first with
numpy: a run needs ``length - q`` agreeing words around the middle, half of them on one side, and where no period has so
many there is no run.  The screen is a necessary condition and drops nothing.

Texts are handled where they are read, without a shuffle; a task holds a chunk of half a MB, or the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .storage import bound_batches

#: Fewest words of a run, and fewest periods.
LEAST = 6
FOLD = 4
#: Agreeing words that the screen looks for at each place, and places of a part that are then compared one by one.
_STEPS = 6
_PLACES = 16
#: Periods for which the screen counts all agreeing words.
_SMALL = 4
#: Up to this period a run holds no run of another period: two runs share less than the sum of their periods, so the
#: inner one's period is below a third of the outer one's, and its length below four thirds of it.
_ALONE = 5

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def z_function(s: list[int]) -> list[int]:
    """For each place the number of values that agree with those at the beginning; 0 at place 0."""
    n = len(s)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k > right - i:
                k = right - i
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def crossing(w: list[int], middle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``start, length, period`` of all repetitions of ``w`` with a full period beside ``middle``, long enough to be runs."""
    n, q = len(w), np.arange(1, len(w) // FOLD + 1)
    u, v = w[:middle], w[middle:]
    back = u[::-1]
    found = []
    # the period to the right of the middle: v against its own later places, and the words before both
    ahead = np.array([*z_function(v), 0])[q]
    behind = np.array(z_function([*back, -1, *w[::-1]]))[len(u) + 1 + len(v) - q]
    found.append((middle - behind, q + behind + ahead, q))
    # the period to the left
    behind = np.array([*z_function(back), 0])[q]
    ahead = np.array(z_function([*v, -1, *w]))[len(v) + 1 + len(u) - q]
    found.append((middle - q - behind, q + behind + ahead, q))
    start, length, period = (np.concatenate(x) for x in zip(*found, strict=True))
    enough = length >= np.maximum(LEAST, FOLD * period)
    return start[enough], length[enough], period[enough]


def _screened(codes: np.ndarray, low: np.ndarray, middle: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Numbers of the parts ``codes[low:high]`` whose middle a run may cross."""
    most = (high - low) // FOLD
    part = np.repeat(np.arange(len(low)), 2 * most)
    q = W.ragged_arange(np.ones(2 * len(low), dtype=np.int64), np.repeat(most, 2))
    right = np.repeat(np.tile([True, False], len(low)), np.repeat(most, 2))
    at = np.where(right, middle[part], middle[part] - q)
    half = (np.maximum(LEAST, FOLD * q) - q + 1) // 2
    hits = []
    for step in (1, -1):
        rows = np.arange(len(part))
        for t in range(_STEPS):
            x = at[rows] + (t if step > 0 else -1 - t)
            y = x + q[rows]
            inside = y < high[part[rows]] if step > 0 else x >= low[part[rows]]
            rows, x, y = rows[inside], x[inside], y[inside]
            rows = rows[codes[x] == codes[y]]
            done = half[rows] <= t + 1
            hits.append((rows[done], np.full(int(done.sum()), step)))
            rows = rows[~done]
        hits.append((rows, np.full(len(rows), step)))
    rows, step = (np.concatenate(x) for x in zip(*hits, strict=True))
    small = q[rows] <= _SMALL  # both sides of these are counted
    some = np.unique(rows[small])
    need, around = np.maximum(LEAST, FOLD * q[some]) - q[some], np.zeros(len(some), dtype=np.int64)
    for way in (1, -1):
        on = np.arange(len(some))
        for t in range(int(need.max(initial=0))):
            x = at[some[on]] + (t if way > 0 else -1 - t)
            y = x + q[some[on]]
            inside = (y < high[part[some[on]]]) & (x >= low[part[some[on]]])
            on, x, y = on[inside], x[inside], y[inside]
            on = on[codes[x] == codes[y]]
            around[on] += 1
    passed = ~small | np.isin(rows, some[around >= need])
    rows, step = rows[passed], step[passed]
    of_part, counts = np.unique(part[rows], return_counts=True)
    few = np.isin(part[rows], of_part[counts <= _PLACES])
    sure = set(of_part[counts > _PLACES].tolist())
    for i, s in zip(rows[few].tolist(), step[few].tolist(), strict=True):
        k = int(part[i])
        if k not in sure:
            x, need, p = int(at[i]), int(half[i]), int(q[i])
            if s > 0:
                same = x + p + need <= high[k] and np.array_equal(codes[x : x + need], codes[x + p : x + p + need])
            else:
                same = x - need >= low[k] and np.array_equal(codes[x - need : x], codes[x + p - need : x + p])
            if same:
                sure.add(k)
    return np.array(sorted(sure), dtype=np.int64)


def find_runs(codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``start, length, period`` of all runs in the sequences ``codes[first[i]:first[i + 1]]``, by start and period."""
    low, high = first[:-1].astype(np.int64), first[1:].astype(np.int64)
    begin, stop = low, high  # of the whole text
    out: list[tuple[np.ndarray, ...]] = [(np.zeros(0, dtype=np.int64),) * 3]
    owner, owners = np.zeros(len(codes), dtype=np.int32), 0  # the run of a small period that a word is in
    while True:
        long = high - low >= LEAST
        if owners:
            ends = owner[np.minimum(low, len(codes) - 1)], owner[np.maximum(high - 1, 0)]
            long &= (ends[0] == 0) | (ends[0] != ends[1])
        low, high, begin, stop = low[long], high[long], begin[long], stop[long]
        if not len(low):
            break
        middle = (low + high) // 2
        for k in _screened(codes, low, middle, high).tolist():
            start, length, period = crossing(codes[low[k] : high[k]].tolist(), int(middle[k] - low[k]))
            start = start + low[k]
            end = start + length
            before, after = np.maximum(start - 1, 0), np.minimum(end, len(codes) - 1)
            more = (start > begin[k]) & (codes[before] == codes[before + period])
            more |= (end < stop[k]) & (codes[after] == codes[after - period])
            out.append((start[~more], length[~more], period[~more]))
            for i in np.flatnonzero(~more & (period <= _ALONE)).tolist():
                owners += 1
                owner[start[i] : end[i]] = owners
        low, high = np.concatenate([low, middle]), np.concatenate([middle, high])
        begin, stop = np.tile(begin, 2), np.tile(stop, 2)
    start, length, period = (np.concatenate(x) for x in zip(*out, strict=True))
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])  # the smallest period of a stretch comes first
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _collapsed(c: W.Chunk, dropped: np.ndarray) -> pa.Array:
    """The kept words of each row, joined by one space."""
    kept = np.flatnonzero(~dropped)
    row = c.row_of_word()[kept]
    size = c.ends[kept] - c.starts[kept]
    space = np.ones(len(kept), dtype=np.int64)
    if len(kept):
        space[:-1] = row[1:] == row[:-1]
        space[-1] = 0
    data = np.append(c.buf, np.uint8(0x20))[W.ragged_arange(c.starts[kept], size + space)]
    ends = np.cumsum(size + space)
    data[ends[space > 0] - 1] = 0x20
    at = np.append(0, ends)[np.searchsorted(row, np.arange(c.row1 - c.row0 + 1))]
    return pa.Array.from_buffers(pa.large_utf8(), c.row1 - c.row0, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)])


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for c in W.chunks(batch.column("text")):
            start, length, period = find_runs(c.codes(), c.first)
            change = np.zeros(len(c.starts) + 1, dtype=np.int64)
            np.add.at(change, start + period, 1)
            np.add.at(change, start + length, -1)
            row = np.searchsorted(c.first, start, side="right") - 1
            fields = [pa.array(start - c.first[row]), pa.array(length), pa.array(period)]
            runs = pa.ListArray.from_arrays(
                np.searchsorted(row, np.arange(c.row1 - c.row0 + 1)).astype(np.int32),
                pa.StructArray.from_arrays(fields, ["start", "length", "period"]),
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(c.row0, c.row1 - c.row0),
                    pa.array(c.n_words.astype(np.int64)),
                    runs,
                    _collapsed(c, np.cumsum(change[:-1]) > 0).cast(pa.utf8()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for each row of ``docs(doc_id, text)``.

    ``runs`` is ordered by start and period, numbered in words from 0; ``collapsed`` has the words that no run holds after
    its first period, joined by one space.  Null and empty texts have no words, no runs and an empty ``collapsed``.
    Repeated rows are answered each; other columns are dropped.  An empty table gives an empty one.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_find, f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def strongest(runs: Column) -> Column:
    """The run with the greatest length by period, of equal ones the first; null if there is none."""
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")

    def better(best: Column, x: Column) -> Column:
        return F.when(best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"]), x).otherwise(best)

    return F.aggregate(runs, none, better)
