"""Exact removal of repeated word windows by super-k-mer partitioning.

A window is ``k`` consecutive words of one text.  Its minimiser is the smallest hash among its ``m``-word grams;
consecutive windows with the same minimiser form a super-k-mer.  Equal windows have equal minimisers, so:

1.  every text gives one small row per super-k-mer, and minimisers are counted with map-side sums.  A minimiser that
    occurs once in the corpus rules out all of its windows;
2.  the other super-k-mers travel, each as one packed string, to the bucket of their minimiser, where windows are sorted
    by hash and neighbours compared word by word, so that counts are exact;
3.  a minimiser with more than ``hot`` super-k-mers (a passage that a large part of the corpus shares) would make its
    bucket too large for a task.  Its packed strings are folded first, by map-side sums on their 128-bit BLAKE2b digests:
    all windows of one that is there twice are repeated.  Only one of each goes on, and its windows are counted by two
    independent 64-bit hashes, with map-side sums again; nothing is sampled or dropped;
4.  repeated spans go back to their texts, and every word that a repeated window covers is removed.

Bounded memory: a task holds a chunk of texts (some MB or one text), or one bucket of at most ``hot`` super-k-mers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .storage import bound_batches, cut

#: A super-k-mer is cut after so many windows, so that a text of one repeated word still gives short strings.
MAX_RUN = 64
#: Bytes of packed strings that a task makes at once.
_PART = 8 << 20


def _sliding_min(g: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, by doubling."""
    span, out = 1, g
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def _super_kmers(c: W.Chunk, k: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window (word index in the chunk), number of windows, minimiser, and 1 or 2 (it occurs again within)."""
    none = np.zeros(0, dtype=np.int64)
    ok = c.window_rows(k)
    if not ok.any():
        return none, none, none, none
    grams = W.window_hash(c.hashes(), m)
    low = _sliding_min(grams, k - m + 1)[: len(ok)]
    at = np.flatnonzero(ok)
    low = low[at]
    row = c.row_of_word()[at]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (low[1:] != low[:-1]) | (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)
    begin = np.flatnonzero(new)
    length = np.diff(np.append(begin, len(at)))
    if (length > MAX_RUN).any():
        pieces = -(-length // MAX_RUN)
        step = W.ragged_arange(np.zeros(len(pieces), dtype=np.int64), pieces) * MAX_RUN
        length = np.minimum(np.repeat(length, pieces) - step, MAX_RUN)
        begin = np.repeat(begin, pieces) + step
    start, mini = at[begin], low[begin]
    width = k - m + 1
    inside = np.arange(width)
    first = np.empty(len(start), dtype=np.int64)
    last = np.empty(len(start), dtype=np.int64)
    for a in range(0, len(start), 1 << 16):  # leftmost in the first window, rightmost in the last
        s = slice(a, a + (1 << 16))
        first[s] = start[s] + np.argmax(grams[start[s, None] + inside] == mini[s, None], axis=1)
        end = start[s] + length[s] - 1 + width - 1
        last[s] = end - np.argmax(grams[end[:, None] - inside] == mini[s, None], axis=1)
    return start, length, mini.view(np.int64), np.where(first == last, 1, 2)


def _find(k: int, m: int):
    schema = pa.schema(
        [("doc", pa.int64()), ("print", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("mini", pa.int64()), ("weight", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, fingerprint = batch.column("doc"), batch.column("print")
            for c in W.chunks(batch.column("text")):
                start, n, mini, weight = _super_kmers(c, k, m)
                if len(start):
                    row = c.row_of_word()[start]
                    take = pa.array(row + c.row0)
                    yield pa.RecordBatch.from_arrays(
                        [
                            doc.take(take),
                            fingerprint.take(take),
                            pa.array((start - c.first[row]).astype(np.int32)),
                            pa.array(n.astype(np.int32)),
                            pa.array(mini),
                            pa.array(weight),
                        ],
                        schema=schema,
                    )

    return run, "doc long, print long, start int, n int, mini long, weight long"


def _listed(batch: pa.RecordBatch, name: str, c: W.Chunk) -> tuple[np.ndarray, pa.StructArray]:
    """The structs listed in ``name`` for the rows of a chunk, with each one's row in the chunk."""
    part = batch.column(name).slice(c.row0, c.row1 - c.row0)
    sizes = np.asarray(pc.fill_null(pc.list_value_length(part), 0))
    return np.repeat(np.arange(len(part)), sizes), part.flatten()


def _strings(c: W.Chunk, word: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of ``size`` words from each ``word`` on, a space after each word, and where each string begins."""
    which = W.ragged_arange(word, size)
    each = c.ends[which] - c.starts[which] + 1
    data = c.buf[np.minimum(W.ragged_arange(c.starts[which], each), len(c.buf) - 1)]
    done = np.cumsum(each)
    data[done - 1] = 0x20
    return data, np.concatenate([[0], done[np.cumsum(size) - 1]])


def _packed(k: int, hot: bool):
    """Packed strings of the listed super-k-mers, and what the next step needs of them."""
    fields = [("doc", pa.int64()), ("print", pa.int64()), ("start", pa.int32())]
    schema = pa.schema([*fields, *([("n", pa.int32()), ("key", pa.binary())] if hot else [("mini", pa.int64())]), ("packed", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in W.chunks(batch.column("text")):
                rows, listed = _listed(batch, "at", c)
                if not len(rows):
                    continue
                starts, ns = np.asarray(listed.field("start")).astype(np.int64), np.asarray(listed.field("n")).astype(np.int64)
                words, sizes = c.first[rows] + starts, ns + k - 1
                done = np.cumsum(c.ends[words + sizes - 1] - c.starts[words] + 1) // _PART
                edges = np.concatenate([[0], np.flatnonzero(done[1:] != done[:-1]) + 1, [len(rows)]]).tolist()
                for a, b in zip(edges[:-1], edges[1:], strict=True):
                    row, start = rows[a:b], starts[a:b]
                    data, at = _strings(c, words[a:b], sizes[a:b])
                    if hot:
                        raw, ends = data.tobytes(), at.tolist()
                        key = [W.digest(raw[x:y], size=16) for x, y in zip(ends[:-1], ends[1:], strict=True)]
                        more = [pa.array(ns[a:b].astype(np.int32)), pa.array(key, pa.binary())]
                    else:
                        more = [listed.field("mini").slice(a, b - a)]
                    packed = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data)])
                    take = pa.array(row + c.row0)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc").take(take), batch.column("print").take(take), pa.array(start.astype(np.int32)), *more, packed],
                        schema=schema,
                    )

    return run, "doc long, print long, start int, " + ("n int, key binary, " if hot else "mini long, ") + "packed binary"


def _windows(k: int):
    """Two hashes of each window of the packed strings."""
    pair = pa.struct([("h1", pa.int64()), ("h2", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = [i for i, f in enumerate(batch.schema) if f.name != "packed"]
            for c in W.chunks(batch.column("packed")):
                at = np.flatnonzero(c.window_rows(k))
                h1, h2 = (W.window_hash(c.hashes(i), k, i)[at].view(np.int64) for i in (0, 1))
                pairs = pa.StructArray.from_arrays([pa.array(h1), pa.array(h2)], fields=list(pair))
                offsets = np.searchsorted(at, c.first).astype(np.int32)
                own = [batch.column(i).slice(c.row0, c.row1 - c.row0) for i in rest]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.ListArray.from_arrays(pa.array(offsets), pairs)],
                    names=[*(batch.schema[i].name for i in rest), "windows"],
                )

    return run, "doc long, print long, start int, copies long, windows array<struct<h1:long,h2:long>>"


def _repeated(hashes: np.ndarray, codes: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Sorts the windows that begin at ``at``; true where another one has the same words, which ``codes`` number."""
    order = np.argsort(hashes, kind="stable")
    hashes, sorted_at = hashes[order], at[order]
    near = np.flatnonzero(hashes[1:] == hashes[:-1])
    same = np.zeros(len(near), dtype=bool)
    inside = np.arange(k)
    for a in range(0, len(near), 1 << 14):
        some = near[a : a + (1 << 14)]
        same[a : a + (1 << 14)] = (codes[sorted_at[some, None] + inside] == codes[sorted_at[some + 1, None] + inside]).all(axis=1)
    out = np.zeros(len(at), dtype=bool)
    out[order[near[same]]] = True
    out[order[near[same] + 1]] = True
    for h in np.unique(hashes[near[~same]]).tolist():  # different windows of one hash: told apart by their words
        seen: dict[bytes, list[int]] = {}
        for i in order[np.searchsorted(hashes, np.uint64(h)) : np.searchsorted(hashes, np.uint64(h), side="right")].tolist():
            seen.setdefault(codes[at[i] : at[i] + k].tobytes(), []).append(i)
        for places in seen.values():
            out[places] = len(places) > 1
    return out


def _count_buckets(k: int):
    schema = pa.schema([("doc", pa.int64()), ("print", pa.int64()), ("begin", pa.int32()), ("end", pa.int32())])

    def spans(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """rows: whole buckets."""
        found: list[list[np.ndarray]] = []
        mini = np.asarray(rows.column("mini"))
        size = np.diff(W.utf8_column(rows.column("packed"))[1])
        edge = np.flatnonzero(np.append(mini[1:] != mini[:-1], True)) + 1  # ends of buckets
        done = np.cumsum(size)[edge - 1]
        last = np.append(np.flatnonzero(done[1:] // W.CHUNK_BYTES != done[:-1] // W.CHUNK_BYTES), len(edge) - 1)  # some whole buckets at a time
        cuts = np.concatenate([[0], edge[last]])
        parts = (
            (int(a), c) for a, b in zip(cuts[:-1], cuts[1:], strict=True) for c in W.chunks(
                rows.column("packed").slice(a, b - a),
                limit=1 << 62,
            )
        )
        for head, c in parts:
            ok = c.window_rows(k)
            at = np.flatnonzero(ok)
            again = _repeated(W.window_hash(c.hashes(), k)[at], c.codes(), at, k)
            at = at[again]
            row = c.row_of_word()[at]
            new = np.ones(len(at), dtype=bool)
            new[1:] = (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)
            begin = np.flatnonzero(new)
            length = np.diff(np.append(begin, len(at)))
            found.append([row[begin] + c.row0 + head, at[begin] - c.first[row[begin]], length])
        row, begin, length = (np.concatenate(x) for x in zip(*found, strict=True))
        if len(row):
            start = np.asarray(rows.column("start"))[row] + begin
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc").take(take),
                    rows.column("print").take(take),
                    pa.array(start.astype(np.int32)),
                    pa.array((start + length + k - 1).astype(np.int32)),
                ],
                schema=schema,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by minimiser; the last bucket of a batch waits for the next batch."""
        kept: list[pa.RecordBatch] = []
        for batch in batches:
            mini = np.asarray(batch.column("mini"))
            if not len(mini):
                continue
            cut = int(np.searchsorted(mini, mini[-1]))
            if kept and (cut or np.asarray(kept[0].column("mini"))[0] != mini[0]):
                head = int(np.searchsorted(mini, np.asarray(kept[0].column("mini"))[0], side="right"))
                head = min(head, cut) if cut else 0
                kept.append(batch.slice(0, head))
                yield from spans(pa.Table.from_batches(kept).combine_chunks().to_batches()[0])
                kept, batch, cut = [], batch.slice(head), cut - head
            if cut > 0:
                yield from spans(batch.slice(0, cut))
            kept.append(batch.slice(max(cut, 0)))
        if kept:
            yield from spans(pa.Table.from_batches(kept).combine_chunks().to_batches()[0])

    return run, "doc long, print long, begin int, end int"


def _remove(keep_text: bool):
    last = [("kept", pa.binary())] if keep_text else [("kept_sha256", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = [i for i, f in enumerate(batch.schema) if f.name not in ("text", "spans")]
            for c in W.chunks(batch.column("text")):
                row, listed = _listed(batch, "spans", c)
                turn = np.zeros(len(c.starts) + 1, dtype=np.int64)
                if len(row):
                    np.add.at(turn, c.first[row] + np.asarray(listed.field("begin")), 1)
                    np.add.at(turn, c.first[row] + np.asarray(listed.field("end")), -1)
                gone = np.cumsum(turn[:-1]) > 0
                kept = np.flatnonzero(~gone)
                each = c.ends[kept] - c.starts[kept] + 1
                data = c.buf[np.minimum(W.ragged_arange(c.starts[kept], each), max(len(c.buf) - 1, 0))]
                done = np.concatenate([[0], np.cumsum(each)])
                data[done[1:] - 1] = 0x20
                edge = done[np.searchsorted(kept, c.first)]
                raw = data.tobytes()
                texts = [raw[a : b - 1] if b > a else b"" for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
                removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[c.first])
                out = pa.array(texts, pa.binary()) if keep_text else pa.array([hashlib.sha256(x).hexdigest() for x in texts])
                own = [batch.column(i).slice(c.row0, c.row1 - c.row0) for i in rest]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(c.n_words.astype(np.int64)), pa.array(removed.astype(np.int64)), out],
                    names=[*(batch.schema[i].name for i in rest), "n_words", "n_removed", last[0][0]],
                )

    return run


def _key(left: str, right: str) -> Column:
    return F.col(f"{left}.doc").eqNullSafe(F.col(f"{right}.doc")) & (F.col(f"{left}.print") == F.col(f"{right}.print"))


def repeated_spans(docs: DataFrame, k: int = 35, m: int = 8, hot: int = 4_000) -> DataFrame:
    """Spans of words that windows of ``k`` words found twice or more cover: ``doc, print, spans array<struct<begin,end>>``.

    ``docs`` has ``doc long``, ``print long`` (together the key of a row; rows with the same key have the same text)
    and ``text``.  Texts of fewer than ``k`` words, empty and null texts have no windows.  A row that is there twice
    repeats itself; its super-k-mers are listed once for all of its copies.  An empty table has no spans.
    """
    bound_batches(docs.sparkSession)
    m = min(m, k)
    found = docs.mapInArrow(*_find(k, m))
    counts = found.groupBy("mini").agg(F.sum("weight").alias("total")).filter("total > 1")
    at = cut(found.join(counts, "mini").select("doc", "print", "start", "n", "mini", (F.col("total") > hot).alias("hot")), "super-k-mers")

    def texts_with(which: Column) -> DataFrame:
        listed = at.filter(which).groupBy("doc", "print").agg(F.collect_set(F.struct("start", "n", "mini")).alias("at"))
        return docs.alias("d").join(listed.alias("l"), _key("d", "l")).select("d.doc", "d.print", "d.text", "l.at")

    cold = texts_with(~F.col("hot")).mapInArrow(*_packed(k, hot=False))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cold = cold.repartition(n, "mini").sortWithinPartitions("mini").mapInArrow(*_count_buckets(k))
    crowd = cut(texts_with(F.col("hot")).mapInArrow(*_packed(k, hot=True)), "crowded")
    place = F.struct("doc", "print", "start")
    kinds = crowd.groupBy("key").agg(F.count("*").alias("copies"), F.any_value(place).alias("x"), F.any_value("packed").alias("packed"))
    kinds = cut(kinds.select("key", "copies", "x.*", "packed"), "kinds")
    same = crowd.join(kinds.filter("copies > 1").select("key"), "key").select(
        "doc",
        "print",
        F.col("start").alias("begin"),
        (F.col("start") + F.col("n") + (k - 1)).alias("end"),
    )
    each = kinds.select("doc", "print", "start", "copies", "packed").mapInArrow(*_windows(k)).select(
        "doc",
        "print",
        "start",
        "copies",
        F.posexplode("windows").alias("i", "h"),
    )
    again = each.groupBy("h").agg(F.count("*").alias("times")).filter("times > 1").drop("times")
    lone = each.filter("copies = 1").join(again, "h").select(
        "doc",
        "print",
        (F.col("start") + F.col("i")).alias("begin"),
        (F.col("start") + F.col("i") + k).alias("end"),
    )
    warm = same.unionByName(lone)
    return cold.unionByName(warm).groupBy("doc", "print").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))


def remove_repeats(docs: DataFrame, k: int = 35, m: int = 8, hot: int = 4_000, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and the kept words joined by one space.

    Takes ``doc_id long`` and ``text``.  With ``keep_text`` the column ``text`` holds the kept words and other columns pass
    through, but for those named ``n_words`` or ``n_removed``, which are replaced; else the kept words are replaced by
    ``kept_sha256`` and other columns dropped.  Null texts have no words and count as empty; a null ``doc_id`` is an id like
    any other.  Every copy of a repeated window goes, the first one too, and a row that is there twice loses all windows.
    An empty table gives an empty table.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("print"), "text")
    spans = repeated_spans(keyed, k, m, hot)
    rest = [c for c in docs.columns if c.lower() not in ("doc_id", "text", "n_words", "n_removed")] if keep_text else []
    # other columns travel in one, so that no name clashes
    others = F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest))).alias("rest")
    full = docs.select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("print"), "text", others)
    joined = full.alias("d").join(spans.alias("s"), _key("d", "s"), "left").select(
        F.col("d.doc").alias("doc_id"),
        "d.rest",
        "d.text",
        "s.spans",
    )
    kind = joined.schema["rest"].dataType.simpleString()
    out = joined.mapInArrow(
        _remove(keep_text),
        f"doc_id long, rest {kind}, n_words long, n_removed long, " + ("kept binary" if keep_text else "kept_sha256 string"),
    )
    named = [F.col(f"rest.c{i}").alias(c) for i, c in enumerate(rest)]
    return out.select("doc_id", *named, "n_words", "n_removed", F.col("kept").cast("string").alias("text") if keep_text else "kept_sha256")
