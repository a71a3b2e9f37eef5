"""How far the term frequencies of a language's sources lie apart, by dense tiles of sources and terms.

Terms are counted in one pass: tasks send one row for each language, source and term of a chunk, and Spark sums them.  The
terms that enough documents of their language have are kept and dealt to blocks by a hash, each block with about
``ENTRIES`` counts.  A task makes of a block a matrix of 64-bit counts, sources by terms, turns it into frequencies in parts
of a thousand million, compares all pairs of sources by broadcasting, and sends one partial sum for each pair and the ten
greatest terms of each source.  Partial sums are added and partial lists merged by Spark.

A language with more than ``TILE`` sources is cut into tiles of so many sources, and a block is sent to every pair of tiles,
so that a task never holds more than two tiles, a block and ``CELLS`` compared values.  All arithmetic is in integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .storage import bound_batches, cut

#: Frequencies are parts of so many.
WHOLE = 1_000_000_000
#: Counts of a block, about.
ENTRIES = 100_000
#: Sources of a tile.
TILE = 512
#: Values that are compared at once.
CELLS = 1 << 20
#: Bytes of text whose counts are summed before they are sent.
SPAN = 4 << 20

_IS_TERM = np.zeros(256, dtype=bool)
_IS_TERM[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


class _Terms(W.Chunk):
    """A chunk whose words are runs of ASCII letters and of all characters beyond ASCII."""

    def _inside(self) -> np.ndarray:
        return _IS_TERM[self.buf]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each language and source of a chunk a row without a term, and a row for each term: occurrences and documents."""
    for batch in batches:
        groups = pa.StructArray.from_arrays([batch.column("lang"), batch.column("source")], ["lang", "source"])
        pairs: dict[tuple[str, str], int] = {}
        group = np.array([pairs.setdefault((x["lang"], x["source"]), len(pairs)) for x in groups.to_pylist()], dtype=np.int64)
        names = list(pairs)
        for c in W.chunks(batch.column("text"), lower=True, limit=SPAN):
            t = _Terms(c.row0, c.row1, c.buf, c.at, True)
            code, own = t.codes(), group[c.row0 : c.row1]
            n = int(code.max(initial=0)) + 1
            key, counts = np.unique(t.row_of_word() * n + code, return_counts=True)  # by document
            key = own[key // n] * n + key % n
            order = np.argsort(key, kind="stable")
            key, at = np.unique(key[order], return_index=True)
            total = np.add.reduceat(counts[order], at) if len(at) else np.zeros(0, dtype=np.int64)
            docs = np.diff(np.append(at, len(order)))
            first = np.zeros(n, dtype=np.int64)
            first[code[::-1]] = np.arange(len(code))[::-1]  # a place where the term stands
            where = first[key % n]
            size = t.ends[where] - t.starts[where] if len(where) else np.zeros(0, dtype=np.int64)
            data = t.data[W.ragged_arange(t.starts[where], size)] if len(where) else np.zeros(0, dtype=np.uint8)
            offsets = np.append(0, np.cumsum(size)).astype(np.int32)
            terms = pa.Array.from_buffers(pa.utf8(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
            seen = np.unique(own)
            which = np.concatenate([seen, key // n]).tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([names[i][0] for i in which], pa.utf8()),
                    pa.array([names[i][1] for i in which], pa.utf8()),
                    pa.concat_arrays([pa.nulls(len(seen), pa.utf8()), terms]),
                    pa.array(np.concatenate([np.zeros(len(seen), dtype=np.int64), total])),
                    pa.array(np.concatenate([np.zeros(len(seen), dtype=np.int64), docs])),
                ],
                ["lang", "source", "term", "n", "docs"],
            )


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents of each term, and a row with a null term for each source.

    Null texts, languages and sources count as empty strings; repeated rows are documents of their own.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")))
    found = rows.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def frequency(n: np.ndarray, total: np.ndarray, kept: int) -> np.ndarray:
    """``1 + floor(WHOLE * (n + 2) / (total + 2 * kept))`` without overflow for totals below 9e15, a factor of 1000 at a time."""
    rest, by = np.broadcast_arrays(n + 2, total + 2 * kept)
    out, rest = rest // by, rest % by
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // by, rest % by
    return out + 1


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _pair_sums(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Sums over terms of the distances of each row of ``p`` to each row of ``q``."""
    out = np.zeros((len(p), len(q)), dtype=np.int64)
    some = max(1, min(p.shape[1], CELLS // max(1, len(q))))
    rows = max(1, CELLS // (some * max(1, len(q))))
    for a in range(0, p.shape[1], some):
        for i in range(0, len(p), rows):
            out[i : i + rows] += distance(p[i : i + rows, None, a : a + some], q[None, :, a : a + some]).sum(axis=2)
    return out


_PART = "lang string, part string, number long, other long, term string, value long"


def _compare(top: int):
    def run(group: pa.Table) -> pa.Table:
        """One block of one language, for the sources of one pair of tiles."""
        head = {c: group.column(c)[0].as_py() for c in ("lang", "rows", "columns")}
        term = group.column("term").combine_chunks()
        listed = np.asarray(term.is_null())
        number, n = (group.column(c).to_numpy() for c in ("number", "n"))
        # every source of both tiles has a row without a term: its number, its sum, and the language's number of kept terms
        source, kept = number[listed], int(group.column("kept").to_numpy()[listed][0])
        order = np.argsort(source)
        source, total = source[order], group.column("all").to_numpy()[listed][order]
        names = term.filter(pa.array(~listed)).dictionary_encode()
        code = np.asarray(names.indices).astype(np.int64)
        row = np.searchsorted(source, number[~listed])
        counts, of_language, n_terms = n[~listed], group.column("all").to_numpy()[~listed], len(names.dictionary)
        language_n = int(group.column("language_n").to_numpy()[listed][0])
        tile = source // TILE
        up, down = np.flatnonzero(tile == head["rows"]), np.flatnonzero(tile == head["columns"])
        sums = np.zeros((len(up), len(down)), dtype=np.int64)
        by_term = np.argsort(code, kind="stable")
        edge = np.searchsorted(code[by_term], np.arange(n_terms + 1))
        width = max(1, CELLS // max(1, len(source)))
        for a in range(0, n_terms, width):
            b = min(a + width, n_terms)
            mine = by_term[edge[a] : edge[b]]
            matrix = np.zeros((len(source), b - a), dtype=np.int64)
            matrix[row[mine], code[mine] - a] = counts[mine]
            p = frequency(matrix, total[:, None], kept)
            sums += _pair_sums(p[up], p[down])
        i, j = np.meshgrid(source[up], source[down], indexing="ij")
        first, second, value = i.ravel(), j.ravel(), sums.ravel()
        other = first != second
        first, second, value = first[other], second[other], value[other]
        if head["rows"] != head["columns"]:
            first, second, value = np.append(first, second), np.append(second, first), np.tile(value, 2)
        best = np.zeros(0, dtype=np.int64)
        if head["rows"] == head["columns"] and len(code):
            p, q = frequency(counts, total[row], kept), frequency(of_language, np.int64(language_n), kept)
            f = distance(p, q)
            rank = np.empty(n_terms, dtype=np.int64)
            rank[np.array(sorted(range(n_terms), key=names.dictionary.cast(pa.binary()).to_pylist().__getitem__), dtype=np.int64)] = np.arange(n_terms)
            above = np.flatnonzero((p > q) & (counts > 0))
            above = above[np.lexsort((rank[code[above]], -f[above], row[above]))]
            place = np.arange(len(above)) - np.searchsorted(row[above], row[above])
            best = above[place < top]
            second = np.append(second, np.full(len(best), -1))
            first, value = np.append(first, source[row[best]]), np.append(value, f[best])
        n_pairs = len(first) - len(best)
        return pa.table(
            {
                "lang": pa.array([head["lang"]] * len(first), pa.utf8()),
                "part": pa.array(["pair"] * n_pairs + ["term"] * len(best), pa.utf8()),
                "number": pa.array(first),
                "other": pa.array(second),
                "term": pa.concat_arrays([pa.nulls(n_pairs, pa.utf8()), names.dictionary.take(pa.array(code[best]))]),
                "value": pa.array(value),
            }
        )

    return run


def audit(docs: DataFrame, least_docs: int = 10, top: int = 10, entries: int = ENTRIES) -> DataFrame:
    """``lang, source, part, item, value, rank`` for ``docs(text, lang, source)``.

    Part ``pair``: for each source the other sources of its language, with the summed distance of their frequencies of all
    kept terms.  Part ``term``: for each source the ``top`` terms that it has more often than its language, with their
    distance.  Ranks go by value descending, then by item in the order of its UTF-8.  A term is kept if at least
    ``least_docs`` documents of the language have it.  Null texts, languages and sources count as empty strings; a source
    without terms takes part with counts of 0, and a language without kept terms has distances of 0.  Repeated rows count
    each; other columns are dropped.  An empty table gives an empty one.
    """
    counts = cut(term_counts(docs), "terms")
    terms = counts.filter("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("all"), F.sum("docs").alias("docs"))
    terms = cut(terms.filter(F.col("docs") >= least_docs).drop("docs"), "kept")
    held = cut(counts.join(terms, ["lang", "term"]).select("lang", "source", "term", "n", "all"), "held")
    sources = counts.filter("term is null").select("lang", "source")
    sums = held.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("held"))
    # numbers of sources and of blocks
    by_lang = Window.partitionBy("lang").orderBy("source")
    numbered = sources.withColumn("number", F.row_number().over(by_lang).cast("long") - 1).join(sums, ["lang", "source"], "left")
    numbered = cut(numbered.fillna(0, ["total", "held"]), "sources")
    sizes = terms.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("all").alias("language_n"))
    languages = numbered.groupBy("lang").agg(
        (F.floor((F.count("*") - 1) / TILE) + 1).cast("int").alias("tiles"),
        (F.floor(F.sum("held") / F.greatest(F.lit(entries), F.count("*") * F.least(F.lit(TILE), F.count("*")) / 2)) + 1).cast("int").alias("blocks"),
    )
    languages = cut(languages.join(sizes, "lang", "left").fillna(0, ["kept", "language_n"]), "languages")

    tile = F.floor(F.col("number") / TILE).cast("int")
    others = F.sequence(F.lit(0), F.col("tiles") - 1)
    pairs = F.explode(F.transform(others, lambda x: F.struct(F.least(tile, x).alias("rows"), F.greatest(tile, x).alias("columns"))))
    lists = numbered.join(languages, "lang").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    lists = lists.select(
        "lang", "block", pairs.alias("x"), "number", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"),
        F.col("total").alias("all"), "kept", "language_n",
    )
    known = held.join(numbered.select("lang", "source", "number"), ["lang", "source"]).join(languages, "lang")
    block = F.pmod(F.xxhash64("term"), F.col("blocks").cast("long")).cast("int")
    rows = known.select("lang", block.alias("block"), pairs.alias("x"), "number", "term", "n", "all", "kept", "language_n")
    rows = lists.unionByName(rows).select("lang", "block", "x.*", "number", "term", "n", "all", "kept", "language_n")
    found = cut(rows.groupBy("lang", "block", "rows", "columns").applyInArrow(_compare(top), _PART), "parts")

    pair = found.filter("part = 'pair'").groupBy("lang", "number", "other").agg(F.sum("value").alias("value"))
    names = numbered.select("lang", "number", "source")
    item = names.select("lang", F.col("number").alias("other"), F.col("source").alias("item"))
    pair = pair.join(item, ["lang", "other"]).select("lang", "number", F.lit("pair").alias("part"), "item", "value")
    term = found.filter("part = 'term'").select("lang", "number", "part", F.col("term").alias("item"), "value")
    order = Window.partitionBy("lang", "number").orderBy(F.desc("value"), "item")
    ranked = pair.withColumn("rank", F.row_number().over(order)).unionByName(
        term.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    )
    return ranked.join(names, ["lang", "number"]).select("lang", "source", "part", "item", "value", "rank")
