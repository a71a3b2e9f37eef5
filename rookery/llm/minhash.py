"""Near-duplicate documents: MinHash with banding, signature and full-set verification, connected components.

Steps, each over all documents:

1.  one pass over the texts gives per document the size of its shingle set, a 128-bit BLAKE2b digest of its word sequence,
    the low bytes of ``bands * rows`` universal hash minima, and a hash for each band;
2.  documents with equal word sequences fold into the one with the smallest id, so that no copies are ever paired;
3.  documents that share a band meet in its bucket and are compared with the smallest id there (one row per member,
    not all pairs).  Pairs whose signatures agree far too seldom are dropped, the others confirmed on full shingle sets;
4.  components are found.  Buckets that still hold several components are compared across them, members outside the
    bucket's largest component against all.  A bucket is a grid of cells, each with two blocks of its members, so that a
    task holds two blocks at a time however large the bucket is.  Signatures are compared first; only members that may be
    alike to one of another component then bring their texts to the cell, which returns no pairs but the few links that
    join components;
5.  components of all confirmed links, mapped back to every document.

All texts are shuffled once, to take out those of documents that share a band with another one; confirmations read
only these.  With 5 rows and 24 bands a pair at 0.85 fails to meet with a chance of 8e-7, at 0.8 of 7e-5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .components import components
from .storage import bound_batches, cut, forget

#: Members of a block of a crowded bucket, on average, and their shingles, at most.
BLOCK = 1024
BLOCK_SHINGLES = 400_000
_SEED = 20240229


def _shingles(c: W.Chunk, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all rows, and where each row's begin.  A shorter text is one shingle."""
    h = c.hashes()
    ok = c.window_rows(k)
    row = c.row_of_word()
    grams, of = W.window_hash(h, k)[ok], row[: len(ok)][ok]
    short = np.flatnonzero((c.n_words > 0) & (c.n_words < k))
    if len(short):
        grams = np.concatenate([grams, W.sequence_hash(h, c.first[short], c.first[short + 1])])
        of = np.concatenate([of, short])
    order = np.lexsort((grams, of))
    grams, of = grams[order], of[order]
    new = np.ones(len(grams), dtype=bool)
    new[1:] = (grams[1:] != grams[:-1]) | (of[1:] != of[:-1])
    grams, of = grams[new], of[new]
    return grams, np.searchsorted(of, np.arange(c.row1 - c.row0 + 1))


def _digests(c: W.Chunk) -> list[bytes]:
    """A digest of each row's words, joined by one space."""
    each = c.ends - c.starts + 1
    done = np.concatenate([[0], np.cumsum(each)])
    data = c.data[np.minimum(W.ragged_arange(c.starts, each), max(len(c.data) - 1, 0))]
    data[done[1:] - 1] = 0x20
    raw, edge = data.tobytes(), done[c.first].tolist()
    return [W.digest(raw[a:b], size=16) for a, b in zip(edge[:-1], edge[1:], strict=True)]


def _sign(k: int, bands: int, rows: int):
    rng = np.random.default_rng(_SEED)
    mult = rng.integers(1, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64)
    schema = pa.schema(
        [
            ("doc", pa.int64()),
            ("print", pa.int64()),
            ("n_shingles", pa.int64()),
            ("digest", pa.binary()),
            ("sig", pa.binary()),
            ("bands", pa.list_(pa.int64())),
        ]
    )
    numbers = np.arange(1, bands + 1, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in W.chunks(batch.column("text"), lower=True):
                grams, at = _shingles(c, k)
                n = np.diff(at)
                full = np.flatnonzero(n)
                sig = np.empty((len(full), bands * rows), dtype=np.uint32)
                for i in range(bands * rows if len(full) else 0):
                    sig[:, i] = np.minimum.reduceat(((grams * mult[i] + add[i]) >> np.uint64(32)).astype(np.uint32), at[full])
                wide = sig.astype(np.uint64).reshape(-1, rows)
                key = np.zeros(len(wide), dtype=np.uint64)
                for i in range(rows):
                    key = W.join(key, wide[:, i])
                key = W.mix(key.reshape(-1, bands) ^ numbers)
                size, flags = np.zeros(len(n), dtype=np.int64), n == 0
                size[full] = bands
                offsets = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32), mask=np.append(flags, False))
                raw, step = sig.astype(np.uint8).tobytes(), bands * rows
                place = np.cumsum(~flags) - 1
                sigs = [None if e else raw[p * step : (p + 1) * step] for e, p in zip(flags.tolist(), place.tolist(), strict=True)]
                own = [batch.column(x).slice(c.row0, c.row1 - c.row0) for x in ("doc", "print")]
                yield pa.RecordBatch.from_arrays(
                    [
                        *own,
                        pa.array(n.astype(np.int64)),
                        pa.array(_digests(c), pa.binary()),
                        pa.array(sigs, pa.binary()),
                        pa.ListArray.from_arrays(offsets, pa.array(key.ravel().view(np.int64))),
                    ],
                    schema=schema,
                )

    return run, "doc long, print long, n_shingles long, digest binary, sig binary, bands array<long>"


def _matrix(sigs: pa.Array) -> np.ndarray:
    """Signatures of one length, a row each."""
    data, at = W.utf8_column(sigs)
    return data[at[0] : at[-1]].reshape(len(sigs), -1)


def _likely(least: float):
    """Pairs of which at least a share of the signatures' bytes agree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keep = (_matrix(batch.column("sig_a")) == _matrix(batch.column("sig_b"))).mean(axis=1) >= least
                yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run, "a long, b long"


def _confirm(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = 0
            while row < batch.num_rows:  # some rows at a time: their two texts may be long
                part = batch.slice(row, 64)
                row += 64
                found = []
                sets = {}
                for side in ("a", "b"):
                    ids, texts = part.column(side).to_pylist(), part.column(f"text_{side}")
                    for i, x in enumerate(ids):
                        if x not in sets:
                            for c in W.chunks(texts.slice(i, 1), lower=True):
                                sets[x] = _shingles(c, k)[0]
                for x, y in zip(part.column("a").to_pylist(), part.column("b").to_pylist(), strict=True):
                    a, b = sets[x], sets[y]
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    found.append(bool(len(a) and len(b)) and 100 * both >= percent * (len(a) + len(b) - both))
                yield part.select(["a", "b"]).filter(pa.array(found, pa.bool_()))

    return run, "a long, b long"


_CELL = ("bucket", "i", "j")


def _whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by cell; a cell may go over several batches."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        keys = np.stack([np.asarray(batch.column(x)) for x in _CELL], axis=1)
        edges = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)]])
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if a == b:
                continue
            if held and tuple(keys[a]) != now:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
            now = tuple(keys[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _sides(cell: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the left and the right members of a cell, and all members' components."""
    left = np.asarray(cell.column("left"))
    return np.flatnonzero(left), np.flatnonzero(~left), np.asarray(cell.column("component"))


def _alike(least: float):
    """The rows of each cell whose signatures agree enough with one of the other side and another component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _whole_cells(batches):
            left, right, component = _sides(cell)
            sig, met = _matrix(cell.column("sig")), np.zeros(cell.num_rows, dtype=bool)
            for low in range(0, len(left), 16):
                some = left[low : low + 16]
                alike = (sig[some][:, None, :] == sig[right][None, :, :]).mean(axis=2) >= least
                alike &= component[some][:, None] != component[right][None, :]
                met[some] = alike.any(axis=1)
                met[right] |= alike.any(axis=0)
            yield cell.drop_columns(["sig"]).filter(pa.array(met))

    return run, "bucket long, i long, j long, doc long, component long, left boolean"


def _root(parent: list[int], i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def _joining(k: int, percent: int):
    """Links between the sides of each cell, on full sets, as few as join the components."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def shared(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """How many shingles each left and right member have in common."""
        of = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        known, code = np.unique(np.concatenate(sets), return_inverse=True)
        place = np.full(len(known), -1)
        both = np.flatnonzero(np.bincount(code, minlength=len(known)) > 1)
        place[both] = np.arange(len(both))
        order = np.argsort(place[code], kind="stable")
        of, at = of[order], place[code][order]
        row = np.empty(len(sets), dtype=np.int64)
        row[left], row[right] = np.arange(len(left)), np.arange(len(right))
        is_left = np.zeros(len(sets), dtype=bool)
        is_left[left] = True
        out = np.zeros((len(left), len(right)), dtype=np.float32)
        for low in range(0, len(both), 4096):  # some shingles at a time
            a, b = np.searchsorted(at, [low, low + 4096])
            here, column = of[a:b], at[a:b] - low
            x, y = np.zeros((len(left), 4096), dtype=np.float32), np.zeros((len(right), 4096), dtype=np.float32)
            side = is_left[here]
            x[row[here[side]], column[side]] = 1
            y[row[here[~side]], column[~side]] = 1
            out += x @ y.T
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _whole_cells(batches):
            left, right, component = _sides(cell)
            if not len(left) or not len(right):
                continue
            sets: list[np.ndarray] = []
            for c in W.chunks(cell.column("text"), lower=True):
                grams, at = _shingles(c, k)
                sets += np.split(grams, at[1:-1])
            size = np.array([len(x) for x in sets])
            common = shared(sets, left, right).astype(np.int64)
            hit = 100 * common >= percent * (size[left][:, None] + size[right][None, :] - common)
            parent = list(range(cell.num_rows))
            first: dict[int, int] = {}
            for i, x in enumerate(component.tolist()):
                parent[i] = first.setdefault(x, i)
            doc, found = np.asarray(cell.column("doc")), []
            for a, b in zip(*np.nonzero(hit & (component[left][:, None] != component[right][None, :])), strict=True):
                a, b = int(left[a]), int(right[b])
                p, q = _root(parent, a), _root(parent, b)
                if p != q:
                    parent[max(p, q)] = min(p, q)
                    found.append((doc[a], doc[b]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], schema=schema)

    return run, "u long, v long"


def _across(open_: DataFrame, sigs: DataFrame, known: DataFrame, k: int, percent: int, least: float) -> DataFrame:
    """Links ``u, v`` between components of ``open_(bucket, doc, n, component, outside)``."""
    n = int(open_.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = lambda rows, shingles: F.ceil(F.greatest(rows / BLOCK, shingles / BLOCK_SHINGLES))
    blocks = open_.groupBy("bucket").agg(
        parts(F.count("*"), F.sum("n")).alias("all_blocks"),
        parts(F.count_if("outside"), F.sum(F.when(F.col("outside"), F.col("n")))).alias("out_blocks"),
    )
    dealt = open_.join(blocks, "bucket").withColumns(
        {"j": F.pmod(F.xxhash64("doc"), "all_blocks"), "i": F.when(F.col("outside"), F.pmod(F.xxhash64("doc", F.lit(1)), "out_blocks"))}
    )
    places = lambda blocks: F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1))
    right = dealt.select("bucket", places("out_blocks").alias("i"), "j", "doc", "component", F.lit(False).alias("left"))
    left = dealt.filter("outside").select("bucket", "i", places("all_blocks").alias("j"), "doc", "component", F.lit(True).alias("left"))
    cells = left.unionByName(right).join(sigs, "doc").select(*_CELL, "doc", "component", "left", "sig")
    met = cells.repartition(n, *_CELL).sortWithinPartitions(*_CELL).mapInArrow(*_alike(least))
    texts = cut(met, "alike").join(known.hint("merge"), "doc").select(*_CELL, "doc", "component", "left", "text")
    return texts.repartition(n, *_CELL).sortWithinPartitions(*_CELL).mapInArrow(*_joining(k, percent))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, bands: int = 24, rows: int = 5) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs(doc_id, text, ...)``; other columns are dropped.

    Documents are linked if their sets of ``k``-word shingles (A-Z lower-cased; a shorter text is one shingle) have
    100 * intersection >= ``percent`` * union.  ``component_id`` is the smallest id that links lead to.  Documents
    without words (null, empty or white texts) have no shingles and are linked with nothing.  Rows with a null id can't be
    named: they are kept, with a null component.  Rows that repeat an id share its component; if their texts differ, the one
    with the smallest hash stands for the id.  An empty table gives an empty table.
    """
    bound_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), "text")
    texts = texts.withColumn("print", F.xxhash64("text"))
    signed = cut(texts.mapInArrow(*_sign(k, bands, rows)), "signatures")
    named, whole = signed.filter("doc is not null"), texts.filter("doc is not null").select("doc", "text")
    repeated = named.count() > named.select("doc").distinct().count()
    if repeated:
        named = named.groupBy("doc").agg(
            F.min_by(F.struct(*(c for c in named.columns if c != "doc")), "print").alias("x")
        ).select("doc", "x.*")
        whole = texts.filter("doc is not null").groupBy("doc").agg(F.min_by("text", "print").alias("text"))
    named = named.filter("n_shingles > 0")
    chosen = F.min_by(F.struct(F.col("n_shingles").alias("n"), "sig", "bands"), "doc").alias("x")
    classes = cut(named.groupBy("digest").agg(F.min("doc").alias("rep"), chosen).select("digest", "rep", "x.*"), "classes")

    member = classes.select(F.col("rep").alias("doc"), "n", F.explode("bands").alias("bucket"))
    bucket = member.groupBy("bucket").agg(F.count("*").alias("members"), F.min("doc").alias("leader")).filter("members > 1")
    shared = cut(member.join(bucket.drop("members"), "bucket"), "buckets")
    least = percent / 100 - 5 * (percent / 100 * (1 - percent / 100) / (bands * rows)) ** 0.5
    # what the candidates need: their texts, which no join may shuffle again with those of all others, and their signatures
    wanted = shared.select("doc").distinct()
    known = cut(whole.join(wanted.hint("merge"), "doc", "left_semi"), "candidates")
    sigs = cut(classes.select(F.col("rep").alias("doc"), "sig").join(wanted.hint("merge"), "doc", "left_semi"), "candidates")

    def confirmed(likely: DataFrame) -> DataFrame:
        """Links ``u, v`` of the pairs ``a, b``."""
        text_a = known.select(F.col("doc").alias("a"), F.col("text").alias("text_a"))
        text_b = known.select(F.col("doc").alias("b"), F.col("text").alias("text_b"))
        both = likely.join(text_a.hint("merge"), "a").join(text_b.hint("merge"), "b").select("a", "b", "text_a", "text_b")
        return both.mapInArrow(*_confirm(k, percent)).select(F.col("a").alias("u"), F.col("b").alias("v"))

    pairs = shared.filter("doc <> leader").select(F.col("leader").alias("a"), F.col("doc").alias("b")).distinct()
    with_a = pairs.join(sigs.select(F.col("doc").alias("a"), F.col("sig").alias("sig_a")), "a")
    with_both = with_a.join(sigs.select(F.col("doc").alias("b"), F.col("sig").alias("sig_b")), "b")
    likely = cut(with_both.select("a", "b", "sig_a", "sig_b").mapInArrow(*_likely(least)), "likely")
    links = cut(confirmed(likely), "links")
    forget(likely)
    so_far = components(links)
    forget(links)

    # buckets that still hold several components
    placed = shared.select("bucket", "doc", "n").join(
        so_far.withColumnRenamed("node", "doc"),
        "doc",
        "left",
    ).withColumn("component", F.coalesce("component", "doc"))
    parts = placed.groupBy("bucket", "component").agg(F.count("*").alias("part"))
    main = parts.groupBy("bucket").agg(
        F.count("*").alias("parts"),
        F.max_by("component", F.struct("part", -F.col("component"))).alias("main"),
    ).filter("parts > 1")
    open_ = cut(
        placed.join(main, "bucket").select("bucket", "doc", "n", "component", (F.col("component") != F.col("main")).alias("outside")),
        "open",
    )
    more = cut(_across(open_, sigs, known, k, percent, least), "links")
    for table in (shared, open_, sigs, known):
        forget(table)
    final = so_far
    if more.limit(1).count():
        final = components(so_far.select(F.col("node").alias("u"), F.col("component").alias("v")).union(more))
        forget(so_far)
    forget(more)
    reps = classes.select("digest", "rep").join(final.select(F.col("node").alias("rep"), "component"), "rep", "left")
    reps = reps.select("digest", F.coalesce("component", "rep").alias("component"))
    own = signed.select("doc", "n_shingles")
    if repeated:
        own = own.join(named.select("doc", "digest"), "doc", "left")
    else:  # a row without an id or without words has no class
        own = signed.select(
            "doc",
            "n_shingles",
            F.when(F.col("doc").isNotNull() & (F.col("n_shingles") > 0), F.col("digest")).alias("digest"),
        )
    out = own.join(reps, "digest", "left")
    return out.select(
        F.col("doc").alias("doc_id"),
        "n_shingles",
        F.coalesce("component", "doc").alias("component_id"),
        F.coalesce(F.coalesce("component", "doc") == F.col("doc"), F.lit(True)).alias("kept"),
    )
