"""Interpolated modified Kneser-Ney model of order two or three, counted in Spark and scored from memory-mapped sorted arrays.

Training, each step over all training texts:

1.  every task counts its words (sorted 64-bit hashes) and sends one block per bucket of hashes; each bucket merges its
    blocks into one sorted array.  A word's id is its place in all buckets together;
2.  every task maps words to ids through the memory-mapped arrays and counts bigrams ``context id * size + word id``.  They
    go to buckets by context, those of very frequent contexts by word too, so that no word makes a bucket large;
    each bucket stores its sorted keys and counts, and passes on sums per context and per word (continuations);
3.  these sums meet by ranges of ids and are stored as plain arrays that are indexed by id.

At order three the texts are read once for trigrams in place of bigrams.  Trigrams travel once, as compressed differences, to
buckets by their middle word (frequent ones by the first word too), where all trigrams of a context lie together.  Each bucket
stores its trigrams and passes on, for every pair of last two words, how many first words it has seen; these continuations
take the place of the bigram counts in step 2.  Nothing comes before a text's beginning, so bigrams there keep their own counts, and
a text's first word is scored by them.

All stored counts have 64 bits.  There are as many buckets as shuffle partitions, and more where the texts have over
``BUCKET_BYTES`` a bucket, so that what a task merges does not grow with the input.  Words are told apart by a 64-bit hash: two
words among a thousand million are the same by chance once in some forty corpora.  Up to 2**32 - 4 distinct words are taken.

Between the steps only the sizes of buckets and a few count-of-count sums reach the driver.  Array files lie in the shared
folder, which every worker must have mounted; they are written whole or not at all, so a lost executor's tasks repeat
without harm.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words as W
from .storage import bound_batches, cut, local_path, scratch

#: A task passes its counts on when so many ids have gathered.
HELD = 4_000_000
#: Bytes of training text for a bucket, at most.
BUCKET_BYTES = 48 << 20
#: Tokens whose trigrams are counted at once; three ranks among their distinct words fit 63 bits.
GRAMS = 2_000_000
#: The sums of a context with more followers than this are stored; those of others are summed when they are asked for.
HEAVY = 256
#: Bits of a stored trigram's key; a word's id may have up to half.
KEY_BITS = 64
#: Trigrams are scored in chunks of so many bytes, as each chunk visits most buckets.
SCORED = 2 << 20


@dataclass
class Model:
    """Where the arrays lie, and the numbers that are not arrays."""

    folder: str
    buckets: int
    sizes: list[int]  # distinct words by bucket
    tokens: int  # training tokens, ends included
    texts: int
    bigrams: int = 0  # distinct
    discounts2: tuple[float, float, float] = (0.0, 0.0, 0.0)
    discounts1: tuple[float, float, float] = (0.0, 0.0, 0.0)
    frequent: tuple[int, ...] = ()  # ids of contexts that are dealt by word too
    order: int = 2
    trigrams: int = 0  # distinct
    discounts3: tuple[float, float, float] = (0.0, 0.0, 0.0)
    kinds: tuple[int, int, int] = (0, 0, 0)  # words with one, two, and more continuations

    @property
    def words(self) -> int:
        return sum(self.sizes)

    @property
    def end(self) -> int:
        """Id of a text's end; the next one stands for its beginning, and the one after for all unknown words."""
        return self.words

    @property
    def begin(self) -> int:
        return self.words + 1

    @property
    def size(self) -> int:
        return self.words + 3


def _save(folder: str, name: str, array: np.ndarray, attempt: int) -> None:
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/.{name}.{attempt}", "wb") as f:
        f.write(np.ascontiguousarray(array).tobytes())
    os.replace(f"{folder}/.{name}.{attempt}", f"{folder}/{name}")


@lru_cache(maxsize=4096)
def _mapped(path: str, kind: str) -> np.ndarray:
    return np.memmap(path, dtype=kind, mode="r") if os.path.getsize(path) else np.zeros(0, dtype=kind)


def _save_counts(folder: str, name: str, large: str, bucket: int, counts: np.ndarray) -> None:
    """Counts as bytes, and those of 255 or more with their places."""
    _save(folder, f"{name}-{bucket}", np.minimum(counts, 255).astype(np.uint8), _attempt())
    high = np.flatnonzero(counts >= 255)
    _save(folder, f"{large}-{bucket}", np.stack([high, counts[high]], axis=1).astype("<i8"), _attempt())


def _stored(folder: str, name: str, large: str, bucket: int, places: np.ndarray) -> np.ndarray:
    """The counts at some places."""
    out = np.asarray(_mapped(f"{folder}/{name}-{bucket}", "u1"))[places].astype(np.int64)
    high = out == 255
    if high.any():
        at = np.asarray(_mapped(f"{folder}/{large}-{bucket}", "<i8")).reshape(-1, 2)
        out[high] = at[np.searchsorted(at[:, 0], places[high]), 1]
    return out


def _attempt() -> int:
    from pyspark import TaskContext

    return TaskContext.get().taskAttemptId()


def _sum_sorted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[begin], np.add.reduceat(counts, begin) if len(keys) else counts


_BLOCK = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
_BLOCK_DDL = "bucket int, keys binary, counts binary"


def _blocks(bucket: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row for each bucket, its keys in order."""
    if not len(keys):
        return
    order = np.lexsort((keys, bucket))
    bucket, keys, counts = bucket[order], keys[order], counts[order].astype(np.uint32)  # of one task's texts
    ids = np.unique(bucket)
    begin = np.searchsorted(bucket, ids)
    end = np.append(begin[1:], len(bucket))
    pairs = list(zip(begin.tolist(), end.tolist(), strict=True))
    if len(ids):
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids.astype(np.int32)),
                pa.array([keys[a:b].tobytes() for a, b in pairs], pa.binary()),
                pa.array([counts[a:b].tobytes() for a, b in pairs], pa.binary()),
            ],
            schema=_BLOCK,
        )


class _Sum:
    """Sums counts by key, folding what it holds now and then."""

    def __init__(self, kind=np.uint64):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.kind, self.held = kind, 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, counts))
        self.held += len(keys)
        if self.held > 2 * HELD and len(self.parts) > 1:
            self.parts = [self.total()]
            self.held = len(self.parts[0][0])

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, dtype=self.kind), np.zeros(0, dtype=np.int64)
        return _sum_sorted(np.concatenate([x[0] for x in self.parts]), np.concatenate([x[1] for x in self.parts]))


def _bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of hashes, so that all buckets in turn are sorted."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _count_words(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = _Sum()
        for batch in batches:
            for c in W.chunks(batch.column("text"), lower=True):
                total.add(*np.unique(c.hashes(), return_counts=True))
                if total.held > 4 * HELD:
                    keys, counts = total.total()
                    yield from _blocks(_bucket_of(keys, buckets), keys, counts)
                    total = _Sum()
        keys, counts = total.total()
        yield from _blocks(_bucket_of(keys, buckets), keys, counts)

    return run, _BLOCK_DDL


def _grouped(batches: Iterator[pa.RecordBatch], kind) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Sums of the blocks of each bucket; rows come sorted by bucket."""
    now, total = None, _Sum(kind)
    for batch in batches:
        for bucket, keys, counts in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if now is not None and bucket != now:
                yield now, *total.total()
                total = _Sum(kind)
            now = bucket
            total.add(np.frombuffer(keys, dtype=kind), np.frombuffer(counts, dtype=np.uint32).astype(np.int64))
    if now is not None:
        yield now, *total.total()


def _store_words(folder: str, often: float):
    """often: a word with more than this share of its bucket's tokens is a candidate for a frequent context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, keys, counts in _grouped(batches, np.uint64):
            _save(folder, f"words-{bucket}", keys, _attempt())
            _save(folder, f"counts-{bucket}", counts.astype("<i8"), _attempt())
            top = np.argsort(-counts)[:4]
            yield pa.RecordBatch.from_pydict(
                {
                    "bucket": pa.array([bucket], pa.int32()),
                    "n": pa.array([len(keys)], pa.int64()),
                    "tokens": pa.array([int(counts.sum())], pa.int64()),
                    "top": pa.array(
                        [[{"at": int(i), "count": int(counts[i])} for i in top]],
                        pa.list_(pa.struct([("at", pa.int64()), ("count", pa.int64())])),
                    ),
                }
            )

    return run, "bucket int, n long, tokens long, top array<struct<at:long,count:long>>"


class _Vocabulary:
    """Ids and counts of words, from the memory-mapped arrays of a model."""

    def __init__(self, model: Model):
        self.model = model
        self.base = np.concatenate([[0], np.cumsum(model.sizes)]).astype(np.int64)

    def ids(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        m = self.model
        unique, inverse = np.unique(hashes, return_inverse=True)
        ids = np.full(len(unique), m.end + 2, dtype=np.int64)
        counts = np.zeros(len(unique), dtype=np.int64)
        buckets, edges = np.unique(_bucket_of(unique, m.buckets), return_index=True)
        for b, low, high in zip(buckets.tolist(), edges.tolist(), np.append(edges, len(unique))[1:].tolist(), strict=True):
            part = slice(low, high)
            if not m.sizes[b]:
                continue
            known = _mapped(f"{m.folder}/words-{b}", "<u8")
            at = np.minimum(np.searchsorted(known, unique[part]), len(known) - 1)
            hit = known[at] == unique[part]
            ids[part] = np.where(hit, self.base[b] + at, m.end + 2)
            counts[part] = np.where(hit, _mapped(f"{m.folder}/counts-{b}", "<i8")[at], 0)
        return ids[inverse], counts[inverse]

    def sequences(self, c: W.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of a chunk's tokens, each text with its end, their counts, and where each text begins."""
        ids, counts = self.ids(c.hashes())
        n = c.n_words + 1
        begin = np.cumsum(n) - n
        all_ids = np.full(int(n.sum()), self.model.end, dtype=np.int64)
        all_counts = np.full(int(n.sum()), self.model.texts, dtype=np.int64)
        place = W.ragged_arange(begin, c.n_words)
        all_ids[place], all_counts[place] = ids, counts
        return all_ids, all_counts, begin


def _contexts(m: Model, ids: np.ndarray, begin: np.ndarray) -> np.ndarray:
    before = np.empty(len(ids), dtype=np.int64)
    before[1:] = ids[:-1]
    before[begin] = m.end + 1
    return before


def _bigram_bucket(m: Model, context: np.ndarray, word: np.ndarray) -> np.ndarray:
    own = context * m.buckets // m.size
    spread = np.isin(context, np.array(m.frequent, dtype=np.int64))
    return np.where(spread, (own + W.mix(word.astype(np.uint64)) % np.uint64(m.buckets)).astype(np.int64) % m.buckets, own)


def _count_bigrams(m: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, total = _Vocabulary(m), _Sum(np.int64)

        def out() -> Iterator[pa.RecordBatch]:
            keys, counts = total.total()
            yield from _blocks(_bigram_bucket(m, keys // m.size, keys % m.size), keys, counts)

        for batch in batches:
            for c in W.chunks(batch.column("text"), lower=True):
                ids, _, begin = vocabulary.sequences(c)
                total.add(*np.unique(_contexts(m, ids, begin) * m.size + ids, return_counts=True))
                if total.held > 4 * HELD:
                    yield from out()
                    total = _Sum(np.int64)
        yield from out()

    return run, _BLOCK_DDL


_PACKED = pa.schema([("bucket", pa.int32()), ("body", pa.binary())])
_PACKED_DDL = "bucket int, body binary"
#: Columns of a packed block: differences of contexts (or of pairs), last words, counts.
_PLANES = ("<i8", "<u4", "<i8")


def _packed(bucket: np.ndarray, contexts: np.ndarray, words: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row for each bucket, compressed by byte planes; the contexts come in order."""
    if not len(contexts):
        return
    order = np.argsort(bucket, kind="stable")
    bucket, contexts, words, counts = bucket[order], contexts[order], words[order], counts[order]
    ids, begin = np.unique(bucket, return_index=True)
    bodies = []
    for a, b in zip(begin.tolist(), np.append(begin[1:], len(bucket)).tolist(), strict=True):
        columns = [x.astype(kind) for x, kind in zip((np.diff(contexts[a:b], prepend=0), words[a:b], counts[a:b]), _PLANES, strict=True)]
        raw = b"".join(np.ascontiguousarray(x.view(np.uint8).reshape(b - a, -1).T).tobytes() for x in columns)
        bodies.append((b - a).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True))
    yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int32)), pa.array(bodies, pa.binary())], schema=_PACKED)


def _unpacked(body: bytes) -> list[np.ndarray]:
    n = int.from_bytes(body[:8], "little")
    raw = np.frombuffer(
        pa.decompress(body[8:], decompressed_size=sum(np.dtype(x).itemsize for x in _PLANES) * n, codec="zstd", asbytes=True),
        dtype=np.uint8,
    )
    out, at = [], 0
    for kind in _PLANES:
        width = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(raw[at : at + width * n].reshape(width, n).T).view(kind)[:, 0].astype(np.int64))
        at += width * n
    out[0] = np.cumsum(out[0])
    return out


def _packed_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Distinct contexts with words of each bucket in order, and their sums; rows come sorted by bucket."""

    def total(parts: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        contexts, words, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
        known, rank = np.unique(contexts, return_inverse=True)
        keys, counts = _sum_sorted((rank.astype(np.uint64) << np.uint64(32)) | words.astype(np.uint64), counts)
        return known[(keys >> np.uint64(32)).astype(np.int64)], (keys & np.uint64(0xFFFFFFFF)).astype(np.int64), counts

    now, parts = None, []
    for batch in batches:
        for bucket, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if now is not None and bucket != now:
                yield now, *total(parts)
                parts = []
            now = bucket
            parts.append(_unpacked(body))
    if now is not None:
        yield now, *total(parts)


def _count_trigrams(m: Model):
    def counted(tokens: np.ndarray, skip: int) -> Iterator[pa.RecordBatch]:
        """Trigrams that end after the first ``skip`` tokens."""
        known, rank = np.unique(tokens, return_inverse=True)
        k = len(known)
        at = np.flatnonzero(tokens != m.begin)
        at = at[at >= skip]
        v = rank[at - 1]
        u = np.where(tokens[at - 1] == m.begin, v, rank[np.maximum(at - 2, 0)])
        keys, counts = np.unique((v * k + u) * k + rank[at], return_counts=True)
        u, v, w = known[keys // k % k], known[keys // k // k], known[keys % k]
        yield from _packed(_bigram_bucket(m, v, np.where(v == m.begin, w, u)), v * m.size + u, w, counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, held, n = _Vocabulary(m), [], 0

        def out() -> Iterator[pa.RecordBatch]:
            tokens = np.concatenate(held) if held else np.zeros(0, dtype=np.int64)
            for a in range(0, len(tokens), GRAMS):
                low = max(a - 2, 0)
                yield from counted(tokens[low : a + GRAMS], a - low)

        for batch in batches:
            for c in W.chunks(batch.column("text"), lower=True):
                ids, _, begin = vocabulary.sequences(c)
                if n + len(ids) + len(begin) > GRAMS:
                    yield from out()
                    held, n = [], 0
                held.append(np.insert(ids, begin, m.begin))
                n += len(held[-1])
        yield from out()

    return run, _PACKED_DDL


def _store_trigrams(m: Model, hist: str):
    """Per bucket: sorted trigrams and counts to files; continuations of the last two words to the buckets of bigrams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, contexts, words, counts in _packed_groups(batches):
            middle = contexts // m.size
            pairs, back = np.unique(middle * m.size + words, return_inverse=True)
            seen = np.bincount(back, weights=np.where(middle == m.begin, counts, 1)).astype(np.int64)
            yield from _packed(_bigram_bucket(m, pairs // m.size, pairs % m.size), pairs, np.zeros(len(pairs), dtype=np.int64), seen)
            inner = middle != m.begin
            contexts, words, counts, middle = contexts[inner], words[inner], counts[inner], middle[inner]
            middles, begin, rank = np.unique(middle, return_index=True, return_inverse=True)
            _save(m.folder, f"middles-{bucket}", np.stack([middles, begin], axis=1).astype("<i8"), _attempt())
            _save(m.folder, f"trigrams-{bucket}", _trigram_keys(m, len(middles), rank, contexts % m.size, words), _attempt())
            _save_counts(m.folder, "triples", "large", bucket, counts)
            context, begin, n = np.unique(contexts, return_index=True, return_counts=True)
            heavy = n > HEAVY
            sums = _context_sums(counts, begin[heavy], n[heavy])
            _save(m.folder, f"heavy-{bucket}", np.concatenate([context[heavy][:, None], sums], axis=1).astype("<i8"), _attempt())
            classes = np.bincount(np.minimum(counts, 5), minlength=6)
            _save(f"{m.folder}/{hist}", f"{bucket}", np.append(classes[1:5], len(counts)).astype("<i8"), _attempt())

    return run, _PACKED_DDL


def _fits(m: Model, n_middles: int) -> bool:
    """Whether the place of the middle word among its bucket's fits into a key with both others."""
    return 2 * m.size.bit_length() + n_middles.bit_length() <= KEY_BITS


def _trigram_keys(m: Model, n_middles: int, rank: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """In order in all of a bucket, or in each middle word's part of it where the middle word does not fit."""
    bits = m.size.bit_length()
    keys = (first.astype(np.uint64) << np.uint64(bits)) | last.astype(np.uint64)
    return keys | (rank.astype(np.uint64) << np.uint64(2 * bits)) if _fits(m, n_middles) else keys


def _context_sums(counts: np.ndarray, begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Total and number of counts of one, two and more, of slices of ``counts`` that are not empty."""
    if not len(begin):
        return np.zeros((0, 4), dtype=np.int64)
    x, at = counts[W.ragged_arange(begin, n)], np.cumsum(n) - n
    return np.stack([np.add.reduceat(y.astype(np.int64), at) for y in (x, x == 1, x == 2, x >= 3)], axis=1)


_SUMS = pa.schema([("range", pa.int32()), ("side", pa.int32()), ("ids", pa.binary()), ("sums", pa.binary())])


def _pair_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for bucket, pairs, _, counts in _packed_groups(batches):
        yield bucket, pairs, counts


def _store_bigrams(m: Model, hist: str):
    """Per bucket: sorted keys and counts to files; sums per context and continuations per word by ranges of ids."""

    def sums(side: int, ids: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(ids):
            return
        at = ids * m.buckets // m.size
        found = np.unique(at)
        begin = np.searchsorted(at, found)
        pairs = list(zip(begin.tolist(), np.append(begin[1:], len(at)).tolist(), strict=True))
        if len(found):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(found.astype(np.int32)),
                    pa.array([side] * len(found), pa.int32()),
                    pa.array([ids[a:b].tobytes() for a, b in pairs], pa.binary()),
                    pa.array([values[a:b].astype("<i8").tobytes() for a, b in pairs], pa.binary()),
                ],
                schema=_SUMS,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, keys, counts in _grouped(batches, np.int64) if m.order == 2 else _pair_groups(batches):
            _save(m.folder, f"keys-{bucket}", keys, _attempt())
            _save_counts(m.folder, "pairs", "frequent", bucket, counts)
            classes = np.bincount(np.minimum(counts, 5), minlength=6)
            _save(f"{m.folder}/{hist}", f"{bucket}", np.append(classes[1:5], len(keys)).astype("<i8"), _attempt())
            context = keys // m.size
            begin = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
            columns = [np.add.reduceat(x, begin) for x in (counts, counts == 1, counts == 2, counts >= 3)]
            yield from sums(0, context[begin], np.stack([x.astype(np.int64) for x in columns], axis=1))
            word, seen = np.unique(keys % m.size, return_counts=True)
            yield from sums(1, word, seen[:, None])

    return run, "range int, side int, ids binary, sums binary"


def _range_bounds(m: Model, at: int) -> tuple[int, int]:
    """First id of a range of ids and of the next one."""
    return -(-at * m.size // m.buckets), -(-(at + 1) * m.size // m.buckets)


def _store_sums(m: Model):
    """Arrays indexed by id: for contexts total and discount classes, for words their continuations."""

    def close(at: int, contexts: np.ndarray, follows: np.ndarray) -> pa.RecordBatch:
        _save(m.folder, f"contexts-{at}", contexts.astype("<i8"), _attempt())
        _save(m.folder, f"follows-{at}", follows.astype("<i8"), _attempt())
        n = np.bincount(np.minimum(follows, 5), minlength=6)
        return pa.RecordBatch.from_pydict(
            {"range": pa.array([at], pa.int32()), **{f"n{i}": pa.array([int(n[i])], pa.int64()) for i in range(1, 6)}}
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, low = None, 0
        for batch in batches:
            for at, side, ids, sums in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if at != now:
                    if now is not None:
                        yield close(now, contexts, follows)
                    now, (low, high) = at, _range_bounds(m, at)
                    contexts, follows = np.zeros((high - low, 4), dtype=np.int64), np.zeros(high - low, dtype=np.int64)
                place = np.frombuffer(ids, dtype=np.int64) - low
                values = np.frombuffer(sums, dtype="<i8")
                if side:
                    follows[place] += values  # a block has an id once
                else:
                    contexts[place] += values.reshape(-1, 4)
        if now is not None:
            yield close(now, contexts, follows)

    return run, "range int, n1 long, n2 long, n3 long, n4 long, n5 long"


#: A key of two words is ``context * size + word`` in 63 bits, where ``size`` has three ids besides the words.
MOST_WORDS = 3_037_000_496

_TRIGRAM_FILES = ("trigrams", "triples", "large", "middles", "heavy")


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """The three discounts of modified Kneser-Ney; where counts of counts are missing, half of each bound."""
    if min(n1, n2, n3, n4) <= 0:
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    return tuple(min(max(d, 0.01), top) for d, top in ((1 - 2 * y * n2 / n1, 1.0), (2 - 3 * y * n3 / n2, 2.0), (3 - 4 * y * n4 / n3, 3.0)))


def _complete(m: Model):
    """Empty arrays for the buckets that got no rows, and the sums of all buckets' numbers of counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 5), dtype=np.int64)
        for batch in batches:
            for b in batch.column("id").to_pylist():
                low, high = _range_bounds(m, b)
                sizes = {"contexts": 32 * (high - low), "follows": 8 * (high - low)}
                for name in ("keys", "pairs", "frequent", "contexts", "follows", *(_TRIGRAM_FILES if m.order == 3 else ())):
                    if not os.path.exists(f"{m.folder}/{name}-{b}"):
                        _save(m.folder, f"{name}-{b}", np.zeros(sizes.get(name, 0), dtype=np.uint8), _attempt())
                for row, hist in zip(sums, ("classes", "classes3"), strict=True):
                    if os.path.exists(f"{m.folder}/{hist}/{b}"):
                        row += np.fromfile(f"{m.folder}/{hist}/{b}", dtype="<i8")
        yield pa.RecordBatch.from_arrays([pa.array([int(x)]) for x in sums.ravel()], [f"c{i}" for i in range(10)])

    return run, ", ".join(f"c{i} long" for i in range(10))


def train(docs: DataFrame, training: Column, order: int = 2) -> Model:
    """Counts the model over the rows of ``docs(text)`` for which ``training`` holds.

    Null texts are empty ones, repeated rows count each, and no rows give a model without words.  Where a count of counts
    is missing, as in very small corpora, the discounts of that order are 0.5, 1.0 and 1.5.
    """
    if order not in (2, 3):
        raise ValueError(f"order {order}: two or three")
    spark: SparkSession = docs.sparkSession
    bound_batches(spark)
    folder = local_path(scratch(spark, "kneser-ney"))
    os.makedirs(folder, exist_ok=True)
    texts = docs.filter(training).select("text")
    size = texts.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    n_texts, n = size["n"], max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size["bytes"] // BUCKET_BYTES))
    blocks = texts.mapInArrow(*_count_words(n)).repartition(n, "bucket").sortWithinPartitions("bucket")
    found = {r.bucket: r for r in cut(blocks.mapInArrow(*_store_words(folder, 0.1)), "words").collect()}
    sizes = [found[b].n if b in found else 0 for b in range(n)]
    if sum(sizes) > MOST_WORDS:
        raise ValueError(f"more than {MOST_WORDS} distinct words: keys of two words would not fit 63 bits")
    m = Model(folder, n, sizes, sum(r.tokens for r in found.values()) + n_texts, n_texts, order=order)
    base = np.concatenate([[0], np.cumsum(m.sizes)])
    often = [int(base[b] + x.at) for b, r in found.items() for x in r.top if x["count"] * 8 * n > m.tokens]
    m.frequent = tuple(sorted(often)) + (m.end + 1,)
    if order == 2:
        blocks = texts.mapInArrow(*_count_bigrams(m))
    else:
        blocks = cut(
            texts.mapInArrow(*_count_trigrams(m)).repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(*_store_trigrams(m, "classes3")),
            "pairs",
        )
    blocks = blocks.repartition(n, "bucket").sortWithinPartitions("bucket")
    sums = cut(blocks.mapInArrow(*_store_bigrams(m, "classes")), "sums")
    ranges = cut(sums.repartition(n, "range").sortWithinPartitions("range").mapInArrow(*_store_sums(m)), "ranges").collect()
    m.discounts1 = discounts(*(sum(r[f"n{i}"] for r in ranges) for i in range(1, 5)))
    n1, n2, *more = (sum(r[f"n{i}"] for r in ranges) for i in range(1, 6))
    m.kinds = (n1, n2, sum(more))
    numbers = spark.range(0, n, 1, min(n, 8 * spark.sparkContext.defaultParallelism))
    found = cut(numbers.mapInArrow(*_complete(m)), "classes").agg(*(F.sum(f"c{i}") for i in range(10))).first()
    m.discounts2, m.bigrams = discounts(*found[:4]), found[4]
    m.discounts3, m.trigrams = discounts(*found[5:9]), found[9]
    with open(f"{folder}/model.json", "w") as f:
        json.dump(asdict(m), f)
    return m


def _bisect(values: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """First place in each slice ``low:high`` of ``values``, sorted there, that is not less than what is wanted."""
    low, high = low.copy(), high.copy()
    while (wide := low < high).any():
        middle = (low + high) >> 1
        less = wide & (values[np.minimum(middle, len(values) - 1)] < wanted)
        low, high = np.where(less, middle + 1, low), np.where(wide & ~less, middle, high)
    return low


class _Scorer:
    def __init__(self, m: Model):
        self.m, self.vocabulary = m, _Vocabulary(m)

    def _by_id(self, name: str, ids: np.ndarray, columns: int) -> np.ndarray:
        m = self.m
        out = np.zeros((len(ids), columns), dtype=np.int64)
        at = ids * m.buckets // m.size
        for b in np.unique(at).tolist():
            mine = at == b
            out[mine] = _mapped(f"{m.folder}/{name}-{b}", "<i8").reshape(-1, columns)[ids[mine] - _range_bounds(m, b)[0]]
        return out

    def probability(self, keys: np.ndarray) -> np.ndarray:
        """Of the word after the context, for sorted distinct keys of bigrams."""
        m = self.m
        context, word = keys // m.size, keys % m.size
        words, back = np.unique(word, return_inverse=True)
        known = words != m.end + 2
        follows = np.zeros(len(words), dtype=np.int64)
        follows[known] = self._by_id("follows", words[known], 1)[:, 0]
        if m.bigrams:
            # unigrams: continuations, discounted, interpolated with an even share for each known word and an unknown one
            kinds = np.array(self.m.kinds)
            d = np.array((0.0, *m.discounts1))
            lower = (follows - d[np.minimum(follows, 3)]) / m.bigrams + float(d[1:] @ kinds) / m.bigrams / (m.words + 2)
        else:
            lower = np.full(len(words), 1.0 / (m.words + 2))
        lower = lower[back]
        counts = np.zeros(len(keys), dtype=np.int64)
        bucket = _bigram_bucket(m, context, word)
        for b in np.unique(bucket).tolist():
            mine = np.flatnonzero(bucket == b)
            stored = _mapped(f"{m.folder}/keys-{b}", "<i8")
            if len(stored):
                at = np.minimum(np.searchsorted(stored, keys[mine]), len(stored) - 1)
                hit = stored[at] == keys[mine]
                counts[mine[hit]] = _stored(m.folder, "pairs", "frequent", b, at[hit])
        contexts, back = np.unique(context, return_inverse=True)
        sums = np.zeros((len(contexts), 4), dtype=np.int64)
        known = contexts != m.end + 2
        sums[known] = self._by_id("contexts", contexts[known], 4)
        sums = sums[back]
        d = np.array((0.0, *m.discounts2))
        total = np.maximum(sums[:, 0], 1)
        high = (counts - d[np.minimum(counts, 3)]) / total
        rest = np.where(sums[:, 0] > 0, sums[:, 1:] @ d[1:] / total, 1.0)
        return high + rest * lower

    def with_trigrams(self, ids: np.ndarray, before: np.ndarray, begin: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Of each token after the two before it; ``lower`` has its probability after one, which stays for first words."""
        m = self.m
        inner = np.ones(len(ids), dtype=bool)
        inner[begin] = False
        at = np.flatnonzero(inner)
        contexts, back = np.unique(before[at] * m.size + before[at - 1], return_inverse=True)
        v, u = contexts // m.size, contexts % m.size
        sums, counts = np.zeros((len(contexts), 4), dtype=np.int64), np.zeros(len(at), dtype=np.int64)
        first, last, ranks = np.zeros((3, len(contexts)), dtype=np.int64)
        bucket = _bigram_bucket(m, v, u).astype(np.min_scalar_type(m.buckets))
        by_bucket = np.argsort(bucket, kind="stable")
        of_token = np.argsort(back)  # tokens of a context together, so that searches go on from place to place
        of_token = of_token[np.argsort(bucket[back[of_token]], kind="stable")]
        there = np.unique(bucket)
        edges = [np.append(np.searchsorted(x, there), len(x)) for x in (bucket[by_bucket], bucket[back[of_token]])]
        for i, b in enumerate(there.tolist()):
            keys, triples = np.asarray(_mapped(f"{m.folder}/trigrams-{b}", "<u8")), np.asarray(_mapped(f"{m.folder}/triples-{b}", "u1"))
            if not len(keys):
                continue
            large, heavy, middles = (
                np.asarray(_mapped(f"{m.folder}/{x}-{b}", "<i8")).reshape(-1, k) for x, k in (("large", 2), ("heavy", 5), ("middles", 2))
            )

            def exact(places: np.ndarray, triples=triples, large=large) -> np.ndarray:
                out = triples[places].astype(np.int64)
                big = out == 255
                out[big] = large[np.searchsorted(large[:, 0], places[big]), 1]
                return out

            mine = by_bucket[edges[0][i] : edges[0][i + 1]]
            head = np.searchsorted(middles[:, 0], v[mine])
            hit = middles[np.minimum(head, len(middles) - 1), 0] == v[mine]
            mine, head = mine[hit], head[hit]
            ends, k = np.append(middles[1:, 1], len(keys)), len(middles)
            search = (lambda low, high, x, keys=keys: np.searchsorted(keys, x)) if _fits(m, k) else (
                lambda low, high, x, keys=keys: _bisect(keys, low, high, x)
            )
            ranks[mine] = head
            low, high = middles[head, 1], ends[head]
            first[mine] = search(low, high, _trigram_keys(m, k, head, u[mine], np.zeros(len(mine))))
            last[mine] = search(low, high, _trigram_keys(m, k, head, u[mine], np.full(len(mine), m.size)))  # no word has this id
            n = last[mine] - first[mine]
            light = mine[(n > 0) & (n <= HEAVY)]
            n = last[light] - first[light]
            sums[light] = _context_sums(exact(W.ragged_arange(first[light], n)), np.cumsum(n) - n, n)
            rest = mine[last[mine] - first[mine] > HEAVY]
            sums[rest] = heavy[np.searchsorted(heavy[:, 0], contexts[rest]), 1:]
            tokens = of_token[edges[1][i] : edges[1][i + 1]]
            tokens = tokens[last[back[tokens]] > first[back[tokens]]]
            of = back[tokens]
            wanted = _trigram_keys(m, k, ranks[of], u[of], ids[at[tokens]])
            place = search(first[of], last[of], wanted)
            found = place < last[of]
            tokens, place, wanted = tokens[found], place[found], wanted[found]
            same = keys[place] == wanted
            counts[tokens[same]] = exact(place[same])
        d = np.array((0.0, *m.discounts3))
        total = np.maximum(sums[:, 0], 1)
        rest = np.where(sums[:, 0] > 0, sums[:, 1:] @ d[1:] / total, 1.0)
        out = lower.copy()
        out[at] = (counts - d[np.minimum(counts, 3)]) / total[back] + rest[back] * lower[at]
        return out


def _score(m: Model):
    schema_types = "n_tokens long, n_known long, base_score double, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(m)
        for batch in batches:
            rest = [i for i, f in enumerate(batch.schema) if f.name != "text"]
            for c in W.chunks(batch.column("text"), lower=True, limit=W.CHUNK_BYTES if m.order == 2 else SCORED):
                ids, counts, begin = scorer.vocabulary.sequences(c)
                before = _contexts(m, ids, begin)
                keys, back = np.unique(before * m.size + ids, return_inverse=True)
                p = scorer.probability(keys)[back]
                logs = np.log10(scorer.with_trigrams(ids, before, begin, p) if m.order == 3 else p)
                distinct = m.words + bool(m.texts)
                base = np.log10((counts + 1) / (m.tokens + distinct + 1))
                own = [batch.column(i).slice(c.row0, c.row1 - c.row0) for i in rest]
                sums = [
                    pa.array((c.n_words + 1).astype(np.int64)),
                    pa.array(np.add.reduceat((counts > 0).astype(np.int64), begin)),
                    pa.array(np.add.reduceat(base, begin)),
                    pa.array(np.add.reduceat(logs, begin)),
                ]
                yield pa.RecordBatch.from_arrays(
                    [*own, *sums],
                    names=[*(batch.schema[i].name for i in rest), "n_tokens", "n_known", "base_score", "score"],
                )

    return run, schema_types


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``n_tokens, n_known, base_score, score, perplexity`` in place of ``text`` and of columns of these names.

    A-Z are lower-cased; tokens are the words and one end; a null or empty text has the end alone.  ``score`` is the model's
    log10 probability of the text, ``base_score`` that of single words with one added to each count.  Null ids and repeated
    rows are scored like others.  An empty table gives an empty table; a model of no texts scores every token alike.
    """
    results = ("n_tokens", "n_known", "base_score", "score", "perplexity")
    rest = [f for f in docs.schema if f.name.lower() not in ("text", *results)]
    run, types = _score(model)
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest)
    out = docs.select(*(f"`{f.name}`" for f in rest), "text").mapInArrow(run, f"{own}, {types}")
    return out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
