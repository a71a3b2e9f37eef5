"""Words, word hashes and window hashes of whole Arrow text columns, computed with numpy on the UTF-8 bytes.

A word is a run of bytes other than ASCII white space (``[^\\x20\\x09-\\x0D]+``).  Everything works on chunks of
half a MB of whole documents, so that memory in a task is bounded by the chunk size or the longest single text.
Null texts count as empty.

Hashes take eight bytes at a time, each lane mixed into the lanes before it by multiplications and shifts, so that no
pattern of bytes cancels out; spans over 64 bytes are hashed by BLAKE2b.  Windows of words are hashed by doubling: the hash of
a window is a mixture of those of its two parts.  Hashes depend on bytes alone, so every executor gives the same value
for the same word.  Where a result must be exact, what is hashed is compared as well.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 512 << 10
_FACTORS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95))
_SEEDS = (np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344))
_LANES = 8
_FIRST_BYTES = np.array([(1 << 8 * i) - 1 for i in range(9)], dtype=np.uint64)

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def join(x: np.ndarray, y: np.ndarray, which: int = 0) -> np.ndarray:
    """Hash of two parts in this order."""
    return mix(x * _FACTORS[which] + _SEEDS[which] ^ y)


def digest(data: bytes, which: int = 0, size: int = 8) -> bytes:
    """A cryptographic hash of a long string."""
    return hashlib.blake2b(data, digest_size=size, salt=bytes([which])).digest()


def byte_hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """Hashes of ``buf[start:end]`` for many spans of bytes."""
    n = ends - starts
    out = mix(n.astype(np.uint64) + _SEEDS[which])
    padded = np.concatenate([buf, np.zeros(8, dtype=np.uint8)])
    eight = np.ndarray(len(buf) + 1, dtype="<u8", buffer=padded, strides=(1,))  # the eight bytes from each place on
    rows = np.flatnonzero((n > 0) & (n <= 8 * _LANES))
    for lane in range(_LANES):
        if not len(rows):
            break
        left = n[rows] - 8 * lane
        out[rows] = join(out[rows], eight[starts[rows] + 8 * lane] & _FIRST_BYTES[np.minimum(left, 8)], which)
        rows = rows[left > 8]
    for i in np.flatnonzero(n > 8 * _LANES).tolist():
        out[i] = int.from_bytes(digest(buf[starts[i] : ends[i]].tobytes(), which), "little")
    return out


def sequence_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """Hashes of ``values[start:end]`` for many short spans of word hashes, one step for each place."""
    n = ends - starts
    out = mix(n.astype(np.uint64) + _SEEDS[which])
    rows, at = np.flatnonzero(n > 0), 0
    while len(rows):
        out[rows] = join(out[rows], values[starts[rows] + at], which)
        at += 1
        rows = rows[n[rows] > at]
    return out


def window_hash(values: np.ndarray, k: int, which: int = 0) -> np.ndarray:
    """Hashes of all windows of ``k`` consecutive word hashes; empty if there are fewer."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out, size = None, 0  # windows of the size reached so far, from each place on
    block, width = values, 1
    while True:
        if k & width:
            out = block if out is None else join(out[: len(block) - size], block[size:], which)
            size += width
        if 2 * width > k:
            return out[:n]
        block = join(block[:-width], block[width:], which)
        width *= 2


def ragged_arange(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``concatenate([arange(s, s + n) for s, n in zip(starts, lengths)])``."""
    lengths = np.asarray(lengths, dtype=np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(starts, dtype=np.int64) - before, lengths)


def utf8_column(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and the ``len + 1`` offsets of its rows; nulls are empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null(b"" if pa.types.is_binary(array.type) or pa.types.is_large_binary(array.type) else "")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offsets, data = array.buffers()
    if not len(array) or offsets is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(array) + 1, dtype=np.int64)
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return buf, at


@dataclass
class Chunk:
    """Some consecutive rows of a batch and the words of their texts."""

    row0: int
    row1: int
    buf: np.ndarray  # bytes of these rows
    at: np.ndarray  # offsets of the rows in buf, one more than rows
    lower: bool
    _hashes: dict[int, np.ndarray] = field(default_factory=dict)

    def _inside(self) -> np.ndarray:
        """Which bytes belong to words."""
        return ~IS_SPACE[self.buf]

    @cached_property
    def _bounds(self) -> tuple[np.ndarray, np.ndarray]:
        inside = self._inside()
        edge = np.zeros(len(inside) + 1, dtype=bool)  # a text begins or ends here
        edge[self.at] = True
        before = np.empty(len(inside), dtype=bool)
        after = np.empty(len(inside), dtype=bool)
        if len(inside):
            before[0], before[1:] = True, ~inside[:-1]
            after[-1], after[:-1] = True, ~inside[1:]
        before |= edge[:-1]
        after |= edge[1:]
        return np.flatnonzero(inside & before), np.flatnonzero(inside & after) + 1

    @property
    def starts(self) -> np.ndarray:
        return self._bounds[0]

    @property
    def ends(self) -> np.ndarray:
        return self._bounds[1]

    @cached_property
    def first(self) -> np.ndarray:
        """Index of each row's first word, and at the end the number of words."""
        return np.searchsorted(self.starts, self.at)

    @cached_property
    def n_words(self) -> np.ndarray:
        return np.diff(self.first)

    @cached_property
    def data(self) -> np.ndarray:
        """The bytes as they are compared."""
        return LOWER[self.buf] if self.lower else self.buf

    def hashes(self, which: int = 0) -> np.ndarray:
        if which not in self._hashes:
            self._hashes[which] = byte_hash(self.data, self.starts, self.ends, which)
        return self._hashes[which]

    def codes(self) -> np.ndarray:
        """A number for each word, equal for equal words only (the words themselves are compared)."""
        if not len(self.starts):
            return np.zeros(0, dtype=np.int64)
        kind, wide = (pa.large_binary(), np.int64) if len(self.buf) > 1 << 30 else (pa.binary(), np.int32)
        edges = np.append(np.stack([self.starts, self.ends], axis=1).ravel(), len(self.buf)).astype(wide)
        parts = pa.Array.from_buffers(kind, len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(self.data))])
        return np.asarray(parts.dictionary_encode().indices)[::2].astype(np.int64)  # every second part is what lies between words

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.row1 - self.row0), self.n_words)

    def window_rows(self, k: int) -> np.ndarray:
        """For each window start of the chunk, whether all of its ``k`` words are in one row."""
        n = len(self.starts) - k + 1
        if n <= 0:
            return np.zeros(0, dtype=bool)
        return np.repeat(self.first[1:], self.n_words)[:n] >= np.arange(k, n + k)


def chunks(array: pa.Array, lower: bool = False, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cuts a text column into chunks of whole rows with up to ``limit`` bytes; a longer text is a chunk of its own."""
    buf, at = utf8_column(array)
    row, n = 0, len(at) - 1
    while row < n:
        end = int(np.searchsorted(at, at[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), n)
        yield Chunk(row, end, buf[at[row] : at[end]], at[row : end + 1] - at[row], lower)
        row = end
