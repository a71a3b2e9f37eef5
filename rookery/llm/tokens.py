"""Token ids of whole texts by a public tokenizer file, with every distinct word encoded once per worker.

The tokenizer of ``word_bpe_49k.json`` lower-cases, drops white space and never joins what white space parts, so the
ids of a text are those of its white-space-separated words in order.  Words are found with numpy; each new word is
encoded by the ``tokenizers`` library and kept in a bounded cache of the Python worker.  The cache is searched by hash and
the words themselves are compared; a word whose hash belongs to another one is encoded again each time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from . import words as W

CACHE_WORDS = 2_000_000
CHUNK_BYTES = 1 << 20
#: A word between the words of one call; words that have its character are encoded alone.
_BETWEEN = "~"
_CACHES: dict[tuple[str, bool], "WordTokens"] = {}


class _Grown:
    """An array that grows at its end, with room to spare."""

    def __init__(self, kind: type):
        self.data, self.n = np.zeros(1024, dtype=kind), 0

    def add(self, values: np.ndarray) -> None:
        if self.n + len(values) > len(self.data):
            wider = np.zeros(max(2 * len(self.data), self.n + len(values)), dtype=self.data.dtype)
            wider[: self.n] = self.data[: self.n]
            self.data = wider
        self.data[self.n : self.n + len(values)] = values
        self.n += len(values)


class _Sorted:
    """Sorted hashes and the slots of their words."""

    def __init__(self) -> None:
        self.keys, self.slots = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int32)

    def add(self, keys: np.ndarray, slots: np.ndarray) -> None:
        """Sorted keys, none of them here."""
        at = np.searchsorted(self.keys, keys)
        self.keys, self.slots = np.insert(self.keys, at, keys), np.insert(self.slots, at, slots)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slots, -1 for what is not here."""
        if not len(self.keys):
            return np.full(len(keys), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.slots[at], -1).astype(np.int64)


class WordTokens:
    """Ids of words, by the words' hashes.  New words join a small sorted table that is merged into a large one now and then."""

    def __init__(self, path: str, ordinary: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = ordinary  # special tokens' strings in a text are then ordinary text
        between = self.tokenizer.encode(_BETWEEN, add_special_tokens=False).ids
        self.between = between[0] if len(between) == 1 else None
        self._clear()

    def _clear(self) -> None:
        self.main, self.recent = _Sorted(), _Sorted()
        self.at = _Grown(np.int64)  # slot -> place in ids
        self.at.add(np.zeros(1, dtype=np.int64))
        self.ids = _Grown(np.uint32)
        self.word_at = _Grown(np.int64)  # slot -> place in words
        self.word_at.add(np.zeros(1, dtype=np.int64))
        self.words = _Grown(np.uint8)

    def _encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one after another, and how many each has."""
        encode = self.tokenizer.encode_batch_fast
        alone = [i for i, x in enumerate(texts) if self.between is None or _BETWEEN in x or "<|" in x]
        apart = {i: e.ids for i, e in zip(alone, encode([texts[i] for i in alone], add_special_tokens=False), strict=True)}
        plain = [_BETWEEN if i in apart else x for i, x in enumerate(texts)] if alone else texts
        if self.between is None:
            ids, sizes = np.zeros(0, dtype=np.uint32), np.zeros(len(texts), dtype=np.int64)
        else:
            some = [x for i, x in enumerate(plain) if i not in apart] if alone else plain
            joined = [f" {_BETWEEN} ".join(some[i : i + 512]) + f" {_BETWEEN}" for i in range(0, len(some), 512)]
            got = np.concatenate(
                [np.zeros(0, dtype=np.uint32), *(np.array(e.ids, dtype=np.uint32) for e in encode(joined, add_special_tokens=False))]
            )
            ends = np.flatnonzero(got == self.between)
            ids = got[got != self.between]
            sizes = np.diff(ends, prepend=-1) - 1
            if len(sizes) != len(some):
                raise ValueError("the tokenizer does not keep words apart")
        if alone:
            each = np.zeros(len(texts), dtype=np.int64)
            own = np.ones(len(texts), dtype=bool)
            own[alone] = False
            each[own] = sizes if self.between is not None else 0
            each[alone] = [len(apart[i]) for i in alone]
            begin = np.cumsum(each) - each
            out = np.zeros(int(each.sum()), dtype=np.uint32)
            out[W.ragged_arange(begin[own], each[own])] = ids
            for i in alone:
                out[begin[i] : begin[i] + each[i]] = apart[i]
            return out, each
        return ids, sizes

    def _learn(self, c: W.Chunk, words: np.ndarray) -> np.ndarray:
        """Encodes words of a chunk; their slots."""
        raw, starts, ends = c.data.tobytes(), c.starts[words], c.ends[words]
        ids, sizes = self._encoded([raw[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
        slots = self.at.n - 1 + np.arange(len(words), dtype=np.int32)
        self.at.add(self.ids.n + np.cumsum(sizes))
        self.ids.add(ids)
        self.word_at.add(self.words.n + np.cumsum(ends - starts))
        self.words.add(c.data[W.ragged_arange(starts, ends - starts)])
        return slots

    def _same(self, c: W.Chunk, words: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """Whether the words of a chunk are those in the slots."""
        begin, size = self.word_at.data[slots], self.word_at.data[slots + 1] - self.word_at.data[slots]
        out = size == c.ends[words] - c.starts[words]
        rows = np.flatnonzero(out)
        size = size[rows]
        equal = c.data[W.ragged_arange(c.starts[words[rows]], size)] == self.words.data[W.ragged_arange(begin[rows], size)]
        wrong = np.repeat(np.arange(len(rows)), size)[~equal]
        out[rows[wrong]] = False
        return out

    def encode(self, c: W.Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words of a chunk, and for each word the place of its first id (one more at the end)."""
        code = c.codes()
        if not len(code):
            return np.zeros(0, dtype=np.uint32), np.zeros(1, dtype=np.int64)
        distinct = np.flatnonzero(np.bincount(code))
        place = np.zeros(int(code.max()) + 1, dtype=np.int64)
        place[code[::-1]] = np.arange(len(code))[::-1]
        words = place[distinct]  # the first of each kind
        if self.at.n + len(words) > CACHE_WORDS:
            self._clear()
        hashes = W.byte_hash(c.data, c.starts[words], c.ends[words])
        slot = self.main.find(hashes)
        rest = np.flatnonzero(slot < 0)
        slot[rest] = self.recent.find(hashes[rest])
        known = np.flatnonzero(slot >= 0)
        slot[known[~self._same(c, words[known], slot[known])]] = -2  # another word has its hash
        fresh = np.flatnonzero(slot == -1)
        keys, first = np.unique(hashes[fresh], return_index=True)
        if len(fresh):
            slot[fresh[first]] = new = self._learn(c, words[fresh[first]])
            self.recent.add(keys, new)
            if 8 * len(self.recent.keys) > len(self.main.keys) + 200_000:
                self.main.add(self.recent.keys, self.recent.slots)
                self.recent = _Sorted()
        odd = np.flatnonzero(slot < 0)
        if len(odd):
            slot[odd] = self._learn(c, words[odd])
        place[distinct] = slot
        slot = place[code]
        begin = self.at.data[slot]
        sizes = self.at.data[slot + 1] - begin
        return self.ids.data[W.ragged_arange(begin, sizes)], np.concatenate([[0], np.cumsum(sizes)])


def word_tokens(path: str, ordinary: bool = False) -> WordTokens:
    """The worker's tokenizer for a file; it lives as long as the worker."""
    if (path, ordinary) not in _CACHES:
        _CACHES[path, ordinary] = WordTokens(path, ordinary)
    return _CACHES[path, ordinary]


def row_tokens(path: str, c: W.Chunk, ordinary: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a chunk's rows one after another, and where each row's begin (one more at the end)."""
    ids, at = word_tokens(path, ordinary).encode(c)
    return ids, at[c.first]


def binary_rows(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary column whose rows are ``data[offsets[i]:offsets[i + 1]]``."""
    return pa.Array.from_buffers(
        pa.binary(),
        len(offsets) - 1,
        [None, pa.py_buffer((offsets * data.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))],
    )
