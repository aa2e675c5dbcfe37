"""Vectorised word and shingle hashes of Arrow text columns.

A word is a maximal run of bytes other than space and ``\\x09-\\x0D``. Hashes
are 64-bit and depend on nothing but the word's bytes (A-Z lower-cased on
request), so equal words meet across tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

BLOCK = 1 << 20
LONG_WORD = 1 << 16

# 1: ASCII letter, 2: ASCII mark other than the apostrophe, 0: anything else
MARK_KIND = np.zeros(256, np.uint8)
MARK_KIND[33:48] = MARK_KIND[58:65] = MARK_KIND[91:97] = MARK_KIND[123:127] = 2
MARK_KIND[65:91] = MARK_KIND[97:123] = 1
MARK_KIND[39] = 0
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 (public domain)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _tables(lower: bool, spaces: bytes):
    t = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    sep = np.zeros(256, bool)
    sep[list(spaces)] = True
    t[sep] = 0
    if lower:
        t[65:91] = t[97:123]
    base, inv = 0x5851F42D4C957F2D, pow(0x5851F42D4C957F2D, -1, 1 << 64)
    n = BLOCK + LONG_WORD + 1

    def powers(b):
        out = np.full(n, b, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    return t, sep, powers(base), powers(inv)


class Words:
    """Words of a batch: ``hash`` per word and ``first`` (index of each text's
    first word, with one more entry at the end)."""

    tables: dict = {}

    def __init__(self, texts: pa.Array, lower: bool | str = False, marks: bool = False, spaces: bytes = b" \t\n\x0b\x0c\r", alone: int | None = None):
        """``marks``: also cut between an ASCII letter and an ASCII mark other
        than the apostrophe. ``alone``: a byte that is a word by itself.
        ``lower="ascii"``: A-Z are lower-cased in words of ASCII alone; ``data``
        then holds the words as they are hashed."""
        data, offs = flat(texts)
        only_ascii, lower = lower == "ascii", lower is True
        if (lower, spaces) not in self.tables:
            self.tables[lower, spaces] = _tables(lower, spaces)
        self.t, self.sep, self.pow, self.inv = self.tables[lower, spaces]
        n = len(data)
        is_sep = self.sep[data]
        before = np.ones(n, bool)
        before[1:] = is_sep[:-1]
        cut = offs[(offs > 0) & (offs < n)]
        before[cut] = True
        if marks and n:
            kind = MARK_KIND[data]
            before[1:] |= (kind[1:] | kind[:-1]) == 3
        if alone is not None and n:
            single = data == alone
            before |= single
            before[1:] |= single[:-1]
        after = np.ones(n, bool)
        after[:-1] = before[1:] | is_sep[1:]
        self.start = np.flatnonzero(before & ~is_sep)
        self.end = np.flatnonzero(after & ~is_sep) + 1
        self.data, self.offs, self.lower = data, offs, lower
        if only_ascii and n:
            self.data = self._lowered(data)
        self.first = np.searchsorted(self.start, offs)
        self.hash = self._hashes()

    def _lowered(self, data: np.ndarray) -> np.ndarray:
        high = np.flatnonzero(data > 127)
        low = LOWER[data]
        if len(high):
            k = np.unique(np.searchsorted(self.start, high, "right") - 1)  # words with such a byte
            edge = np.zeros(len(data) + 1, np.int8)
            edge[self.start[k]] += 1
            edge[self.end[k]] -= 1
            kept = np.cumsum(edge[:-1], dtype=np.int8).view(bool)
            low[kept] = data[kept]
        return low

    def _hashes(self) -> np.ndarray:
        start, size = self.start, self.end - self.start
        out = np.empty(len(start), np.uint64)
        long = np.flatnonzero(size > LONG_WORD)
        for a, b in zip(np.r_[0, long + 1], np.r_[long, len(start)]):
            while a < b:
                stop = max(a + 1, int(np.searchsorted(start[a:b], start[a] + BLOCK)) + a)
                lo, hi = start[a], self.end[stop - 1]
                v = self.t[self.data[lo:hi]]
                v *= self.pow[: hi - lo]
                rel = start[a:stop] - lo
                out[a:stop] = np.add.reduceat(v, rel) * self.inv[rel]
                a = stop
        out = _mix(out)
        for k in long:
            w = self.data[start[k]: self.end[k]].tobytes()
            out[k] = xxhash.xxh64_intdigest(w.lower() if self.lower else w)
        return out

    def ngrams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each word n-gram inside one text, in order, and the index
        of its first word. A text with 1 to n-1 words has its whole sequence
        as its one n-gram."""
        w = self.hash
        last = np.repeat(self.first[1:], np.diff(self.first))  # end of each word's text
        at = np.flatnonzero(last - np.arange(len(w)) >= n)
        h = np.zeros(len(at), np.uint64)
        for k in range(n):
            h = _mix(h * np.uint64(0x9FB21C651E98DF25) + w[at + k])
        short = np.flatnonzero((np.diff(self.first) > 0) & (np.diff(self.first) < n))
        if len(short):
            extra = np.empty(len(short), np.uint64)
            for i, d in enumerate(short):
                g = np.full(1, self.first[d + 1] - self.first[d], np.uint64)
                for x in w[self.first[d]: self.first[d + 1]]:
                    g = _mix(g * np.uint64(0x9FB21C651E98DF25) + x)
                extra[i] = g[0]
            at = np.r_[at, self.first[short]]
            h = np.r_[h, extra]
            order = np.argsort(at, kind="stable")
            at, h = at[order], h[order]
        return h, at

    def shingle_sets(self, n: int) -> list[np.ndarray]:
        """Sorted distinct n-gram hashes of each text."""
        h, at = self.ngrams(n)
        cut = np.searchsorted(at, self.first)
        return [distinct(h[a:b]) for a, b in zip(cut[:-1], cut[1:])]


class RaggedMemo:
    """Remembers a short array of numbers for each 64-bit key, as sorted keys
    over one flat store. Starts anew when it holds ``most`` keys."""

    def __init__(self, most: int):
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.keys, self.start, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.store = np.zeros(0, np.uint32)

    def get(self, keys: np.ndarray, make) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of each key, one after the other, and how many each has.
        ``make(where)`` gives (numbers, begins, counts) of the keys at
        ``where``, for keys that are not held."""
        if len(self.keys) > self.most:
            self.clear()
        uniq, first, inv = np.unique(keys, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, uniq)
        hit = at < len(self.keys)
        hit[hit] = self.keys[at[hit]] == uniq[hit]
        if not hit.all():
            numbers, begin, counts = make(first[~hit])
            begin = begin + len(self.store)
            order = np.argsort(np.concatenate([self.keys, uniq[~hit]]), kind="stable")
            self.keys, self.start, self.size = (np.concatenate(x)[order] for x in ((self.keys, uniq[~hit]), (self.start, begin), (self.size, counts)))
            self.store = np.concatenate([self.store, numbers])
            at = np.searchsorted(self.keys, uniq)
        size = self.size[at][inv]
        ends = np.cumsum(size)
        where = np.repeat(self.start[at][inv] - ends + size, size)
        where += np.arange(len(where))
        return self.store[where], size


def distinct(h: np.ndarray) -> np.ndarray:
    if len(h) < 2:
        return h.copy()
    s = np.sort(h)
    keep = np.ones(len(s), bool)
    np.not_equal(s[1:], s[:-1], out=keep[1:])
    return s[keep]


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offs, data = texts.buffers()
    if len(texts) == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offs = np.frombuffer(offs, np.int64 if wide else np.int32)[texts.offset: texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offs[0]: offs[-1]], offs - offs[0]


def slices(batch: pa.RecordBatch, column: str, most: int = 2 << 20):
    """Slices of a batch with about ``most`` bytes of text each (one row at
    least), so that temporary arrays stay small."""
    c = batch.column(column)
    _, offs = flat(c)
    a = 0
    while a < len(c):
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + most, "right")) - 1)
        yield batch.slice(a, b - a)
        a = b
