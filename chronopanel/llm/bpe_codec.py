"""Byte-pair encoding by a segment tree over the ranks of adjacent pairs, and
decoding.

``Merger`` keeps, for each piece of text, a segment tree whose leaves are the
merge ranks of adjacent symbols. The root holds the lowest rank; the way down,
left child first, leads to the leftmost pair of that rank. A merge changes
three leaves and their paths, so a piece of n symbols takes O(n log n) steps
however long it is. Short pieces are merged side by side: the trees of one
size form a matrix, and a step makes one merge in each of its rows.

``Codec`` gives the ids that the tokenizers library gives for a whole text
(``add_special_tokens=False``, no truncation or padding) and the text of its
``decode(ids, skip_special_tokens=False)``. Normaliser and piece pattern are
those of the tokenizer file, run by the library; merging is done here. Text is
cut at ASCII white space and between ASCII letters and marks, where neither a
piece nor a composed character can reach across (``Codec`` checks that on a
probe text); a word's ids are remembered within a bound that does not grow
with the input. Words of ASCII alone are remembered in lower case; any other
word as written, since characters compose before they are lower-cased.

Defined cases: a null or empty text has no ids and decodes to an empty text;
the string of a special token inside a text is that token, as in the library;
repeated rows are encoded each; an empty table gives no rows; other columns
pass through ``encode`` and ``decode`` untouched, and an ``out_col`` that is a
column already is an error.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .store import tidy, worker_cache
from .words import RaggedMemo, Words, flat, slices

MEMO_WORDS = 1_000_000
NONE = 1 << 60        # the rank of a pair that does not merge
FOREST = 1 << 18      # leaves of the trees that are merged side by side
ALONE = 128           # pieces with more leaves are merged one by one
LATIN_END = "\u0250"  # letters before it are lower-case Latin letters after normalising


class Merger:
    """Merges of symbol ids. ``merges`` maps (left, right) to the merged id,
    in order of rank."""

    def __init__(self, merges: dict[tuple[int, int], int]):
        pairs = np.array([a << 32 | b for a, b in merges] or [-1], np.int64)
        self.order = np.argsort(pairs)
        self.pairs = pairs[self.order]
        self.made = np.array([*merges.values(), -1], np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE for a pair that does not merge."""
        pair = (left << 32) | right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pair, self.order[at], NONE)

    def many(self, symbols: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge pieces that lie one after the other: symbols and counts of
        the results."""
        ends = np.cumsum(count)
        out, kept = symbols.astype(np.int64), np.ones(len(symbols), bool)
        size = np.ones(len(count), np.int64)
        while (small := size < count - 1).any():
            size[small] *= 2
        for s in np.unique(size[count > 1]).tolist():
            group = np.flatnonzero((size == s) & (count > 1))
            rows = max(1, FOREST // s)
            for a in range(0, len(group), rows):
                g = group[a: a + rows]
                where = (ends - count)[g][:, None] + np.arange(s + 1)
                held = np.arange(s + 1) < count[g][:, None]
                if s > ALONE:
                    got = np.full(held.shape, -1)
                    for k in range(len(g)):
                        alone = self.one(out[where[k][held[k]]].tolist())
                        got[k, : len(alone)] = alone
                else:
                    got = self._forest(np.where(held, out[np.minimum(where, len(out) - 1)], -1), count[g])
                out[where[held]], kept[where[held]] = got[held], got[held] >= 0
        n = np.add.reduceat(kept, ends - count).astype(np.int64) if len(count) else count
        return out[kept], n

    def _forest(self, sym: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Symbols of each row after its merges; -1 where one was merged into
        its left neighbour. A row has one leaf less than places."""
        m, s = len(sym), sym.shape[1] - 1
        tree = np.full((m, 2 * s), NONE)
        pair = sym[:, 1:] >= 0
        tree[:, s:][pair] = self.ranks(sym[:, :-1][pair], sym[:, 1:][pair])
        h = s // 2
        while h:
            tree[:, h: 2 * h] = np.minimum(tree[:, 2 * h: 4 * h: 2], tree[:, 2 * h + 1: 4 * h: 2])
            h //= 2
        after, before = (np.tile(np.arange(s + 1), (m, 1)) + d for d in (1, -1))
        rows = np.flatnonzero(tree[:, 1] != NONE)
        while len(rows):
            low = tree[rows, 1]
            k = np.ones(len(rows), np.int64)
            for _ in range(s.bit_length() - 1):
                k *= 2
                k += tree[rows, k] != low
            left, made = k - s, self.made[low]
            right = after[rows, left]
            following, previous = after[rows, right], before[rows, left]
            sym[rows, left], sym[rows, right] = made, -1
            after[rows, left] = following
            f, p, r = following < n[rows], previous >= 0, right < s
            before[rows[f], following[f]] = left[f]
            value = np.full(len(rows), NONE)
            value[f] = self.ranks(made[f], sym[rows[f], following[f]])
            tree[rows, k] = value
            tree[rows[r], s + right[r]] = NONE
            tree[rows[p], s + previous[p]] = self.ranks(sym[rows[p], previous[p]], made[p])
            paths = [(rows, k), (rows[r], s + right[r]), (rows[p], s + previous[p])]
            for _ in range(s.bit_length() - 1):
                paths = [(who, at >> 1) for who, at in paths]
                for who, at in paths:
                    tree[who, at] = np.minimum(tree[who, 2 * at], tree[who, 2 * at + 1])
            rows = rows[tree[rows, 1] != NONE]
        return sym

    def one(self, symbols: list[int]) -> list[int]:
        """The same for a single long piece, in plain Python."""
        n = len(symbols)
        if n < 2:
            return symbols
        if not hasattr(self, "rank"):
            self.rank = dict(zip(self.pairs.tolist(), self.order.tolist()))
        s, rank, made = list(symbols), self.rank.get, self.made.tolist()
        size = 1 << (n - 2).bit_length()
        tree = [NONE] * (2 * size)
        for i in range(n - 1):
            tree[size + i] = rank(s[i] << 32 | s[i + 1], NONE)
        for k in range(size - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])

        def put(i, value):
            k = size + i
            tree[k] = value
            while k > 1:
                low = min(tree[k], tree[k ^ 1])
                k >>= 1
                if tree[k] == low:
                    return
                tree[k] = low

        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (low := tree[1]) != NONE:
            k = 1
            while k < size:
                k *= 2
                if tree[k] != low:
                    k += 1
            left = k - size
            right = after[left]
            s[left], s[right] = made[low], -1
            following, previous = after[right], before[left]
            after[left] = following
            if following < n:
                before[following] = left
                put(right, NONE)
                put(left, rank(s[left] << 32 | s[following], NONE))
            else:
                put(left, NONE)
            if previous >= 0:
                put(previous, rank(s[previous] << 32 | s[left], NONE))
        return [x for x in s if x >= 0]


def byte_chars() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: a
    visible Latin-1 character for itself, the others from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = iter(range(256, 512))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


class Codec:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        spec = json.loads(tok.to_str())
        model, added = spec["model"], spec["added_tokens"]
        if model["type"] != "BPE" or spec["decoder"] or spec["post_processor"] or model["continuing_subword_prefix"] or model["ignore_merges"]:
            raise ValueError("not a plain byte-pair tokenizer without decoder")
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("special tokens must stand for their exact strings")
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.normal = tok.normalizer.normalize_str
        self.pieces = tok.pre_tokenizer.pre_tokenize_str
        self.merger = Merger({(vocab[a], vocab[b]): vocab[a + b] for a, b in model["merges"]})
        chars = byte_chars()
        self.byte = {ord(c): k for k, c in enumerate(chars)}
        self.inner = np.array([vocab[c] for c in chars])
        self.last = np.array([vocab[c + suffix] for c in chars])
        self.special = {t["content"]: t["id"] for t in added}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if added else None
        self.token = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for t, k in [*vocab.items(), *self.special.items()]:
            self.token[k] = t
        self.utf8 = [t.encode() for t in self.token]
        self.memo = RaggedMemo(MEMO_WORDS)
        probe = "It's A  x1\n\n, (We'll) \t\x0b\x0c\ry.** Z--é 'tis!'s ..\"q\" ÀB́ 3.14 a.b ≮a"
        whole = tok.encode(probe, add_special_tokens=False).ids
        if not whole == self.ids([probe])[0].tolist() == self.encode(pa.array([probe]))[0].tolist():
            raise ValueError("this tokenizer's words cannot be encoded alone")

    def _pieces(self, text: str) -> list[bytes]:
        """UTF-8 bytes of the tokenizer's pieces of a text. A run of Latin
        letters is one piece whatever the tokenizer's tables say."""
        if not (text.isascii() and text.islower() and text.isalpha()):
            text = self.normal(text)
        if text.isalpha() and max(text) < LATIN_END:
            return [text.encode()]
        return [p.translate(self.byte).encode("latin-1") for p, _ in self.pieces(text)]

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts without special tokens, uncut, and their counts."""
        pieces = [self._pieces(t) for t in texts]
        size = np.array([len(p) for ps in pieces for p in ps], np.int64)
        data = np.frombuffer(b"".join(p for ps in pieces for p in ps), np.uint8)
        symbols = self.inner[data]
        ends = np.cumsum(size) - 1
        symbols[ends] = self.last[data[ends]]
        out, n = self.merger.many(symbols, size)
        upto = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum([len(ps) for ps in pieces])]).astype(np.int64)]
        return out.astype(np.uint32), np.diff(upto)

    def _cut(self, texts: pa.Array) -> list[np.ndarray]:
        w = Words(texts, lower="ascii", marks=True)
        raw = w.data.tobytes()

        def make(where):
            ids, count = self.ids([raw[a:b].decode() for a, b in zip(w.start[where].tolist(), w.end[where].tolist())])
            return ids, np.cumsum(count) - count, count

        ids, size = self.memo.get(w.hash, make) if len(w.hash) else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        cut = np.concatenate([[0], np.cumsum(size)])[w.first]
        return [ids[a:b] for a, b in zip(cut[:-1], cut[1:])]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """32-bit ids of each text."""
        out = self._cut(texts)
        raw, offs = flat(texts)
        data = raw.tobytes()
        held = {int(np.searchsorted(offs, m.start(), "right")) - 1 for s in self.special for m in re.finditer(re.escape(s.encode()), data)}
        for k in held:
            parts = self.split.split(texts[k].as_py() or "")
            ids = self._cut(pa.array(parts[::2], pa.string()))
            marks = [np.array([self.special[p]], np.uint32) for p in parts[1::2]]
            out[k] = np.concatenate([x for pair in zip(ids, [*marks, np.zeros(0, np.uint32)]) for x in pair])
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of the ids, in UTF-8: without a decoder of its own the
        library joins the tokens by spaces."""
        return b" ".join(map(self.utf8.__getitem__, ids.tolist()))


def _codec(path: str) -> Codec:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return worker_cache("bpe:" + path, lambda: Codec(path))


def _schema(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def encode(df: DataFrame, tokenizer: str, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """``df`` with the array column ``out_col`` of token ids."""
    if out_col in df.columns:
        raise ValueError(f"{out_col} is a column of the input; choose another out_col")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(tokenizer)
        for whole in batches:
            for b in slices(whole, text_col):
                ids = codec.encode(b.column(text_col))
                cut = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                column = pa.ListArray.from_arrays(pa.array(cut), pa.array(np.concatenate([np.zeros(0), *ids]).astype(np.int32)))
                yield pa.record_batch([*b.columns, column], names=[*b.schema.names, out_col])

    return df.mapInArrow(tidy(run), f"{_schema(df)}, `{out_col}` array<int>")


def decode(df: DataFrame, tokenizer: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with the text that the ids stand for."""
    if out_col in df.columns:
        raise ValueError(f"{out_col} is a column of the input; choose another out_col")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(tokenizer)
        for b in batches:
            texts = [codec.decode(np.array(x or [], np.int64)).decode() for x in b.column(ids_col).to_pylist()]
            yield pa.record_batch([*b.columns, pa.array(texts, pa.string())], names=[*b.schema.names, out_col])

    return df.mapInArrow(tidy(run), f"{_schema(df)}, `{out_col}` string")


def digests(df: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """Instead of the text: n_tokens, and the SHA-256 of the ids as
    little-endian unsigned 32-bit integers and of the text decoded from them."""
    names = [c for c in df.columns if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(tokenizer)
        for whole in batches:
            for b in slices(whole, text_col):
                ids = codec.encode(b.column(text_col))
                cols = [b.column(c) for c in names]
                cols.append(pa.array([len(x) for x in ids], pa.int64()))
                cols.append(pa.array([hashlib.sha256(np.ascontiguousarray(x, "<u4")).hexdigest() for x in ids], pa.string()))
                cols.append(pa.array([hashlib.sha256(codec.decode(x)).hexdigest() for x in ids], pa.string()))
                yield pa.record_batch(cols, names=[*names, "n_tokens", "ids_sha256", "decoded_sha256"])

    return df.mapInArrow(tidy(run), f"{_schema(df.select(*names))}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def coded_documents(spark: SparkSession, documents: DataFrame) -> DataFrame:
    return digests(documents.select("doc_id", "text"), tokenizer_path("word_bpe_49k.json"))
