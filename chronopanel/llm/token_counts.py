"""Token counts of fields and sections by offset-mapped attribution.

Every document is encoded once, whole. The tokens' byte lengths give their
character spans, which are joined with the document's sections as sorted
intervals. A token that lies across a boundary goes where ``rule`` says:

- ``first``: to the section that holds its first character,
- ``last``: to the one that holds its last character,
- ``most``: to the one that holds most of its characters, the first of equals,
- ``share``: to each in proportion to the characters it holds.

So the counts of a document's sections always sum to its tokens, which
counts of separately encoded sections do not. Characters and tokens in no
section are counted under section -1.

Defined cases: a null or empty text has no tokens, and one row per given
section with 0 tokens (with line sections: one row, section 0, 0 to 0); a null
or empty section list puts all tokens under -1; sections must be sorted and
must not overlap (an error otherwise); repeated rows are counted each; an
empty table gives no rows; only the id, the text and the sections are read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import tidy, worker_cache
from .words import flat, slices

RULES = ("first", "last", "most", "share")


class ByteTokens:
    """A byte-level vocabulary; ``length[id]`` is a token's bytes."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        self.pattern = public_tokenizers.PATTERN
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.enc = tiktoken.Encoding("byte", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        self.length = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, k in ranks.items():
            self.length[k] = len(token)

    def lengths(self, text: str) -> np.ndarray:
        try:
            return self.length[self.enc.encode_to_numpy(text, disallowed_special=())]
        except ValueError:
            # the library's pattern search gives up on very long runs of white
            # space; the same pattern splits the text here, piece by piece
            pieces = regex.finditer(self.pattern, text)
            return self.length[[k for m in pieces for k in self.enc._encode_single_piece(m.group().encode())]]


def attribute(start: np.ndarray, end: np.ndarray, lo: np.ndarray, hi: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens [start, end) against sorted, disjoint sections [lo, hi): tokens
    of each section and, last, of none; and how many of each section's tokens
    cross one of its boundaries."""
    n = len(lo)
    counts, crossing = np.zeros(n + 1), np.zeros(n + 1, np.int64)

    def section(at):
        k = np.searchsorted(lo, at, "right") - 1
        inside = (k >= 0) & (at < hi[np.maximum(k, 0)]) if n else np.zeros(len(at), bool)
        return np.where(inside, k, n)

    first, last = section(start), section(end - 1)
    cross = np.flatnonzero((first != last) | ((first == n) & (np.searchsorted(lo, end, "left") > np.searchsorted(lo, start, "right"))))
    whole = np.ones(len(start), bool)
    whole[cross] = False
    counts += np.bincount(first[whole], minlength=n + 1)
    for t in cross:
        a = max(0, int(np.searchsorted(hi, start[t], "right")))
        b = int(np.searchsorted(lo, end[t], "left"))
        held = np.maximum(0, np.minimum(hi[a:b], end[t]) - np.maximum(lo[a:b], start[t]))
        rest = (end[t] - start[t]) - held.sum()
        crossing[a:b][held > 0] += 1
        if rule == "first":
            counts[first[t]] += 1
        elif rule == "last":
            counts[last[t]] += 1
        elif rule == "share":
            counts[a:b] += held / (end[t] - start[t])
            counts[n] += rest / (end[t] - start[t])
        else:
            best = int(held.argmax()) if len(held) else -1
            counts[n if best < 0 or held[best] < rest else a + best] += 1
    return counts, crossing


def _line_sections(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans of the lines; a line holds its line end."""
    cut = np.flatnonzero(data == 10) + 1
    lo = np.r_[0, cut[cut < len(data)]]
    return lo, np.r_[lo[1:], len(data)]


_SCHEMA = pa.schema([("id", pa.int64()), ("section", pa.int32()), ("name", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                     ("n_tokens", pa.float64()), ("n_crossing", pa.int64())])


def _count(vocabulary: str, rule: str, lines: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = worker_cache("byte-tokens:" + vocabulary, lambda: ByteTokens(vocabulary))
        for whole in batches:
            for batch in slices(whole, "text"):
                yield _batch(batch, tokens, rule, lines)

    return run


def _batch(batch: pa.RecordBatch, tokens: ByteTokens, rule: str, lines: bool) -> pa.RecordBatch:
    data, offs = flat(batch.column("text"))
    ids, texts = batch.column("id").to_pylist(), batch.column("text").to_pylist()
    given = [None] * len(ids) if lines else batch.column("sections").to_pylist()
    cols = [[] for _ in _SCHEMA]
    for k, (doc_id, text) in enumerate(zip(ids, texts)):
        own = data[offs[k]: offs[k + 1]]
        end = np.cumsum(tokens.lengths(text)) if text else np.zeros(0, np.int64)
        start = np.concatenate([[0], end[:-1]]).astype(np.int64) if len(end) else end
        if lines:
            lo, hi = _line_sections(own)
            names = [None] * len(lo)
        ascii_only = len(own) == len(text or "")
        if not ascii_only:
            char = np.cumsum((own & 0xC0) != 0x80)  # characters up to and with each byte
            if lines:
                lo, hi = np.where(lo > 0, char[lo - 1], 0), char[hi - 1]
            start, end = char[start] - 1, char[end - 1]  # a character's first and last byte may be in two tokens
        if not lines:
            s = given[k] or []
            lo, hi = (np.array([x[f] for x in s], np.int64) for f in ("start", "end"))
            names = [x["name"] for x in s]
            if (lo > hi).any() or (hi[:-1] > lo[1:]).any():
                raise ValueError("sections must be sorted and must not overlap")
        counts, crossing = attribute(start, end, lo, hi, rule)
        n = len(lo) + (counts[-1] > 0)
        for c, v in zip(cols, ([doc_id] * n, [*range(len(lo)), -1][:n], [*names, None][:n], [*lo.tolist(), None][:n], [*hi.tolist(), None][:n],
                               counts[:n].tolist(), crossing[:n].tolist())):
            c.extend(v)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, _SCHEMA)], schema=_SCHEMA)


def count_tokens(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", sections_col: str | None = None,
                 rule: str = "most") -> DataFrame:
    """Rows (id, section, name, start, end, n_tokens, n_crossing). Sections are
    the array of structs (name, start, end; character offsets) in
    ``sections_col``, or the text's lines where that is None."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    cols = [F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")]
    if sections_col:
        cols.append(F.col(sections_col).alias("sections"))
    return df.select(*cols).mapInArrow(tidy(_count(vocabulary, rule, sections_col is None)),
                                       "id long, section int, name string, start long, end long, n_tokens double, n_crossing long")


def line_token_counts(spark: SparkSession, documents: DataFrame) -> DataFrame:
    import public_tokenizers

    out = count_tokens(documents, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return out.select(F.col("id").alias("doc_id"), "section", "start", "end", F.col("n_tokens").cast("long").alias("n_tokens"), "n_crossing")
