"""SentencePiece encoding by a streaming Viterbi search, and decoding.

``StreamingViterbi`` reads a text in chunks and keeps only the positions that
a later piece can still reach back to (the longest piece's characters) and the
backpointer paths that end there. Whenever all surviving paths pass through
one boundary, the ids before it are committed and its states are dropped.

The score of a path is the sum of its pieces' scores in the model file. A
character that is no piece costs ten less than the worst piece and is written
as byte pieces. Among equal scores the path whose last piece is longest wins.

A position that no piece of the vocabulary can cross is a boundary whatever
the text around it, so ``TextEncoder`` splits there and remembers the ids of
the segments (words) it has seen, within a bound.

Defined cases: a null or empty text has no ids and decodes to an empty text;
U+2581, which the model uses for the space, decodes to a space (``round_trip``
is then false); repeated rows are encoded each; an empty table gives no rows;
other columns pass through ``encode`` untouched.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .store import tidy, worker_cache
from .words import RaggedMemo, Words, flat, slices

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
MEMO_SEGMENTS = 800_000


class Vocabulary:
    """Pieces of a SentencePiece model. ``prefix`` maps every prefix of a
    piece to (score, id), or to None where it is no piece itself."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.size, self.prefix, self.byte, self.text = n, {}, {}, [b""] * n
        normal = {}
        for k in range(n):
            p = sp.id_to_piece(k)
            if sp.is_byte(k):
                self.byte[int(p[3:5], 16)] = k
                self.text[k] = bytes([int(p[3:5], 16)])
            elif not (sp.is_control(k) or sp.is_unknown(k) or sp.is_unused(k)):
                normal[p] = (sp.get_score(k), k)
                self.text[k] = p.replace(SPACE, " ").encode()
        self._index(normal, sp.unk_id())

    def _index(self, normal: dict, unk: int) -> None:
        for p in normal:
            for j in range(1, len(p)):
                self.prefix.setdefault(p[:j], None)
        self.prefix.update(normal)
        self.longest = max(map(len, normal))
        self.unknown = min(s for s, _ in normal.values()) - UNKNOWN_PENALTY
        self.unk = unk
        self.chars = set("".join(normal))
        # can a piece hold a space mark after another character?
        self.space_begins = not any(SPACE in p.lstrip(SPACE) for p in normal)

    @classmethod
    def of(cls, scores: dict[str, float]) -> Vocabulary:
        """A small vocabulary for tests: ids in order, no byte pieces."""
        v = cls.__new__(cls)
        v.size, v.prefix, v.byte = len(scores) + 1, {}, {}
        v.text = [b"?"] + [p.replace(SPACE, " ").encode() for p in scores]
        v._index({p: (s, k + 1) for k, (p, s) in enumerate(scores.items())}, 0)
        return v

    def fallback(self, char: str) -> list[int]:
        raw = char.encode()
        return [self.byte[b] for b in raw] if all(b in self.byte for b in raw) else [self.unk]


class StreamingViterbi:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.text, self.done = "", 0      # text from the last committed boundary on; positions expanded
        self.best = [0.0]                 # per position: best score from that boundary
        self.back = [None]                # (start, id or -1) of the best path's last piece
        self.window = 0                   # most positions ever held

    def feed(self, chunk: str) -> list[int]:
        """Add text; returns the ids that are now certain."""
        self.text += chunk
        grow = len(self.text) + 1 - len(self.best)
        self.best += [None] * grow
        self.back += [None] * grow
        return self._advance(len(self.text) - self.v.longest + 1)

    def finish(self) -> list[int]:
        out = self._advance(len(self.text))
        return out + self._commit(self.done)

    def _advance(self, stop: int) -> list[int]:
        """Expand the positions before ``stop``; commit wherever the surviving
        paths have met."""
        longest, out = self.v.longest, []
        while self.done < stop:
            # the next positions up to the next try to commit
            upto = min(stop, (self.done // longest + 1) * longest)
            self._expand(self.done, upto)
            self.done = upto
            self.window = max(self.window, upto)
            if upto >= 4 * longest and upto % longest == 0:
                at = self._meeting()
                out += self._commit(at)
                stop -= at
        return out

    def _expand(self, first: int, last: int) -> None:
        text, best, back, get, longest = self.text, self.best, self.back, self.v.prefix.get, self.v.longest
        n, unknown = len(text), self.v.unknown
        for i in range(first, last):
            here, single, j = best[i], False, i + 1
            end = min(n, i + longest)
            while j <= end:
                found = get(text[i:j], False)
                if found is False:
                    break
                if found is not None:
                    s = here + found[0]
                    # starts come in ascending order, so an equal score from here is a shorter last piece
                    if best[j] is None or s > best[j]:
                        best[j], back[j] = s, (i, found[1])
                    single = single or j == i + 1
                j += 1
            if not single:
                s = here + unknown
                if best[i + 1] is None or s > best[i + 1]:
                    best[i + 1], back[i + 1] = s, (i, -1)

    def _meeting(self) -> int:
        """The last boundary that all surviving paths pass through."""
        alive = {j for j in range(self.done, min(len(self.best), self.done + self.v.longest)) if self.best[j] is not None}
        while len(alive) > 1:
            j = max(alive)
            alive.remove(j)
            alive.add(self.back[j][0])
        return alive.pop()

    def _commit(self, at: int) -> list[int]:
        pieces, j = [], at
        while j > 0:
            i, k = self.back[j]
            pieces.append([k] if k >= 0 else self.v.fallback(self.text[i:j]))
            j = i
        if at:
            base = self.best[at]
            self.text, self.done = self.text[at:], self.done - at
            self.best = [None if b is None else b - base for b in self.best[at:]]
            self.back = [None] + [None if b is None else (b[0] - at, b[1]) for b in self.back[at + 1:]]
        return [k for ids in reversed(pieces) for k in ids]


def stream(v: Vocabulary, chunks: Iterable[str]) -> Iterator[int]:
    s = StreamingViterbi(v)
    for c in chunks:
        yield from s.feed(c)
    yield from s.finish()


class TextEncoder:
    """Ids of whole texts: a space mark before the text, spaces as marks."""

    def __init__(self, vocabulary: Vocabulary):
        self.v, self.memo = vocabulary, RaggedMemo(MEMO_SEGMENTS)
        # may texts be cut before a space and around a line end?
        self.cuts = vocabulary.space_begins and "\n" not in vocabulary.chars

    def ids(self, marked: str) -> array:
        """Ids of a text whose spaces are marks, fed in chunks."""
        out, v = array("I"), StreamingViterbi(self.v)
        for a in range(0, len(marked), 4096):
            out.extend(v.feed(marked[a: a + 4096]))
        out.extend(v.finish())
        return out

    def whole(self, text: str | None) -> np.ndarray:
        return np.array(self.ids(SPACE + text.replace(" ", SPACE)) if text else [], np.uint32)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """32-bit ids of each text."""
        data, offs = flat(texts)
        if not self.cuts:
            return [self.whole(t) for t in texts.to_pylist()]
        apart = _odd_spaces(data, offs)
        w = Words(texts, spaces=b" ", alone=10)
        begins = np.zeros(len(data) + 1, bool)
        begins[offs[:-1]] = True
        spaced = begins[w.start] | (data[np.maximum(w.start, 1) - 1] == 32)
        raw = data.tobytes()

        def make(where):
            ids, count = array("I"), np.empty(len(where), np.int64)
            for i, (a, b, mark) in enumerate(zip(w.start[where].tolist(), w.end[where].tolist(), spaced[where].tolist())):
                got = self.ids((SPACE if mark else "") + raw[a:b].decode())
                ids.extend(got)
                count[i] = len(got)
            return np.array(ids, np.uint32), np.cumsum(count) - count, count

        ids, size = self.memo.get(w.hash ^ (spaced * np.uint64(0xA5A5A5A5A5A5A5A5)), make) if len(w.hash) else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        cut = np.concatenate([[0], np.cumsum(size)])[w.first]
        out = [ids[a:b] for a, b in zip(cut[:-1], cut[1:])]
        for k in apart:
            out[k] = self.whole(texts[k].as_py())
        return out

    def decode(self, ids: np.ndarray) -> str:
        t = b"".join(map(self.v.text.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return t[1:] if t[:1] == " " else t


def _odd_spaces(data: np.ndarray, offs: np.ndarray) -> list[int]:
    """Texts whose spaces do not each stand between two words: their runs of
    marks are encoded with the whole text."""
    if not len(data):
        return []
    space, line = data == 32, data == 10
    ends = np.zeros(len(data), bool)
    ends[offs[1:][np.diff(offs) > 0] - 1] = True
    begins = np.zeros(len(data), bool)
    begins[offs[:-1][np.diff(offs) > 0]] = True
    odd = space & ends
    odd[:-1] |= space[:-1] & (space[1:] | line[1:]) & ~ends[:-1]
    odd |= begins & (space | line)
    return np.unique(np.searchsorted(offs, np.flatnonzero(odd), "right") - 1).tolist()


def _encode(model: str, text_col: str, out_col: str, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = worker_cache("pieces:" + model, lambda: TextEncoder(Vocabulary(model)))
        for whole in batches:
            for batch in slices(whole, text_col):
                ids = enc.encode(batch.column(text_col))
                count = np.array([len(x) for x in ids], np.int64)
                keep = [c for c in batch.schema.names if c != out_col and not (digest and c == text_col)]
                cols, names = [batch.column(c) for c in keep], list(keep)
                if digest:
                    cols += [pa.array(count), pa.array([zlib.crc32(np.ascontiguousarray(x, "<u4")) for x in ids], pa.int64()),
                             pa.array([enc.decode(x) == (t or "") for x, t in zip(ids, batch.column(text_col).to_pylist())], pa.bool_())]
                    names += ["n_ids", "ids_crc32", "round_trip"]
                else:
                    cut = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
                    cols.append(pa.ListArray.from_arrays(pa.array(cut), pa.array(np.concatenate(ids).astype(np.int32))))
                    names.append(out_col)
                yield pa.record_batch(cols, names=names)

    return run


def _schema(df: DataFrame, without: set) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in without)


def encode(df: DataFrame, model: str, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """``df`` with the array column ``out_col`` of piece ids."""
    if out_col in df.columns:
        raise ValueError(f"{out_col} is a column of the input; choose another out_col")
    return df.mapInArrow(tidy(_encode(model, text_col, out_col, False)), f"{_schema(df, set())}, `{out_col}` array<int>")


def decode(df: DataFrame, model: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with the text that the ids stand for."""
    if out_col in df.columns:
        raise ValueError(f"{out_col} is a column of the input; choose another out_col")

    def run(batches):
        enc = worker_cache("pieces:" + model, lambda: TextEncoder(Vocabulary(model)))
        for b in batches:
            texts = [enc.decode(np.array(x or [], np.int64)) for x in b.column(ids_col).to_pylist()]
            yield pa.record_batch([*b.columns, pa.array(texts, pa.string())], names=[*b.schema.names, out_col])

    return df.mapInArrow(run, f"{_schema(df, set())}, `{out_col}` string")


def digests(df: DataFrame, model: str, text_col: str = "text") -> DataFrame:
    """Instead of the text: n_ids, the crc32 of the ids as unsigned 32-bit
    integers, and whether decoding them gives the text back."""
    return df.mapInArrow(tidy(_encode(model, text_col, "", True)), f"{_schema(df, {text_col})}, n_ids long, ids_crc32 long, round_trip boolean")


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encoded_documents(spark: SparkSession, documents: DataFrame) -> DataFrame:
    return digests(documents.select("doc_id", "text"), model_path())
