"""Token-id files: every document's ids in its own Zstandard frame.

``write_ids`` range-partitions the documents by id, encodes each partition in
ascending order and writes one seekable file per partition; the file's index
holds the documents' ids and token counts, so a reader decompresses only the
frames of the documents it wants (``read_ids(..., wanted=...)``).

Defined cases: a null text is empty (only the end id); a null id sorts first;
rows that repeat an id are kept, ordered by their text's hash; an empty table
writes no file and reads as no rows; other columns are ignored. A document
longer than one frame (2^28 ids) takes several frames.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .seekable import SeekableReader, SeekableWriter
from .store import commit_file, filesystem, shared_folder, tidy, worker_cache, written
from .words import RaggedMemo, Words, flat, slices

MEMO_WORDS = 1_000_000
FRAME_IDS = 1 << 28
FILE_TEXT = 16 << 20     # bytes of text for each file
_INDEX = np.dtype([("has_id", "u1"), ("doc_id", "<i8"), ("n", "<i8"), ("first_frame", "<i8")])


class WordEncoder:
    """Encodes texts with a tokenizer that drops white space and cuts between
    letters and marks: a text's ids are its words' ids in order, so each word
    is encoded once by the tokenizers library and remembered, within a bound.

    ``cuts_words`` checks that of the tokenizer. Words of ASCII alone may be
    lower-cased (the tokenizer does so itself); others are encoded as written,
    since it composes characters before it lower-cases them. Texts that hold a
    special token's string are encoded whole."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab(with_added_tokens=True)
        self.special = [t.content.encode() for t in self.tok.get_added_tokens_decoder().values()]
        self.ends_word = np.zeros(max(vocab.values()) + 1, bool)
        for token, k in vocab.items():
            self.ends_word[k] = token.endswith("</w>")
        self.memo = RaggedMemo(MEMO_WORDS)
        if not self.cuts_words():
            raise ValueError("this tokenizer's words cannot be encoded alone")

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def cuts_words(self) -> bool:
        probe = "It's A  x1\n\n, (We'll) \t\x0b\x0c\ry.** Z--é 'tis!'s ..\"q\" ÀB\u0301 3.14 a.b"
        return self.whole([probe])[0] == self.encode(pa.array([probe]))[0].tolist()

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of single words, one after the other, and where each word's
        begin and how many they are. Words of letters only are one unit for
        the tokenizer and end with one word-end token: many go in one text."""
        begin, count = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        letters = np.fromiter(map(str.isalpha, words), bool, len(words))
        plain, other = np.flatnonzero(letters), np.flatnonzero(~letters).tolist()
        groups = [plain[a: a + 200] for a in range(0, len(plain), 200)]
        flat_ids, at = [], 0
        for g, ids in zip(groups, self.whole([" ".join([words[k] for k in g]) for g in groups])):
            a = np.array(ids, np.uint32)
            cut = np.flatnonzero(self.ends_word[a]) + 1
            if len(cut) == len(g):
                begin[g] = np.concatenate([[0], cut[:-1]]) + at
                count[g] = np.diff(cut, prepend=0)
                flat_ids.append(a)
                at += len(a)
            else:
                other += g.tolist()
        for k, ids in zip(other, self.whole([words[k] for k in other])):
            begin[k], count[k] = at, len(ids)
            flat_ids.append(np.array(ids, np.uint32))
            at += len(ids)
        return np.concatenate(flat_ids), begin, count

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """32-bit ids of each text; a null has none."""
        raw, offs = flat(texts)
        low = raw.tobytes().lower()
        apart = {int(np.searchsorted(offs, m.start(), "right")) - 1 for s in self.special for m in re.finditer(re.escape(s), low)}
        w = Words(texts, lower="ascii", marks=True)
        words = w.data.tobytes()
        make = lambda where: self._words([words[a:b].decode() for a, b in zip(w.start[where].tolist(), w.end[where].tolist())])
        ids, size = self.memo.get(w.hash, make) if len(w.hash) else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        cut = np.concatenate([[0], np.cumsum(size)])[w.first]
        out = [ids[a:b] for a, b in zip(cut[:-1], cut[1:])]
        for k in apart:
            out[k] = np.array(self.whole([texts[k].as_py()])[0], np.uint32)
        return out


def _write_partition(folder: str, tokenizer: str, end_id: int, level: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = worker_cache("encoder:" + tokenizer, lambda: WordEncoder(tokenizer))
        end = np.uint32(end_id)
        width = "<u2" if encoder.tok.get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else "<u4"
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        part = first.column("part")[0].as_py()
        index, total = [], 0

        def fill(out):
            nonlocal total
            file = SeekableWriter(out, level)

            def every():
                yield first
                yield from batches

            for batch in every():
                for piece in slices(batch, "text", 4 << 20):
                    for doc_id, ids in zip(piece.column("doc_id").to_pylist(), encoder.encode(piece.column("text"))):
                        a = np.append(ids, end).astype(width)
                        index.append((doc_id is not None, doc_id or 0, len(a), len(file.frames)))
                        total += len(a)
                        for k in range(0, len(a), FRAME_IDS):
                            file.frame(a[k: k + FRAME_IDS].tobytes())
            file.close(width.encode() + np.array(index, _INDEX).tobytes())

        path = commit_file(folder, f"ids-{part:06d}.zst", fill)
        yield pa.record_batch({"part": [part], "path": [path], "n_docs": [len(index)], "n_ids": [total]},
                              schema=pa.schema([("part", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    return write


def write_ids(df: DataFrame, folder: str, tokenizer: str, end_id: int = 1, id_col: str = "doc_id",
              text_col: str = "text", partitions: int | None = None, level: int = 1) -> DataFrame:
    """Write the files; returns the manifest (part, path, n_docs, n_ids, start),
    one row per file, where ``start`` counts the ids of all files before it. The
    number of files comes from the texts' bytes."""
    if partitions is None:
        partitions = (df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0) // FILE_TEXT + 1
    rows = (df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .repartitionByRange(partitions, F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
            .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
            .select(F.spark_partition_id().alias("part"), "doc_id", "text"))
    done = written(rows.mapInArrow(tidy(_write_partition(folder, tokenizer, end_id, level)),
                                   "part int, path string, n_docs long, n_ids long"), "ids-manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return done.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _read_files(wanted: frozenset | None, what: str):
    def read(batches):
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                fs, inner = filesystem(path)
                with fs.open_input_file(inner) as f:
                    file = SeekableReader(f)
                    width, index = file.index[:3].decode(), np.frombuffer(file.index[3:], _INDEX)
                    begin = start + np.concatenate([[0], np.cumsum(index["n"])])
                    last = np.append(index["first_frame"][1:], len(file.frames))
                    rows = []
                    for k, row in enumerate(index):
                        doc_id = int(row["doc_id"]) if row["has_id"] else None
                        if wanted is not None and doc_id not in wanted:
                            continue
                        ids = np.concatenate([np.frombuffer(file.frame(j), width) for j in range(row["first_frame"], last[k])]).astype("<u4")
                        rows.append((doc_id, int(begin[k]), len(ids), zlib.crc32(ids) if what == "digest" else ids))
                        if len(rows) >= 1000:
                            yield _table(rows, what)
                            rows = []
                    if rows:
                        yield _table(rows, what)

    return read


def _table(rows: list[tuple], what: str) -> pa.RecordBatch:
    last = ("ids_crc32", pa.int64()) if what == "digest" else ("ids", pa.list_(pa.int64()))
    names = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), last]
    cols = list(zip(*rows))
    return pa.record_batch([pa.array(list(c), t) for c, (_, t) in zip(cols, names)], schema=pa.schema(names))


def read_ids(manifest: DataFrame, wanted: list[int] | None = None, what: str = "ids") -> DataFrame:
    """Rows of the files: doc_id, start, n_tokens and ``ids`` (an array), or
    with ``what="digest"`` the crc32 of the ids as unsigned 32-bit integers.
    ``wanted``: only these documents' frames are decompressed."""
    tail = "ids_crc32 long" if what == "digest" else "ids array<long>"
    files = manifest.select("path", "start")
    # as many tasks as files: a file is read where its path arrives
    n = max(1, manifest.count())
    return files.repartitionByRange(n, "path").mapInArrow(
        _read_files(frozenset(wanted) if wanted is not None else None, what),
        f"doc_id long, start long, n_tokens long, {tail}")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_output(spark: SparkSession, documents: DataFrame) -> DataFrame:
    manifest = write_ids(documents, shared_folder(spark, "token-ids"), tokenizer_path("word_bpe_49k.json"))
    return read_ids(manifest, what="digest")
