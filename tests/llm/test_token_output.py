import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from tokenizers import Tokenizer

from chronopanel.llm import token_output as O
from chronopanel.llm.seekable import SeekableReader
from chronopanel.llm.store import filesystem, shared_folder

from .helpers import AWKWARD, documents

PATH = O.tokenizer_path("word_bpe_49k.json")


def expected(rows):
    tok, out, start = Tokenizer.from_file(PATH), [], 0
    for i, t in sorted(((i, t) for i, t, *_ in rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


def test_round_trip(spark):
    manifest = O.write_ids(documents(spark), shared_folder(spark, "ids"), PATH, partitions=4)
    key = lambda r: (r[1], r[0] is not None)
    assert sorted((tuple(r) for r in O.read_ids(manifest, what="digest").collect()), key=key) == [r[:4] for r in expected(AWKWARD)]
    assert sorted((tuple(r) for r in O.read_ids(manifest).collect()), key=key) == [(*r[:3], r[4]) for r in expected(AWKWARD)]
    some = O.read_ids(manifest, wanted=[3, 9]).collect()
    assert {r["doc_id"] for r in some} == {3, 9}


def test_only_wanted_frames_are_read_and_damage_is_found(spark, tmp_path):
    manifest = O.write_ids(documents(spark), "file://" + str(tmp_path), PATH, partitions=1)
    path = manifest.first()["path"]
    fs, inner = filesystem(path)
    raw = bytearray(open(inner, "rb").read())
    plain = zstandard.ZstdDecompressor().stream_reader(bytes(raw), read_across_frames=True).read()
    assert len(plain) == 2 * sum(r[2] for r in expected(AWKWARD))  # plain zstd readers skip the tables
    with fs.open_input_file(inner) as f:
        file = SeekableReader(f)
        assert len(file.frames) == len(AWKWARD)
        at = int(file.begin[5])
    raw[at + 6] ^= 0xFF
    open(inner, "wb").write(raw)
    with fs.open_input_file(inner) as f:
        file = SeekableReader(f)
        file.frame(4)
        with pytest.raises((ValueError, zstandard.ZstdError)):
            file.frame(5)


def test_empty_table(spark):
    manifest = O.write_ids(documents(spark).limit(0), shared_folder(spark, "ids"), PATH)
    assert manifest.collect() == [] and O.read_ids(manifest, what="digest").collect() == []


def test_words_alone_equal_whole_texts():
    import pyarrow as pa

    e = O.WordEncoder(PATH)
    odd = ["", None, "a<|endoftext|>b <|ENDOFTEXT|> c", "It's <|startoftext|>", "x" * 100000, "É́ K İx ΑΣ ς \x1cd",
           "'S 'LL don't.''s --'d 123abc4 a1.b2", " \n\t ", "中文 text—dash “quotes” ½²"]
    assert [o.tolist() for o in e.encode(pa.array(odd))] == e.whole([t or "" for t in odd])


def test_letters_before_combining_marks():
    """Characters compose before they are lower-cased: T + U+0308 stays two."""
    tok, enc = Tokenizer.from_file(PATH), O.WordEncoder(PATH)
    texts = [a + chr(m) for a in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ" for m in range(0x300, 0x370)]
    texts += [f"x {t}y, Z{t}." for t in texts]
    for t, got in zip(texts, enc.encode(pa.array(texts))):
        assert got.tolist() == tok.encode(t, add_special_tokens=False).ids, t
