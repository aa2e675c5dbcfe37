import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from chronopanel.llm import bpe_codec as B
from chronopanel.llm.queries import op11_bpe_codec

from .helpers import AWKWARD, documents, save

PATH = B.tokenizer_path("word_bpe_49k.json")
POOLS = [list("abcABC'’.,<>=`~! \t\n\x0b\x0c\r\x1c\x85\xa0"), [chr(i) for i in range(0x20, 0x250)], [chr(i) for i in range(0x300, 0x370)],
         list("ÅÄÖåäöß İıſKÅΐΣσς≮≠≯"), [chr(i) for i in range(0x370, 0x3000)], [chr(0x1F600 + i) for i in range(40)],
         ["<|endoftext|>", "<|startoftext|>", "'s", "'LL", "'ve"]]


def scanned(symbols, merges):
    """Merges one after the other, each found by looking at all pairs."""
    ranks, made, s = {p: k for k, p in enumerate(merges)}, list(merges.values()), list(symbols)
    while True:
        best = min(((ranks[p], i) for i, p in enumerate(zip(s, s[1:])) if p in ranks), default=None)
        if best is None:
            return s
        s[best[1]: best[1] + 2] = [made[best[0]]]


def test_merger_against_scans():
    rng = random.Random(5)
    for _ in range(60):
        merges, top = {}, 4
        for _ in range(rng.randint(0, 25)):
            pair = (rng.randrange(top), rng.randrange(top))
            if pair not in merges:
                merges[pair] = top
                top += 1
        m = B.Merger(merges)
        pieces = [[rng.randrange(4) for _ in range(rng.choice([1, 2, 3, 4, 5, 8, 9, 17, 40]))] for _ in range(30)]
        pieces.append([rng.randrange(4) for _ in range(400)])  # longer than a tree of the forest
        flat, n = m.many(np.array([x for p in pieces for x in p]), np.array([len(p) for p in pieces]))
        cut = np.concatenate([[0], np.cumsum(n)])
        want = [scanned(p, merges) for p in pieces]
        assert [flat[a:b].tolist() for a, b in zip(cut, cut[1:])] == want
        assert [m.one(p) for p in pieces] == want


def test_ids_and_text_equal_the_library():
    rng = random.Random(1)
    texts = [a + chr(m) for a in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ" for m in range(0x300, 0x370)]
    texts += ["x" * n + " " + "ab" * n for n in (1, 2, 3, 129, 130, 20000)]
    texts += ["<|endoftext|>", "a<|endoftext|>b <|startoftext|><|endoftext|>", "<|ENDOFTEXT|>", "<|endoftext", "", None]
    texts += ["".join(rng.choice(rng.choice(POOLS)) for _ in range(rng.randint(1, 14))) for _ in range(8000)]
    lib, codec = Tokenizer.from_file(PATH), B.Codec(PATH)
    for batch in (texts[:100], texts):  # the memo is empty, then in use
        for t, got in zip(batch, codec.encode(pa.array(batch))):
            want = lib.encode(t or "", add_special_tokens=False).ids
            assert got.tolist() == want, t
            assert codec.decode(got).decode() == lib.decode(want, skip_special_tokens=False)


def test_memo_starts_anew_when_full(monkeypatch):
    codec = B.Codec(PATH)
    codec.memo.most = 3
    texts = [f"word{i} Word{i % 3} ünd{i}" for i in range(50)]
    lib = Tokenizer.from_file(PATH)
    for _ in range(2):
        for a in range(0, 50, 7):
            for t, got in zip(texts[a: a + 7], codec.encode(pa.array(texts[a: a + 7]))):
                assert got.tolist() == lib.encode(t, add_special_tokens=False).ids


def test_query_on_awkward_rows(spark, tmp_path):
    lib = Tokenizer.from_file(PATH)

    def row(i, t):
        ids = lib.encode(t or "", add_special_tokens=False).ids
        sha = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        return (i, len(ids), sha, hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest())

    out = op11_bpe_codec(spark, save(documents(spark), tmp_path))
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(map(tuple, out.collect()), key=key) == sorted((row(i, t) for i, t, *_ in AWKWARD), key=key)
    assert op11_bpe_codec(spark, save(documents(spark, []), tmp_path / "none")).collect() == []


def test_encode_and_decode_keep_other_columns(spark):
    docs = documents(spark)
    with pytest.raises(ValueError):
        B.encode(docs, PATH)  # ``ids`` is a column already
    coded = B.encode(docs, PATH, out_col="tokens")
    back = B.decode(coded, PATH, ids_col="tokens")
    assert coded.columns == [*docs.columns, "tokens"] and back.columns == [*coded.columns, "decoded"]
    lib = Tokenizer.from_file(PATH)
    for r in back.collect():
        assert r["tokens"] == lib.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["decoded"] == lib.decode(r["tokens"], skip_special_tokens=False)
