import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from chronopanel.llm import subword_viterbi as S

from .helpers import AWKWARD, documents


@pytest.fixture(scope="module")
def vocabulary():
    return S.Vocabulary(S.model_path())


def brute(v, text):
    """Whole-lattice search: best score and path of the full text."""
    best, back = [0.0] + [None] * len(text), [None] * (len(text) + 1)
    for j in range(1, len(text) + 1):
        for i in range(max(0, j - v.longest), j):
            found = v.prefix.get(text[i:j])
            if found is None and j - i == 1 and v.prefix.get(text[i:j]) is None:
                found = (v.unknown, -1)
            if found is not None and best[i] is not None and (best[j] is None or best[i] + found[0] > best[j]):
                best[j], back[j] = best[i] + found[0], (i, found[1])
    out, j = [], len(text)
    while j:
        i, k = back[j]
        out.append([k] if k >= 0 else v.fallback(text[i:j]))
        j = i
    return [k for ids in reversed(out) for k in ids]


def test_stream_against_whole_lattice():
    g = random.Random(6)
    for _ in range(200):
        pieces = {"".join(g.choices("ab▁", k=g.randint(1, 5))) for _ in range(12)}
        v = S.Vocabulary.of({p: -g.randint(1, 9) * 1.0 for p in sorted(pieces)})
        text = "".join(g.choices("abc▁", k=g.randint(0, 300)))
        chunks, at = [], 0
        while at < len(text):
            n = g.randint(1, 40)
            chunks.append(text[at: at + n])
            at += n
        assert list(S.stream(v, chunks)) == brute(v, text)


def test_window_stays_bounded(vocabulary):
    s = S.StreamingViterbi(vocabulary)
    n = sum(len(s.feed("abcdefghij" * 10)) for _ in range(300))
    assert s.window <= 8 * vocabulary.longest and len(s.text) <= 8 * vocabulary.longest
    assert n > 0


def unigram_model():
    """The same pieces and scores with the model type set to unigram."""
    raw = open(S.model_path(), "rb").read()

    def fields(b):
        at = 0

        def varint():
            nonlocal at
            x = shift = 0
            while True:
                c = b[at]
                at += 1
                x |= (c & 127) << shift
                shift += 7
                if c < 128:
                    return x
        while at < len(b):
            begin, tag = at, varint()
            head = at
            if tag & 7 == 2:
                n = varint()
                head, at = at, at + n
            elif tag & 7 == 0:
                varint()
            else:
                at += 4 if tag & 7 == 5 else 8
            yield tag >> 3, b[begin:at], b[head:at]

    def field(number, body):
        n, out = len(body), bytearray([number << 3 | 2])
        while n > 127:
            out.append(n & 127 | 128)
            n >>= 7
        return bytes(out + bytes([n])) + body

    spec = b""
    out = b""
    for number, whole, body in fields(raw):
        if number == 2:
            spec = b"".join(w for k, w, _ in fields(body) if k != 3) + bytes([3 << 3, 1])
            out += field(2, spec)
        else:
            out += whole
    sp = sentencepiece.SentencePieceProcessor()
    sp.load_from_serialized_proto(out)
    return sp


def test_no_worse_than_the_library(vocabulary):
    """No path that the library finds has a better score than ours."""
    sp, e = unigram_model(), S.TextEncoder(vocabulary)
    plain = sentencepiece.SentencePieceProcessor(model_file=S.model_path())
    for t in ["Hello world", "the quick brown fox jumps", "Thnterononshth, oning oferndenan", "internationalization of words", "Nicht aulich für"]:
        ours, theirs = e.whole(t).tolist(), sp.encode(t)
        score = lambda ids: sum(sp.get_score(k) for k in ids)
        assert score(ours) >= max(score(theirs), score(plain.encode(t)))
        assert sp.decode(ours) == t


def test_encode_decode_round_trip(spark):
    docs = documents(spark).drop("ids")
    out = S.decode(S.encode(docs, S.model_path()), S.model_path()).collect()
    assert len(out) == len(AWKWARD) and set(docs.columns) | {"ids", "decoded"} == set(out[0].asDict())
    for r in out:
        assert r["decoded"] == (r["text"] or "")
        assert (len(r["ids"]) == 0) == (not r["text"])
    told = S.encoded_documents(spark, documents(spark)).collect()
    assert all(r["round_trip"] for r in told) and sorted(r["n_ids"] for r in told) == sorted(len(r["ids"]) for r in out)
    with pytest.raises(ValueError):
        S.encode(documents(spark), S.model_path())


def test_segments_equal_whole_texts(vocabulary):
    e = S.TextEncoder(vocabulary)
    odd = ["", None, " ", "a", "  a b", "a  b", "a \nb", "a\n b", "\n", "\na", "a\n", "a ", "a\n\nb\n", "é x▁y ▁z", "\t a\tb", "😀 \x00"]
    assert [o.tolist() for o in e.encode(pa.array(odd))] == [e.whole(t).tolist() for t in odd]
    assert e.decode(np.array(e.whole("a▁b"))) == "a b"


def test_empty_table(spark):
    assert S.encoded_documents(spark, documents(spark).limit(0)).collect() == []
