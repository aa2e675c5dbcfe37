import random

import numpy as np
import pyarrow as pa

from chronopanel.llm import language_id as L
from chronopanel.llm.words import flat

from .helpers import AWKWARD, documents

SYLLABLES = {"aa": ["ka", "ti", "mo", "lu"], "bb": ["sch", "ung", "ber", "ein"]}


def invented(n=160, seed=1):
    g = random.Random(seed)
    out = []
    for i in range(n):
        lang = "aa" if i % 2 else "bb"
        out.append((i, " ".join("".join(g.choices(SYLLABLES[lang], k=3)) for _ in range(40)), lang, None))
    return out


def test_gradients():
    x = np.frombuffer(b"abcdefgh", np.uint8).reshape(4, 2).astype(np.int64)
    live = np.ones((4, 2), bool)
    live[3, 1] = False
    net, y = L.Network.start(["a", "b"], 3), np.array([0, 1])
    _, grads = L.loss_and_grads(net, x, live, y)
    for w, g in zip(net.weights(), grads):
        i = np.unravel_index(np.abs(g).argmax(), g.shape)
        was = w[i]
        w[i] = was + 1e-2
        up = L.loss_and_grads(net, x, live, y)[0]
        w[i] = was - 1e-2
        down = L.loss_and_grads(net, x, live, y)[0]
        w[i] = was
        assert abs((up - down) / 2e-2 - g[i]) < 1e-3


def test_batched_run_equals_plain_forward():
    net = L.Network.start(["a", "b", "c"], 4)
    texts = ["hello world", "z", "x" * 700, "äöü" * 100]
    data, offs = flat(pa.array(texts))
    sums, votes, runs = L.Labeller(net).label_texts(data, offs, True)
    for k, t in enumerate(texts):
        raw = np.frombuffer(t.encode(), np.uint8)
        p = np.zeros(3)
        for a in range(0, len(raw), L.WINDOW):
            x = raw[a: a + L.WINDOW][:, None].astype(np.int64)
            live = np.ones(x.shape, bool)
            f, _ = L._forward(net, 0, x, live)
            b, _ = L._forward(net, 1, x, live)
            p += L._softmax(net.out[0] @ f + net.out[1] @ b + net.bias[:, None])[:, :, 0].sum(axis=0)
        assert np.allclose(p, sums[k], rtol=1e-3)
        assert runs[k][0][0] == 0 and runs[k][-1][1] == len(raw) and votes[k].sum() >= len(raw)
        assert all(a[1] == b[0] and a[2] != b[2] for a, b in zip(runs[k], runs[k][1:]))


def test_held_out_accuracy_and_spans(spark):
    rows = invented()
    docs = documents(spark, rows, extra=False)
    net = L.train(docs.where(~L.held_out()), steps=60, hidden=6)
    out = L.label(docs, net, spans=True).where(L.held_out()).collect()
    assert len(out) > 20
    assert sum(r["language"]["lang_pred"] == r["lang"] for r in out) / len(out) > 0.95
    mixed = documents(spark, [(0, rows[1][1][:200] + " " + rows[0][1][:200], None, None)], extra=False)
    spans = L.label(mixed, net, spans=True).first()["language"]["spans"]
    assert spans[0]["lang"] == "aa" and spans[-1]["lang"] == "bb" and spans[-1]["end"] == 401


def test_awkward_rows(spark):
    docs = documents(spark)
    net = L.train(docs, steps=5)
    out = L.label(docs, net).collect()
    assert len(out) == len(AWKWARD) and set(docs.columns) | {"language"} == set(out[0].asDict())
    for r in out:
        has_letter = any(c.isalpha() for c in r["text"] or "")
        assert (r["language"]["lang_pred"] == "und") == (not has_letter)
        assert 0 <= r["language"]["score"] <= 1
    by = {r["doc_id"]: r["language"] for r in out}
    assert by[0] == by[4]


def test_nothing_to_learn_from(spark):
    docs = documents(spark)
    assert L.train(docs.where("lang is null")) is None
    assert {r["language"]["lang_pred"] for r in L.label(docs, None).collect()} == {"und"}
    assert L.predicted_languages(spark, docs.limit(0)).collect() == []


def test_a_text_has_one_answer_wherever_it_stands():
    g = np.random.default_rng(0)
    text, answers = "Das ist ein Satz mit etwas Länge, einmal hier. " * 9, set()
    net = L.Network.start(["a", "b", "c"], L.HIDDEN)
    for w in net.weights():
        w += (g.standard_normal(w.shape) * 0.3).astype(w.dtype)
    lab = L.Labeller(net)
    places = [(n, k) for n in (1, 2, 3, 5, 8, 9, 16, 17, 33, 64, 100, 257, 700) for k in sorted({0, n // 3, n // 2, n - 1})]
    assert len(places) >= 40
    for n, k in places:
        others = ["".join(map(chr, g.integers(97, 123, g.integers(1, 900)))) for _ in range(n - 1)]
        sums, votes, _ = lab.label_texts(*flat(pa.array(others[:k] + [text] + others[k:])), False)
        answers.add((*sums[k].tolist(), *votes[k].tolist()))
    assert len(answers) == 1
