"""Language labels from a bidirectional gated recurrent network over bytes.

``train`` fits the network in numpy by backpropagation through time on
segments of a bounded sample of labelled rows; ``label`` runs it in the tasks
over every byte of every text. Each position gets a probability for each
language; a document's probabilities are the mean over its positions, and the
``spans`` are the runs of positions with the same best language.

Long texts are run as windows of ``WINDOW`` bytes side by side, each starting
from the zero state in both directions, so memory does not grow with a text's
length and no byte is left out.

Defined cases: a text that is null or has no letter is ``und`` with score 0
and no span; if there is no labelled row at all, every text is ``und``; equal
texts get equal answers; other columns pass through untouched, the results
come in one struct whose name the caller chooses.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import tidy
from .words import flat, slices

HIDDEN = 10
WINDOW = 256
SEGMENT = 96
BATCH = 2048
SAMPLE_PER_LANGUAGE = 600
SEGMENTS_PER_ROW = 4
STEPS = 260
PAD = 256
MOST_LANGUAGES = 500


@dataclass
class Network:
    """Weights of both directions: ``table`` (3H x 256, a byte's input to the
    update, reset and candidate gates with the bias), ``rec`` (3H x H), ``out``
    (K x H), and ``bias`` (K)."""

    langs: list[str]
    table: list[np.ndarray]
    rec: list[np.ndarray]
    out: list[np.ndarray]
    bias: np.ndarray

    @classmethod
    def start(cls, langs: list[str], hidden: int = HIDDEN, seed: int = 7) -> Network:
        g, k = np.random.default_rng(seed), len(langs)
        f = lambda *s, by: (g.standard_normal(s) * by).astype(np.float32)
        return cls(langs, [f(3 * hidden, 256, by=0.3) for _ in range(2)], [f(3 * hidden, hidden, by=hidden ** -0.5) for _ in range(2)],
                   [f(k, hidden, by=hidden ** -0.5) for _ in range(2)], np.zeros(k, np.float32))

    def weights(self) -> list[np.ndarray]:
        return [*self.table, *self.rec, *self.out, self.bias]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-2, keepdims=True))
    return x / x.sum(axis=-2, keepdims=True)


def _forward(net: Network, side: int, x: np.ndarray, live: np.ndarray):
    """Hidden states (L x H x B) and what the backward pass needs. ``live``
    stops the state at padding."""
    h = net.rec[side].shape[1]
    length, b = x.shape
    state, kept, states = np.zeros((h, b), np.float32), [None] * length, np.empty((length, h, b), np.float32)
    for t in range(length) if side == 0 else range(length - 1, -1, -1):
        inp, rec = net.table[side][:, x[t]], net.rec[side] @ state
        z, r = _sigmoid(inp[:h] + rec[:h]), _sigmoid(inp[h: 2 * h] + rec[h: 2 * h])
        n = np.tanh(inp[2 * h:] + r * rec[2 * h:])
        kept[t] = (state, z, r, n, rec[2 * h:])
        new = n + z * (state - n)
        state = np.where(live[t], new, state)
        states[t] = state
    return states, kept


def _backward(net: Network, side: int, x, live, kept, d_states, d_table, d_rec) -> None:
    h = net.rec[side].shape[1]
    length = len(x)
    carry = np.zeros_like(d_states[0])
    grads = np.empty((3 * h, length * x.shape[1]), np.float32)
    for t in range(length - 1, -1, -1) if side == 0 else range(length):
        prev, z, r, n, rn = kept[t]
        d = d_states[t] + carry
        d_new = d * live[t]
        d_n = d_new * (1 - z) * (1 - n * n)
        d_z = d_new * (prev - n) * z * (1 - z)
        d_r = d_n * rn * r * (1 - r)
        g_in = np.concatenate([d_z, d_r, d_n])
        g_rec = np.concatenate([d_z, d_r, d_n * r])
        d_rec += g_rec @ prev.T
        grads[:, t * x.shape[1]: (t + 1) * x.shape[1]] = g_in
        carry = d * ~live[t] + d_new * z + net.rec[side].T @ g_rec
    flat_x = x.ravel()
    for k in range(3 * h):
        d_table[k] += np.bincount(flat_x, weights=grads[k], minlength=256)


def loss_and_grads(net: Network, x: np.ndarray, live: np.ndarray, y: np.ndarray):
    """Mean cross-entropy over all live positions and its gradients."""
    k, b = len(net.langs), x.shape[1]
    fwd, kept_f = _forward(net, 0, x, live)
    bwd, kept_b = _forward(net, 1, x, live)
    p = _softmax(net.out[0] @ fwd + net.out[1] @ bwd + net.bias[:, None])
    count = live.sum()
    loss = -(np.log(np.maximum(p[:, y, np.arange(b)], 1e-12)) * live).sum() / count
    d = p
    d[:, y, np.arange(b)] -= 1
    d *= (live / count).astype(np.float32)[:, None, :]
    grads = [np.zeros_like(w) for w in net.weights()]
    for side, (states, kept) in enumerate(((fwd, kept_f), (bwd, kept_b))):
        grads[4 + side] += np.einsum("lkb,lhb->kh", d, states, optimize=True)
        _backward(net, side, x, live, kept, net.out[side].T @ d, grads[side], grads[2 + side])
    grads[6] += d.sum(axis=(0, 2))
    return loss, grads


def fit(langs: list[str], rows: list[tuple[str, bytes]], hidden: int = HIDDEN, steps: int = STEPS, batch: int = 256, seed: int = 7) -> Network:
    """Adam over random segments, each language drawn equally often."""
    g, net = np.random.default_rng(seed), Network.start(langs, hidden, seed)
    by = {lang: [s for k, s in rows if k == lang and s] for lang in langs}
    m = [np.zeros_like(w) for w in net.weights()]
    v = [np.zeros_like(w) for w in net.weights()]
    for step in range(1, steps + 1):
        y = g.integers(0, len(langs), batch)
        x, live = np.zeros((SEGMENT, batch), np.uint8), np.zeros((SEGMENT, batch), bool)
        for c, k in enumerate(y):
            own = by[langs[k]]
            s = np.frombuffer(own[g.integers(len(own))], np.uint8)[:SEGMENT]
            x[: len(s), c], live[: len(s), c] = s, True
        _, grads = loss_and_grads(net, x, live, y)
        norm = np.sqrt(sum(float((a * a).sum()) for a in grads))
        rate = 0.03 * min(1.0, 3 * (1 - step / (steps + 1))) * min(1.0, 1.0 / max(norm, 1e-9))
        for w, a, mi, vi in zip(net.weights(), grads, m, v):
            mi += 0.1 * (a - mi)
            vi += 0.01 * (a * a - vi)
            w -= rate * (mi / (1 - 0.9 ** step)) / (np.sqrt(vi / (1 - 0.99 ** step)) + 1e-8)
    return net


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
          per_language: int = SAMPLE_PER_LANGUAGE, **how) -> Network | None:
    """Fit on about ``per_language`` labelled rows of each language (fewer
    where there are fewer), chosen by a hash of their id, with up to
    ``SEGMENTS_PER_ROW`` segments each: the driver gets at most
    1.5 x per_language x languages x SEGMENTS_PER_ROW x SEGMENT characters."""
    t = F.col(text_col)
    rows = docs.where(F.col(lang_col).isNotNull() & t.isNotNull() & (F.length(t) > 0))
    counts = {r[0]: r[1] for r in rows.groupBy(lang_col).count().limit(MOST_LANGUAGES + 1).collect()}
    if not counts:
        return None
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages; is {lang_col} the label?")
    scale = 1 << 30
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, int(scale * min(1.0, per_language / n)) + 1)])
    draw = lambda i: F.pmod(F.xxhash64(id_col, F.lit("language-sample"), F.lit(i) if isinstance(i, int) else i), F.lit(scale))
    seg = F.transform(F.sequence(F.lit(1), F.lit(SEGMENTS_PER_ROW)),
                      lambda i: F.substring(t, (draw(i) % F.greatest(F.length(t) - SEGMENT, F.lit(1)) + 1).cast("int"), F.lit(SEGMENT)))
    picked = rows.where(draw(0) < share[F.col(lang_col)]).select(F.col(lang_col).alias("lang"), seg.alias("seg"), draw(0).alias("u"))
    got = picked.orderBy("u").limit(int(1.5 * per_language * len(counts)) + 100).collect()
    pairs = sorted((r["lang"], s.encode()) for r in got for s in r["seg"])
    langs = sorted({k for k, s in pairs if s})
    return fit(langs, pairs, **how) if langs else None


def _product(weights: np.ndarray, state: np.ndarray, out: np.ndarray) -> None:
    """weights @ state, each column's terms added in the same order wherever
    the column stands: a library's matrix product does not promise that."""
    np.einsum("kj,jb->kb", weights, state, out=out, optimize=False)


class Labeller:
    """The network as it runs in tasks: gates' halves folded into the weights
    (a sigmoid is a tanh of half its argument), all windows of a batch side by
    side."""

    def __init__(self, net: Network):
        self.net, h = net, net.rec[0].shape[1]
        half = np.ones((3 * h, 1), np.float32)
        half[: 2 * h] = 0.5
        pad = np.zeros((3 * h, 1), np.float32)
        pad[:h] = 50  # the update gate is shut: padding leaves the state as it is
        self.table = [np.concatenate([w * half, pad], axis=1) for w in net.table]
        self.rec = [np.ascontiguousarray(w * half) for w in net.rec]
        self.h = h

    def run(self, x: np.ndarray) -> np.ndarray:
        """Probabilities (L x K x B) of all positions of ``x`` (L x B bytes,
        ``PAD`` after a window's end)."""
        length, b = x.shape
        h, k = self.h, len(self.net.langs)
        logits = np.empty((length, k, b), np.float32)
        inp, rec = np.empty((3 * h, b), np.float32), np.empty((3 * h, b), np.float32)
        n, add = np.empty((h, b), np.float32), np.empty((k, b), np.float32)
        for side in (0, 1):
            state = np.zeros((h, b), np.float32)
            for t in range(length) if side == 0 else range(length - 1, -1, -1):
                np.take(self.table[side], x[t], axis=1, out=inp, mode="clip")
                _product(self.rec[side], state, rec)
                gate = inp[: 2 * h]
                gate += rec[: 2 * h]
                np.tanh(gate, out=gate)
                gate *= 0.5
                gate += 0.5
                np.multiply(gate[h:], rec[2 * h:], out=n)
                n += inp[2 * h:]
                np.tanh(n, out=n)
                state -= n
                state *= gate[:h]
                state += n
                if side == 0:
                    _product(self.net.out[0], state, logits[t])
                else:
                    _product(self.net.out[1], state, add)
                    logits[t] += add
        logits += self.net.bias[:, None]
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits

    def label_texts(self, data: np.ndarray, offs: np.ndarray, spans: bool):
        """Per text: summed probabilities (K), positions per best language
        (K), and if asked the runs (start, end, language index)."""
        k, size = len(self.net.langs), np.diff(offs)
        n_win = -(-size // WINDOW)
        text = np.repeat(np.arange(len(size)), n_win)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(n_win) - n_win, n_win)
        begin = offs[text] + nth * WINDOW
        span = np.minimum(WINDOW, offs[text + 1] - begin)
        sums, votes = np.zeros((len(size), k)), np.zeros((len(size), k), np.int64)
        best = np.empty(len(data), np.uint16) if spans else None
        order = np.argsort(span, kind="stable")  # windows of about one length side by side
        for a in range(0, len(order), BATCH):
            rows = order[a: a + BATCH]
            step = np.arange(int(span[rows[-1]]))[:, None]
            live = step < span[rows]
            at = np.minimum(begin[rows] + step, len(data) - 1)
            p = self.run(np.where(live, data[at], np.uint16(PAD)))
            p *= live[:, None, :]
            np.add.at(sums, text[rows], p.sum(axis=0, dtype=np.float64).T)
            np.add.at(votes, text[rows], (p >= p.max(axis=1, keepdims=True)).sum(axis=0, where=live[:, None, :]).T)
            if spans:
                best[at[live]] = p.argmax(axis=1)[live]
        runs = [self._runs(best[lo:hi]) for lo, hi in zip(offs[:-1], offs[1:])] if spans else None
        return sums, votes, runs

    def _runs(self, best: np.ndarray) -> list[tuple[int, int, str]]:
        if not len(best):
            return []
        cut = np.r_[0, np.flatnonzero(best[1:] != best[:-1]) + 1, len(best)]
        return [(int(a), int(b), self.net.langs[best[a]]) for a, b in zip(cut[:-1], cut[1:])]


_RESULT = [("lang_pred", pa.string()), ("score", pa.float64()), ("n_positions", pa.int64()), ("vote", pa.float64())]
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))


def _label(net: Network | None, text_col: str, out_col: str, spans: bool):
    names = _RESULT + ([("spans", _SPANS)] if spans else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lab = Labeller(net) if net else None
        for whole in batches:
            for batch in slices(whole, text_col, 2 << 20):
                texts = batch.column(text_col)
                und = [t is None or lab is None or not any(map(str.isalpha, t)) for t in texts.to_pylist()]
                data, offs = flat(texts)
                size = np.diff(offs)
                if lab is None:
                    rows = [("und", 0.0, int(n), 0.0, []) for n in size]
                else:
                    sums, votes, runs = lab.label_texts(data, offs, spans)
                    p = sums / np.maximum(size, 1)[:, None]
                    top = p.argmax(axis=1)
                    rows = [("und", 0.0, int(n), 0.0, []) if u else
                            (net.langs[j], min(1.0, float(p[i, j])), int(n), float(votes[i, j] / n), runs[i] if spans else None)
                            for i, (u, j, n) in enumerate(zip(und, top, size))]
                cols = [pa.array([r[i] if name != "spans" else [dict(zip(("start", "end", "lang"), s)) for s in r[4]] for r in rows], kind)
                        for i, (name, kind) in enumerate(names)]
                answer = pa.StructArray.from_arrays(cols, names=[n for n, _ in names])
                keep = [c for c in batch.schema.names if c != out_col]
                yield pa.record_batch([*[batch.column(c) for c in keep], answer], names=[*keep, out_col])

    return run


def label(df: DataFrame, net: Network | None, text_col: str = "text", out_col: str = "language", spans: bool = False) -> DataFrame:
    """``df`` with the struct ``out_col``: lang_pred, score (mean probability
    of that language over all positions), n_positions, vote (share of positions
    labelled with it) and, if asked, spans (start, end, lang in bytes)."""
    if out_col in df.columns:
        raise ValueError(f"{out_col} is a column of the input; choose another out_col")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    answer = "struct<lang_pred:string,score:double,n_positions:bigint,vote:double" + (
        ",spans:array<struct<start:bigint,end:bigint,lang:string>>" if spans else "") + ">"
    return df.mapInArrow(tidy(_label(net, text_col, out_col, spans)), f"{schema}, `{out_col}` {answer}")


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def predicted_languages(spark: SparkSession, documents: DataFrame) -> DataFrame:
    net = train(documents.where(~held_out()))
    out = label(documents.select("doc_id", "text"), net)
    return out.select("doc_id", held_out().alias("held_out"), "language.lang_pred", "language.score", "language.vote")
