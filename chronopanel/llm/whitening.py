"""Whitening of embeddings by a bidiagonal qd solver.

1. Each component c becomes the whole number x = floor(256 c). The fit list
   holds each distinct x vector once; its count n and its sums S are exact.
2. Blockwise QR: every task reduces its centred rows (n x - S) / n, each one
   exact but for a single rounding, to one triangular factor; factors are
   stacked and reduced again, a bounded number at a time, to one R with
   R'R = n V.
3. R, whose size is the dimension's alone, is bidiagonalised by Householder
   reflections. ``singular_squares`` (dqds: differential qd steps with shifts
   that are certain to be lower bounds) gives the squares of its singular
   values to high relative accuracy.
4. ``bidiagonal_vector``: for each wanted value the twisted factorisation of
   B'B - e, put together from a stationary and a progressive qd transform at
   the place where its pivot is smallest, gives the vector without a solve.
   Values closer than ``CLOSE`` to a neighbour may give vectors that are not
   orthogonal; these are separated by inverse iteration with the factors.

Defined cases: rows whose vector is null or holds null or non-finite entries
are dropped; rows without id and rows that repeat an id or a vector are each
whitened; a component whose variance is zero (a constant table, fewer distinct
vectors than components) has no rows; equal variances give some orthonormal
basis of their space; an empty table gives no rows; other columns are ignored,
whatever their names; ``deviation`` is null where it exceeds a long; vectors of
different lengths, or with components of 2^44 and more, are an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import tidy, written
from .vectors import exact_squares, long_list, one_length, whole_numbers

SCALE = 256
EPS = float(np.finfo(float).eps)
#: factors that one task stacks and reduces to one
STACK = 64
#: relative distance of variances below which vectors are made orthogonal
CLOSE = 1e-3
FACTOR = "d int, r array<double>"


# ------------------------------------------------------------- local algebra
def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and right orthogonal factor of an upper
    bidiagonal B with R = U B V', by Householder reflections."""
    a = np.array(r, float)
    d = a.shape[1]
    v = np.eye(d)

    def reflector(x):
        """w and beta of I - beta w w', which turns x into a multiple of e1."""
        w = x.copy()
        tail = np.linalg.norm(x[1:])
        if tail == 0:
            return w, 0.0
        length = math.hypot(x[0], tail)
        w[0] = x[0] + math.copysign(length, x[0])
        return w, 2.0 / (w @ w)

    for k in range(d):
        scale = np.abs(a[k:, k]).max()
        if scale > 0:
            w, beta = reflector(a[k:, k] / scale)
            a[k:, k:] -= beta * np.outer(w, w @ a[k:, k:])
        if k < d - 2:
            scale = np.abs(a[k, k + 1:]).max()
            if scale > 0:
                w, beta = reflector(a[k, k + 1:] / scale)
                a[k:, k + 1:] -= beta * np.outer(a[k:, k + 1:] @ w, w)
                v[:, k + 1:] -= beta * np.outer(v[:, k + 1:] @ w, w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _qd_step(q: list[float], e: list[float], shift: float) -> tuple[list, list, list]:
    """One differential qd transform with a shift: the new q and e, and the
    differences d, whose inverses at shift 0 sum to the trace of the inverse."""
    n = len(q)
    d, qs, es, ds = q[0] - shift, [], [], []
    for k in range(n - 1):
        ds.append(d)
        new = d + e[k]
        if new == 0:  # a zero value, not yet at the end
            ratio_d, ratio_e = (1.0, 0.0) if e[k] == 0 else (0.0, 1.0)
            qs.append(0.0)
            es.append(q[k + 1] * ratio_e)
            d = q[k + 1] * ratio_d - shift
            continue
        t = q[k + 1] / new
        qs.append(new)
        es.append(e[k] * t)
        d = d * t - shift
    ds.append(d)
    qs.append(d)
    return qs, es, ds


def singular_squares(diag: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix, largest first.

    The smallest value of a block is found first: a plain step gives the lower
    bound 1 / trace(inverse), the next step is shifted by it, so q stays
    positive; when the last e is negligible the value is split off."""
    top = max(np.abs(diag).max(initial=0), np.abs(upper).max(initial=0))
    if top == 0:
        return np.zeros(len(diag))
    tiny, negligible = 1e-280, (4 * EPS) ** 2
    q, e = [max(float(x / top) ** 2, tiny) for x in diag], [float(x / top) ** 2 for x in upper]
    found, blocks = [], [(q, e, 0.0)]
    while blocks:
        q, e, sigma = blocks.pop()
        steps = 0
        while q:
            n = len(q)
            if n == 1:
                found.append(sigma + q.pop())
                break
            cut = next((k for k in range(n - 2, -1, -1) if e[k] <= negligible * (sigma + min(q[k], q[k + 1])) or e[k] < tiny), None)
            if cut == n - 2:
                found.append(sigma + q.pop())
                e.pop()
                steps = 0
                continue
            if cut is not None:
                blocks.append((q[: cut + 1], e[:cut], sigma))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            if steps == 0 and q[0] < q[-1]:
                # graded the wrong way round: the reversed matrix has the same values
                q, e = _reversed(q, e)
            steps += 1
            if steps > 60 * n:
                raise ArithmeticError("the qd iteration does not converge")
            q, e, d = _qd_step(q, e, 0.0)
            if min(d) <= 0:
                continue
            shift = (1 - 64 * n * EPS) / sum(1 / x for x in d)
            while shift > 0:
                moved = _qd_step(q, e, shift)
                if min(moved[2]) >= 0:
                    q, e = moved[:2]
                    sigma += shift
                    break
                shift *= 0.25 if shift > EPS * sigma else 0.0
    return np.sort(np.array(found))[::-1] * top * top


def _reversed(q: list[float], e: list[float]) -> tuple[list, list]:
    """q and e of the matrix read from its other end: B B' instead of B'B in
    reversed order has the rows of the reversed bidiagonal."""
    return q[::-1], e[::-1]


class Twisted:
    """Twisted factorisation of B'B - value: pivots before the twist come from
    the stationary qd transform, those after it from the progressive one."""

    def __init__(self, diag: np.ndarray, upper: np.ndarray, value: float):
        n = len(diag)
        small = EPS * EPS * max(value, 1e-300)
        safe = lambda x: x if abs(x) > small else (small if x >= 0 else -small)
        self.n, self.down, self.up = n, np.zeros(n), np.zeros(n)      # factors towards the twist
        self.forward, self.backward = np.zeros(n), np.zeros(n)
        s = -value
        stationary = [s]
        for k in range(n - 1):
            pivot = safe(s + diag[k] ** 2)
            self.forward[k] = pivot
            self.down[k] = diag[k] * upper[k] / pivot
            s = upper[k] ** 2 * (s / pivot) - value
            stationary.append(s)
        self.forward[n - 1] = s + diag[n - 1] ** 2
        p = diag[n - 1] ** 2 - value
        progressive = [p]
        for k in range(n - 2, -1, -1):
            pivot = safe(upper[k] ** 2 + p)
            self.backward[k + 1] = pivot
            self.up[k] = diag[k] * upper[k] / pivot
            p = p * (diag[k] ** 2 / pivot) - value
            progressive.append(p)
        self.gamma = np.array(stationary) + np.array(progressive[::-1]) + value

    def vector(self, twist: int) -> np.ndarray:
        z = np.zeros(self.n)
        z[twist] = 1.0
        for k in range(twist - 1, -1, -1):
            z[k] = -self.down[k] * z[k + 1]
        for k in range(twist, self.n - 1):
            z[k + 1] = -self.up[k] * z[k]
        return z / np.linalg.norm(z)

    def solve(self, b: np.ndarray) -> np.ndarray:
        """x with (B'B - value) x = b."""
        r = int(np.abs(self.gamma).argmin())
        y = b.astype(float).copy()
        for k in range(r):
            y[k + 1] -= self.down[k] * y[k]
        for k in range(self.n - 1, r, -1):
            y[k - 1] -= self.up[k - 1] * y[k]
        y[:r] /= self.forward[:r]
        y[r + 1:] /= self.backward[r + 1:]
        y[r] /= self.gamma[r] if self.gamma[r] else EPS * np.abs(self.gamma).max() or 1.0
        for k in range(r - 1, -1, -1):
            y[k] -= self.down[k] * y[k + 1]
        for k in range(r, self.n - 1):
            y[k + 1] -= self.up[k] * y[k]
        return y


def _blocks(diag: np.ndarray, upper: np.ndarray) -> list[tuple[int, int]]:
    """Ranges between negligible entries of the superdiagonal."""
    size = np.abs(diag).max()
    cut = np.flatnonzero(np.abs(upper) <= EPS * np.maximum(np.minimum(np.abs(diag[:-1]), np.abs(diag[1:])), EPS * size)) + 1
    return list(zip([0, *cut.tolist()], [*cut.tolist(), len(diag)]))


def leading(diag: np.ndarray, upper: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest squared singular values, ``most`` at most and none that is
    zero to working accuracy, and their right singular vectors (columns).
    Blocks that nothing connects are solved apart: their vectors are
    orthogonal however close the values."""
    parts = [(a, b, singular_squares(diag[a:b], upper[a: b - 1])) for a, b in _blocks(diag, upper)]
    every = sorted(((v, a, b) for a, b, values in parts for v in values.tolist()), key=lambda x: -x[0])
    floor = every[0][0] * (8 * len(diag) * EPS) ** 2
    chosen = [x for x in every if x[0] > floor][:most]
    out = np.zeros((len(diag), len(chosen)))
    for a, b, _ in parts:
        at = [k for k, x in enumerate(chosen) if x[1] == a]
        if at:
            out[a:b, at] = _vectors(diag[a:b], upper[a: b - 1], np.array([chosen[k][0] for k in at]))
    return np.array([x[0] for x in chosen]), out


def _vectors(diag: np.ndarray, upper: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Right singular vectors (columns) for squared singular ``values``, which
    come largest first."""
    top = max(np.abs(diag).max(), np.abs(upper).max(initial=0))
    diag, upper, values = diag / top, upper / top, values / top ** 2
    out = np.zeros((len(diag), len(values)))
    for j, value in enumerate(values):
        factors = Twisted(diag, upper, value)
        z = factors.vector(int(np.abs(factors.gamma).argmin()))
        near = [i for i in range(j) if values[i] - value <= CLOSE * values[i]]
        if near:
            basis = out[:, near]
            rng = np.random.default_rng(j)
            for turn in range(8):
                rest = z - basis @ (basis.T @ z)
                rest -= basis @ (basis.T @ rest)
                size = np.linalg.norm(rest)
                if turn >= 2 and size > 0.5:
                    z = rest / size
                    break
                if size < 1e-8:
                    rest = rng.standard_normal(len(diag))
                    rest -= basis @ (basis.T @ rest)
                    size = np.linalg.norm(rest)
                z = factors.solve(rest / size)
                z /= np.linalg.norm(z)
            else:
                rest = z - basis @ (basis.T @ z)
                z = rest / np.linalg.norm(rest)
        out[:, j] = z
    return out


def directions(r: np.ndarray, n: int, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(variances, unit vectors as columns, trace) of V = R'R / n: at most
    ``most`` of them, those whose variance is not zero to working accuracy."""
    diag, upper, right = bidiagonal(r)
    if not len(diag) or max(np.abs(diag).max(), np.abs(upper).max(initial=0)) == 0:
        return np.zeros(0), np.zeros((len(diag), 0)), 0.0
    squares, vectors = leading(diag, upper, most)
    vectors = right @ vectors
    return squares / n, vectors / np.linalg.norm(vectors, axis=0), float((r * r).sum() / n)


# ---------------------------------------------------------------- Spark steps
def _integers(vec_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, x = whole_numbers(b.column(vec_col), SCALE)
            if len(x):
                yield pa.record_batch([long_list(x)], names=["x"])

    return run


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for b in batches:
        if b.num_rows:
            x = b.column("x")
            one_length(x.value_lengths().to_numpy(zero_copy_only=False))
            yield x.flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, total = 0, None
    for x in _matrices(batches):
        n += len(x)
        wide = float(np.abs(x).max(initial=0)) * len(x) >= 2.0 ** 62
        s = [int(v) for v in (x.astype(object) if wide else x).sum(0)]
        total = s if total is None else [a + b for a, b in zip(total, s)]
    if n:
        yield pa.record_batch([pa.array(np.arange(len(total), dtype=np.int32)), pa.array([n] * len(total), pa.int64()),
                               pa.array([Decimal(v) for v in total], pa.decimal128(38, 0))], names=["at", "n", "s"])


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exactly: as longs where they fit, else as Python integers."""
    if n * max(float(np.abs(x).max(initial=0)), 1.0) + max(map(abs, sums), default=0) < 2.0 ** 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _reduced(stack: list[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.concatenate(stack), mode="r")


def _factor(r: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array([r.shape[1]], pa.int32()), pa.array([r.reshape(-1).tolist()], pa.list_(pa.float64()))], names=["d", "r"])


def _block_qr(n: int, sums: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for x in _matrices(batches):
            c = _centred(x, n, sums).astype(float) / n
            r = _reduced([c] if r is None else [r, c])
        if r is not None:
            yield _factor(r)

    return run


def _merge_qr(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    r = None
    for b in batches:
        for d, flat in zip(b.column("d").to_pylist(), b.column("r")):
            block = flat.values.to_numpy(zero_copy_only=False).reshape(-1, d)
            r = _reduced([block] if r is None else [r, block])
    if r is not None:
        yield _factor(r)


def _moments(n: int, sums: list[int], project: np.ndarray):
    """Sums of the whitened rows and of their products, one row a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = project.shape[1]
        first, second = np.zeros(k), np.zeros((k, k))
        for x in _matrices(batches):
            w = (_centred(x, n, sums).astype(float) / n) @ project
            first += w.sum(0)
            second += w.T @ w
        yield pa.record_batch([pa.array([[*first.tolist(), *second.reshape(-1).tolist()]], pa.list_(pa.float64()))], names=["m"])

    return run


class Whitening:
    """What ``fit`` found: n, the sums of x, variances, directions (columns),
    the trace of the covariance and the largest deviation of the whitened fit
    list's covariance from the identity."""

    def __init__(self, n: int, sums: list[int], variances: np.ndarray, vectors: np.ndarray, trace: float):
        self.n, self.sums, self.variances, self.vectors, self.trace = n, sums, variances, vectors, trace
        self.project = vectors / np.sqrt(variances)
        self.identity_error = 0.0


def fit(df: DataFrame, vec_col: str = "embedding", components: int = 4) -> Whitening | None:
    """Fit on the distinct x vectors of ``df``; None if it has no
    usable row with components.
    Only the sums, one triangular factor and the moments of the whitened
    components reach the driver; their sizes are the dimension's."""
    ints = df.select(F.col(vec_col).alias("v")).mapInArrow(tidy(_integers("v")), "x array<long>")
    # equal vectors become one before they are shuffled
    listed = written(ints.distinct(), "whitening-fit")
    got = listed.mapInArrow(_sums, "at int, n long, s decimal(38,0)").groupBy("at").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
    if not got:
        return None
    if len({r["n"] for r in got}) > 1:
        raise ValueError("vectors of different numbers of components in one table")
    n, sums = int(got[0]["n"]), [int(r["s"]) for r in sorted(got, key=lambda r: r["at"])]
    factors = written(listed.mapInArrow(tidy(_block_qr(n, sums)), FACTOR), "whitening-factors")
    while (count := factors.count()) > STACK:
        # fewer tasks take the factors of the many; a factor's size is the dimension's
        factors = written(factors.repartition(-(-count // STACK)).mapInArrow(_merge_qr, FACTOR), "whitening-factors")
    d = len(sums)
    r = _reduced([np.array(x["r"]).reshape(-1, d) for x in factors.collect()] + [np.zeros((d, d))])
    variances, vectors, trace = directions(r, n, components)
    found = Whitening(n, sums, variances, vectors, trace)
    k = len(variances)
    if k:
        m = listed.mapInArrow(_moments(n, sums, found.project), "m array<double>").select(F.posexplode("m").alias("at", "v"))
        m = np.array([x["v"] for x in sorted(m.groupBy("at").agg(F.sum("v").alias("v")).collect(), key=lambda x: x["at"])]) / n
        found.identity_error = float(np.abs(m[k:].reshape(k, k) - np.outer(m[:k], m[:k]) - np.eye(k)).max())
    return found


def whiten(df: DataFrame, found: Whitening, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per usable row of ``df`` and component: the id, component,
    n, deviation, whitened, explained, identity_error."""
    n, sums, project, k = found.n, found.sums, found.project, len(found.variances)
    explained = [float(e / found.trace) for e in found.variances]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, x = whole_numbers(b.column("v"), SCALE)
            if not len(rows) or not k:
                continue
            diff = _centred(x, n, sums)
            w = (diff.astype(float) / n) @ project
            each = np.repeat(np.arange(len(rows)), k)
            yield pa.record_batch(
                [b.column("i").take(pa.array(rows[each])), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                 pa.array(np.full(len(each), n)), pa.array(exact_squares(diff), pa.int64()).take(pa.array(each)),
                 pa.array(w.reshape(-1)), pa.array(np.tile(explained, len(rows))), pa.array(np.full(len(each), found.identity_error))],
                names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("i"), F.col(vec_col).alias("v")).mapInArrow(
        tidy(run), f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")


def whitened_embeddings(spark: SparkSession, embeddings: DataFrame) -> DataFrame:
    found = fit(embeddings)
    if found is None:
        found = Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 0.0)
    return whiten(embeddings, found)
