from fractions import Fraction

import numpy as np
import pytest

from chronopanel.llm import whitening as W
from chronopanel.llm.queries import op12_whitening

from .helpers import save

SCHEMA = "vec_id long, embedding array<float>, label int, n long, x string, component int, v double"


def embeddings(spark, rows):
    return spark.createDataFrame([(i, v, 1, 7, "x", 2, 0.5) for i, v in rows], SCHEMA)


def check_algebra(r, most=None, tol=1e-12):
    d = r.shape[1]
    diag, upper, right = W.bidiagonal(r)
    assert np.abs(right.T @ right - np.eye(d)).max() < 1e-13
    s = np.linalg.svd(r, compute_uv=False)
    top = s[0] or 1
    assert np.abs(np.sqrt(W.singular_squares(diag, upper)) - s).max() < tol * top
    e, v, trace = W.directions(r, 7, most or d)
    assert abs(trace - (s ** 2).sum() / 7) <= 1e-12 * top ** 2
    assert len(e) == min(most or d, int((s > 1e-13 * top * d).sum()))
    cov = r.T @ r / 7
    assert np.abs(cov @ v - v * e).max(initial=0) < 1e-12 * top ** 2
    assert np.abs(v.T @ v - np.eye(len(e))).max(initial=0) < 1e-11
    return e, v


@pytest.mark.parametrize("d", [1, 2, 3, 5, 16, 64])
def test_random_and_graded_matrices(d):
    rng = np.random.default_rng(d)
    for scale in (np.ones(d), 10.0 ** np.linspace(3, -3, d), 10.0 ** np.linspace(-3, 3, d)):
        check_algebra(np.linalg.qr(rng.standard_normal((300, d)) * scale, mode="r"))


def test_equal_close_and_zero_values():
    q = np.linalg.qr(np.random.default_rng(0).standard_normal((20, 20)))[0]
    tri = lambda s: np.linalg.qr(q @ np.diag(s) @ q.T, mode="r")
    check_algebra(np.eye(6))
    check_algebra(np.diag([3.0, 3, 3, 1, 1, 0]))
    check_algebra(tri([5.0] * 5 + [2] * 5 + [1] * 10))
    check_algebra(tri([5.0] * 5 + [0] * 15))
    check_algebra(tri(5 - 1e-9 * np.arange(20)))
    check_algebra(np.diag(np.ones(21)) + np.diag(np.ones(20), 1), most=4)
    e, v, trace = W.directions(np.zeros((4, 4)), 3, 4)
    assert len(e) == 0 and v.shape == (4, 0) and trace == 0
    for seed in range(120):
        g = np.random.default_rng(seed)
        d = int(g.integers(1, 25))
        check_algebra(np.triu(g.integers(-2, 3, (d, d)).astype(float)), tol=1e-11)


def test_small_values_keep_relative_accuracy():
    """dqds on a graded bidiagonal matrix: tr(inverse) and determinant, in
    exact arithmetic, fix the smallest of two values."""
    diag, upper = np.array([1.0, 1e-9]), np.array([1.0])
    big, small = W.singular_squares(diag, upper)
    det = float(Fraction(1) * Fraction(1e-9) ** 2)
    assert abs(small / (det / big) - 1) < 1e-14


def brute(rows):
    kept = [(i, np.array(v, float)) for i, v in rows if v is not None and None not in v and np.isfinite(np.array(v, float)).all()]
    x = [(i, [int(c) for c in np.floor(256 * v)]) for i, v in kept]
    listed = sorted({tuple(v) for _, v in x})
    n, sums = len(listed), [sum(c) for c in zip(*listed)]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(v, sums)] for v in listed])
    e, vec = np.linalg.eigh(centred.T @ centred / n)
    return x, n, sums, e[::-1], vec[:, ::-1]


def check(out, rows, k):
    x, n, sums, e, vec = brute(rows)
    assert len(out) == k * len(x)
    got = {c: [r for r in out if r["component"] == c] for c in range(1, k + 1)}
    assert sorted({r["component"] for r in out}) == list(range(1, k + 1))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    for c in range(k):
        want = sorted(((i, sum((n * a - s) ** 2 for a, s in zip(v, sums)),
                        float((np.array([float(Fraction(n * a - s, n)) for a, s in zip(v, sums)]) @ vec[:, c]) / np.sqrt(e[c]))) for i, v in x), key=key)
        have = sorted(((r["vec_id"], r["deviation"], r["whitened"]) for r in got[c + 1]), key=key)
        assert [w[:2] for w in want] == [h[:2] for h in have]
        a, b = np.array([w[2] for w in want]), np.array([h[2] for h in have])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-9
        assert {r["n"] for r in got[c + 1]} == {n}
        assert abs(got[c + 1][0]["explained"] / (e[c] / e.sum()) - 1) < 1e-10
    assert len({r["identity_error"] for r in out}) == 1 and out[0]["identity_error"] < 1e-10


def table(n=400, d=12):
    rng = np.random.default_rng(3)
    v = rng.standard_normal((n, d)) * np.linspace(3, 0.3, d)
    return [(i, [float(np.float32(c)) for c in r]) for i, r in enumerate(v)]


def test_whitening_against_brute_force(spark, tmp_path):
    rows = table()
    rows += [(5, rows[5][1]), (5, rows[9][1]), (None, rows[2][1]), (900, None), (901, [1.0, None] + [0.0] * 10),
             (902, [float("nan")] * 12), (903, [float("inf")] + [0.0] * 11), (904, None)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]   # a third of the rows share a vector
    out = op12_whitening(spark, save(embeddings(spark, rows).repartition(7), tmp_path, "embeddings"))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(out.collect(), rows, 4)


def test_factors_are_merged_in_several_turns(spark, monkeypatch):
    monkeypatch.setattr(W, "STACK", 2)
    rows = table(60, 5)
    df = embeddings(spark, rows).repartition(9)
    check(W.whiten(df, W.fit(df)).collect(), rows, 4)


def test_few_vectors_and_constant_tables(spark):
    run = lambda rows: W.whitened_embeddings(spark, embeddings(spark, rows)).collect()
    assert run([]) == [] and run([(1, None)]) == [] and run([(1, [])]) == []
    assert run([(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []      # no variance, so nothing to whiten
    three = [(1, [0.0, 1.0, 5.0]), (2, [1.0, 0.0, 5.0]), (3, [1.0, 1.5, 5.0])]
    check(run(three), three, 2)
    square = [(i, [float(a), float(b), 0.0]) for i, (a, b) in enumerate([(1, 1), (1, -1), (-1, 1), (-1, -1)])]
    out = run(square)                                           # equal variances: some orthonormal basis
    w = np.array([[r["whitened"] for r in out if r["component"] == c] for c in (1, 2)])
    assert len(out) == 8 and np.abs(w @ w.T / 4 - np.eye(2)).max() < 1e-12
    with pytest.raises(Exception, match="different numbers of components"):
        run([(1, [1.0]), (2, [1.0, 2.0])])


def test_deviation_beyond_a_long_is_null_and_else_exact(spark):
    rows = [(1, [2.0 ** 40, 0.0]), (2, [-(2.0 ** 40), 1.0]), (3, [0.0, 3.0])]
    out = W.whitened_embeddings(spark, embeddings(spark, rows)).collect()
    assert [r["deviation"] for r in out if r["vec_id"] == 1 and r["component"] == 1] == [None]
    rows = [(1, [2.0 ** 20, 0.0]), (2, [-(2.0 ** 20), 1.0]), (3, [0.0, 3.0])]
    check(W.whitened_embeddings(spark, embeddings(spark, rows)).collect(), rows, 2)
