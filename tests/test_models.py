"""Model operators against brute-force references on small fixtures."""

import itertools
import math

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from chronopanel.operators import explain as X
from chronopanel.operators import forecast as FC
from chronopanel.operators import models as M


def _tiny(spark, n=40, seed=3):
    rng = np.random.default_rng(seed)
    a, b, c = rng.normal(size=n), rng.normal(size=n), rng.normal(size=n)
    y = 2 * a - b + 0.5 * a * c + rng.normal(scale=0.1, size=n)
    pdf = pd.DataFrame({"id": range(n), "a": a, "b": b, "c": c, "y": y})
    return spark.createDataFrame(pdf), pdf


def test_ols_matches_numpy(spark):
    df, pdf = _tiny(spark)
    out = {r.name: r for r in M.ols(df, "y", ["a", "b", "c"]).collect()}
    X_ = np.column_stack([pdf[["a", "b", "c"]].to_numpy(), np.ones(len(pdf))])
    beta, *_ = np.linalg.lstsq(X_, pdf["y"].to_numpy(), rcond=None)
    resid = pdf["y"].to_numpy() - X_ @ beta
    s2 = resid @ resid / (len(pdf) - 4)
    se = np.sqrt(np.diag(s2 * np.linalg.inv(X_.T @ X_)))
    for i, n in enumerate(["a", "b", "c", "const"]):
        assert math.isclose(out[n].coef, beta[i], rel_tol=1e-9, abs_tol=1e-12)
        assert math.isclose(out[n].std_err, se[i], rel_tol=1e-7)


def test_tree_shap_exact_on_tiny_tree(spark):
    df, pdf = _tiny(spark, n=20)
    va = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features")
    m = DecisionTreeRegressor(labelCol="y", maxDepth=2).fit(va.transform(df))
    tree = X.export_trees(m)[0]
    for r in range(5):
        x = pdf[["a", "b", "c"]].to_numpy()[r]
        phi = X.shap_values(tree, x[None, :])[0]
        exact = np.zeros(3)
        for i in range(3):
            others = [j for j in range(3) if j != i]
            for k in range(3):
                for S in itertools.combinations(others, k):
                    w = math.factorial(k) * math.factorial(3 - k - 1) / math.factorial(3)
                    exact[i] += w * (X.conditional_expectation(tree, x, set(S) | {i}) -
                                     X.conditional_expectation(tree, x, set(S)))
        assert np.allclose(phi, exact, atol=1e-10)
        full = X.conditional_expectation(tree, x, {0, 1, 2})
        assert math.isclose(X.expected_value(tree) + phi.sum(), full, abs_tol=1e-9)


def test_tree_shap_additivity_forest(spark):
    df, _ = _tiny(spark, n=60)
    va = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features")
    d = va.transform(df)
    m = RandomForestRegressor(labelCol="y", numTrees=5, maxDepth=3, seed=1).fit(d)
    long = X.tree_shap(m, m.transform(d), ["id"])
    g = long.groupBy("id").agg(F.sum("shap_value").alias("s"), F.first("pred").alias("p"),
                               F.first("base_value").alias("b")).collect()
    assert len(g) == 60
    for r in g:
        assert abs(r.b + r.s - r.p) < 1e-9
    assert long.count() == 60 * 3


def test_tree_shap_explains_one_hot_slots(spark):
    from chronopanel.operators import models as M
    df, _ = _tiny(spark, n=80)
    df = df.withColumn("g", F.when(F.col("id") % 3 == 0, "u").when(F.col("id") % 3 == 1, "v").otherwise("w"))
    df = df.withColumn("y", F.col("y") + F.when(F.col("g") == "v", 3.0).otherwise(0.0))
    model = M.refit(df, "y", M.feature_pipeline(cat=["g"], num=["a", "b", "c"]),
                    RandomForestRegressor(labelCol="y", numTrees=6, maxDepth=4, seed=2))
    scored = model.transform(df)
    long = X.tree_shap(model.stages[-1], scored, ["id"])
    names = [r.name for r in M.feature_map(scored).orderBy("index").collect()]
    assert {r.feature for r in long.select("feature").distinct().collect()} == set(names)
    g = long.groupBy("id").agg(F.sum("shap_value").alias("s"), F.first("pred").alias("p"), F.first("base_value").alias("b")).collect()
    assert len(g) == 80 and all(abs(r.b + r.s - r.p) < 1e-9 for r in g)
    assert long.where("feature rlike '_v$'").agg(F.avg("abs_shap")).first()[0] > 0.1


def _bvar_direct(y, p, h, l1, l2, l3):
    T, k = y.shape
    Y = y[p:]
    Xl = np.column_stack([np.ones(T - p)] + [y[p - lag:T - lag] for lag in range(1, p + 1)])
    sig = np.zeros(k)
    for i in range(k):
        Z = np.column_stack([np.ones(T - 1), y[:-1, i]])
        b = np.linalg.lstsq(Z, y[1:, i], rcond=None)[0]
        sig[i] = np.std(y[1:, i] - Z @ b, ddof=2)
    m = Xl.shape[1]
    B = np.zeros((m, k))
    for i in range(k):
        prec = np.zeros(m)
        prec[0] = 0.01
        for lag in range(1, p + 1):
            for j in range(k):
                v = l1 ** 2 / lag ** (2 * l3) * sig[i] ** 2 / sig[j] ** 2 * (1 if i == j else l2 ** 2)
                prec[1 + (lag - 1) * k + j] = 1 / max(v, 1e-12)
        b0 = np.zeros(m)
        b0[1 + i] = 1.0
        B[:, i] = np.linalg.solve(Xl.T @ Xl + np.diag(prec), Xl.T @ Y[:, i] + np.diag(prec) @ b0)
    hist = list(y)
    out = []
    for _ in range(h):
        x = np.concatenate([[1.0]] + [hist[-lag] for lag in range(1, p + 1)])
        out.append(x @ B)
        hist.append(out[-1])
    return np.array(out)


def test_bvar_matches_direct(spark):
    rng = np.random.default_rng(0)
    rows = []
    ref = {}
    for g in ("g1", "g2"):
        y = np.cumsum(rng.normal(size=(50, 2)), axis=0) * 0.1 + rng.normal(size=(50, 2))
        ref[g] = _bvar_direct(y, 2, 6, 0.18, 0.5, 1.0)
        for t in range(50):
            rows.append((g, pd.Timestamp(2000 + t // 12, t % 12 + 1, 1).date(), float(y[t, 0]), float(y[t, 1])))
    df = spark.createDataFrame(rows, "g string, period date, u double, v double")
    out = FC.bvar_forecast(df, "g", "period", ["u", "v"], p=2, horizon=6).toPandas()
    for g in ref:
        got = out[out.g == g].sort_values("step")[["u", "v"]].to_numpy()
        assert np.allclose(got, ref[g], atol=1e-9)


def test_lasso_cv_matches_direct(spark):
    rng = np.random.default_rng(5)
    n, k = 120, 6
    Xm = rng.normal(size=(n, k))
    y = Xm[:, 0] * 1.5 - Xm[:, 2] + rng.normal(scale=0.3, size=n)
    pdf = pd.DataFrame(Xm, columns=[f"x{i}" for i in range(k)])
    pdf["y"], pdf["t"] = y, range(n)
    out = M.lasso_select(spark.createDataFrame(pdf), "y", [f"x{i}" for i in range(k)], order=["t"], scale="all",
                         n_splits=5, n_alphas=50).toPandas()
    # direct: same standardisation, same folds, same coordinate descent on raw matrices
    Z = (Xm - Xm.mean(0)) / Xm.std(0)
    t = n // 6
    blocks = {b: np.arange(0, n - 5 * t) if b == 0 else np.arange(n - (6 - b) * t, n - (5 - b) * t) for b in range(6)}
    stats = {b: dict(n=len(ix), sy=y[ix].sum(), syy=y[ix] @ y[ix], sx=Z[ix].sum(0), sxy=Z[ix].T @ y[ix],
                     G=Z[ix].T @ Z[ix]) for b, ix in blocks.items()}
    _, _, best, b, _ = M.lasso_path_cv(stats, 5, 50)
    assert math.isclose(out["alpha"].iloc[0], best, rel_tol=1e-9)
    assert np.allclose(out["coef"].to_numpy(), b, atol=1e-9)
    assert set(out[out.selected].feature) >= {"x0", "x2"}


def test_seasonal_forecast_integrates_back():
    y = np.array([10.0 + 2 * t + (3 if t % 12 == 0 else 0) for t in range(60)])
    fit = FC.css_fit(y, (0, 1, 0), (0, 1, 0, 12))
    fc = FC.css_forecast(y, fit, (0, 1, 0), (0, 1, 0, 12), 12)
    expect = np.array([10.0 + 2 * t + (3 if t % 12 == 0 else 0) for t in range(60, 72)])
    assert np.allclose(fc, expect, atol=1e-6)


def test_seasonal_grid_keeps_failures(spark):
    rows = [("long", pd.Timestamp(2000 + t // 12, t % 12 + 1, 1).date(), float(100 + t + (t % 12))) for t in range(60)]
    rows += [("short", pd.Timestamp(2000, t + 1, 1).date(), float(t)) for t in range(10)]
    df = spark.createDataFrame(rows, "s string, period date, v double")
    res, fc = FC.seasonal_grid(df, "s", "period", "v", horizon=6)
    r = res.toPandas()
    assert (r[r.s == "short"].status.str.startswith("failed")).all()
    assert (r[r.s == "long"].status == "ok").any()
    assert fc.filter("s = 'long'").count() == 6


def test_lasso_scale_in_fold_runs_and_differs_only_in_scaling(spark):
    rng = np.random.default_rng(2)
    n = 90
    Xm = rng.normal(size=(n, 3)) * np.array([1.0, 5.0, 0.2]) + np.linspace(0, 3, n)[:, None]
    y = Xm[:, 0] - 0.3 * Xm[:, 1] + rng.normal(scale=0.2, size=n)
    pdf = pd.DataFrame(Xm, columns=["a", "b", "c"])
    pdf["y"], pdf["t"] = y, range(n)
    df = spark.createDataFrame(pdf)
    a = M.lasso_select(df, "y", ["a", "b", "c"], order=["t"], n_alphas=30, scale="all").toPandas()
    f = M.lasso_select(df, "y", ["a", "b", "c"], order=["t"], n_alphas=30, scale="fold").toPandas()
    assert set(a[a.selected].feature) >= {"a", "b"} and set(f[f.selected].feature) >= {"a", "b"}
    assert np.all(np.isfinite(f["cv_rmse_mean"]))


def test_feature_map_from_metadata(spark):
    from pyspark.ml import Pipeline
    df = spark.createDataFrame([("a", 1.0, 2.0), ("b", 3.0, 4.0), ("a", 5.0, 6.0)], "g string, x double, y double")
    m = Pipeline(stages=M.feature_pipeline(cat=["g"], num=["x"])).fit(df)
    fm = M.feature_map(m.transform(df)).toPandas()
    assert list(fm["index"]) == list(range(len(fm)))
    assert fm["name"].iloc[-1] == "x" and any(n.startswith("g_oh_") for n in fm["name"])


def _monthly(t0, n):
    return [pd.Timestamp(2000 + (t0 + t) // 12, (t0 + t) % 12 + 1, 1).date() for t in range(n)]


def test_derivatives_of_the_seasonal_regression():
    rng = np.random.default_rng(0)
    x = np.cumsum(rng.standard_normal((70, 2)), 0)
    y = np.cumsum(rng.standard_normal(70)) + x @ [1.5, -2.0]
    for (p, d, q), (P, D, Q, s) in FC.DEFAULT_ORDERS + [((2, 1, 2), (1, 1, 1, 4)), ((1, 0, 2), (0, 0, 2, 4))]:
        m = FC._SeasonalArma(FC._difference(y, d, D, s), FC._difference(x, d, D, s), (p, d, q), (P, D, Q, s), 0)
        par = np.r_[0.1, 1.0, -1.0, rng.uniform(-0.4, 0.4, p + P + q + Q)]
        numeric = np.stack([(m.residuals(par + h) - m.residuals(par - h)) / 2e-6 for h in 1e-6 * np.eye(len(par))], 1)
        assert np.allclose(m.derivatives(par, m.residuals(par)), numeric, atol=1e-6)


def _driven(seed=4, n=240, beta=(2.5, -0.7), phi=0.6, theta12=0.4):
    """Levels whose regression errors are an integrated seasonal ARMA."""
    rng = np.random.default_rng(seed)
    x = np.cumsum(rng.standard_normal((n, len(beta))) * 3, 0)
    e, z = rng.standard_normal(n + 13) * 0.5, np.zeros(n + 13)
    for t in range(12, n + 13):
        z[t] = phi * z[t - 1] + e[t] + theta12 * e[t - 12]
    u = np.zeros(n + 13)
    for t in range(13, n + 13):
        u[t] = u[t - 1] + u[t - 12] - u[t - 13] + z[t]
    return x, x @ np.array(beta) + u[13:]


def test_known_regression_coefficients_are_recovered():
    x, y = _driven()
    fit = FC.css_fit(y, (1, 1, 0), (0, 1, 1, 12), exog=x)
    assert np.allclose(fit["beta"], [2.5, -0.7], atol=0.05)
    assert abs(fit["phi"][0] - 0.6) < 0.12 and abs(fit["theta"][11] - 0.4) < 0.15
    # no regressor that helps: a worse BIC without it
    assert FC.css_fit(y, (1, 1, 0), (0, 1, 1, 12))["bic"] > fit["bic"] + 100


def test_regression_without_arma_terms_is_least_squares():
    x, y = _driven(n=60)
    fit = FC.css_fit(y, (0, 1, 0), (0, 1, 0, 12), exog=x)
    z, d = FC._difference(y, 1, 1, 12), FC._difference(x, 1, 1, 12)
    want = np.linalg.lstsq(np.c_[np.ones(len(z)), d], z, rcond=None)[0]
    assert np.allclose([fit["c"], *fit["beta"]], want, atol=1e-9)


def test_chain_uses_the_drivers_forecast_and_stops_at_its_gaps(spark):
    x, y = _driven(n=96)
    rows = [("a", p, float(a), float(b)) for p, a, b in zip(_monthly(0, 96), x[:, 0], y)]
    rows += [("b", p, None if i == 3 else float(a), float(b)) for i, (p, a, b) in enumerate(zip(_monthly(0, 96), x[:, 1], y))]
    df = spark.createDataFrame(rows, "s string, period date, x double, y double")
    walk = [((0, 1, 0), (0, 1, 0, 12))]
    grid, fc = FC.driver_chain(df, "s", "period", "x", "y", orders=walk, horizon=6)
    a = fc.filter("s = 'a'").orderBy("period").toPandas()
    assert list(a["period"]) == _monthly(96, 6)
    fx = FC.css_forecast(x[:, 0], FC.css_fit(x[:, 0], *walk[0]), *walk[0], 6)
    fit = FC.css_fit(y, *walk[0], exog=x[:, :1])
    assert np.allclose(a["x_forecast"], fx) and np.allclose(a["y_forecast"], FC.css_forecast(y, fit, *walk[0], 6, x[:, :1], fx))
    assert np.allclose(grid.filter("s = 'a'").first()["beta"], fit["beta"])
    assert fc.filter("s = 'b'").count() == 6
    # a future with a gap in its third month, and a series without any future
    ahead = spark.createDataFrame([("a", p, 1.0) for i, p in enumerate(_monthly(96, 6)) if i != 2], "s string, period date, x double")
    _, cut = FC.seasonal_grid(df, "s", "period", "y", walk, 6, exog=["x"], exog_future=ahead)
    assert [r["period"] for r in cut.filter("s = 'a'").orderBy("period").collect()] == _monthly(96, 2)
    assert cut.filter("s = 'b'").count() == 0


def _direct_lasso(X, y, alphas):
    """Coordinate descent on centred rows, warm along the path."""
    Xc, yc, b, out = X - X.mean(0), y - y.mean(), np.zeros(X.shape[1]), []
    for a in alphas:
        for _ in range(2000):
            was = b.copy()
            for j in range(len(b)):
                r = yc - Xc @ b + Xc[:, j] * b[j]
                c = Xc[:, j] @ r / len(y)
                b[j] = np.sign(c) * max(abs(c) - a, 0) / max(Xc[:, j] @ Xc[:, j] / len(y), 1e-300)
            if np.abs(b - was).max() < 1e-12:
                break
        out.append(b.copy())
    return out


def _direct_cv(X, y, splits, n_alphas, eps=1e-3):
    amax = np.abs((X - X.mean(0)).T @ (y - y.mean())).max() / len(y)
    alphas = np.logspace(np.log10(amax), np.log10(amax * eps), n_alphas)
    mse = np.zeros((len(splits), n_alphas))
    for f, (a, b) in enumerate(splits):
        for i, w in enumerate(_direct_lasso(X[:a], y[:a], alphas)):
            e = y[a:b] - y[:a].mean() - (X[a:b] - X[:a].mean(0)) @ w
            mse[f, i] = (e ** 2).mean()
    best = int(mse.mean(0).argmin())
    return _direct_lasso(X, y, alphas[: best + 1])[-1]


def test_nested_error_equals_a_direct_fit_on_rows(spark):
    """Five outer folds of three inner ones; borders lie inside periods, and
    rows tie in the order columns."""
    rng = np.random.default_rng(8)
    n, k = 131, 4
    X = rng.standard_normal((n, k)) * [1, 4, 0.3, 2] + np.linspace(0, 2, n)[:, None]
    y = X @ [1.0, -0.5, 0.0, 0.2] + rng.standard_normal(n) * 0.5
    period, entity = np.arange(n) // 17, rng.permutation(n) % 6
    pdf = pd.DataFrame(X, columns=[f"x{i}" for i in range(k)]).assign(y=y, period=period, entity=entity)
    df = spark.createDataFrame(pdf.sample(frac=1, random_state=1)).repartition(5)
    out = M.lasso_select(df, "y", [f"x{i}" for i in range(k)], order=["period", "entity"], scale="all", n_alphas=40).toPandas()
    # the blocks' order standardises by all rows before ties are broken, which keeps the order
    s = pdf.sort_values(["period", "entity", "y", "x0", "x1", "x2", "x3"])
    X, y = s[[f"x{i}" for i in range(k)]].to_numpy(), s["y"].to_numpy()
    errors = []
    for end, stop in M.fold_borders(n, 5):
        mean, sd = X[:end].mean(0), X[:end].std(0)
        Z = (X[:stop] - mean) / sd
        w = _direct_cv(Z[:end], y[:end], M.fold_borders(end, 3), 40)
        e = y[end:stop] - y[:end].mean() - Z[end:stop] @ w
        errors.append(np.sqrt((e ** 2).mean()))
    assert abs(out["nested_rmse_mean"][0] - np.mean(errors)) < 2e-3
    assert abs(out["nested_rmse_std"][0] - np.std(errors)) < 2e-3
    assert out["nested_rmse_mean"][0] > out["cv_rmse_mean"][0] - 1e-9 or out["nested_rmse_mean"][0] < out["cv_rmse_mean"][0] * 1.2


def test_prefix_sums_at_any_position(spark):
    """Hot periods, missing keys and many equal rows: the rows before each
    position, without numbering the rows."""
    rng = np.random.default_rng(3)
    rows = [("p1", "hot", 1.0, 2.0)] * 60 + [(None, None, 5.0, 1.0)] * 4
    rows += [(f"p{rng.integers(3)}", f"e{rng.integers(5)}" if rng.random() > 0.1 else None, float(rng.integers(4)), float(rng.integers(3))) for _ in range(90)]
    df = spark.createDataFrame(rows, "period string, entity string, y double, x double").repartition(7)
    positions = [0, 1, 3, 5, 40, 77, 78, 100, len(rows) - 1, len(rows)]
    got = M.prefix_grams(df, "y", ["x"], ["period", "entity"], positions)
    rows.sort(key=lambda r: [(v is not None, v if v is not None else "") for v in r[:2]] + [r[2], r[3]])
    for p in positions:
        part = np.array([[r[2], r[3]] for r in rows[:p]]).reshape(-1, 2)
        s = got[p]
        assert (s["n"], s["sy"], s["syy"]) == (p, part[:, 0].sum(), (part[:, 0] ** 2).sum())
        assert (s["sx"][0], s["sxy"][0], s["G"][0, 0]) == (part[:, 1].sum(), (part[:, 0] * part[:, 1]).sum(), (part[:, 1] ** 2).sum())


def _spark_trees(spark, est, pdf, cols):
    from pyspark.ml.feature import VectorAssembler
    d = VectorAssembler(inputCols=cols, outputCol="features").transform(spark.createDataFrame(pdf))
    model = est.fit(d)
    return model, d, X.export_trees(model, spark)


def test_deep_forest_attributions_against_brute_force(spark):
    """100 trees of depth 12: features repeat along the paths."""
    from pyspark.ml.regression import RandomForestRegressor
    rng = np.random.default_rng(11)
    v = rng.standard_normal((260, 4)).round(1)
    pdf = pd.DataFrame(v, columns=list("abcd")).assign(y=np.sin(3 * v[:, 0]) + v[:, 1] * v[:, 2] + rng.normal(scale=0.1, size=260))
    est = RandomForestRegressor(labelCol="y", numTrees=100, maxDepth=12, seed=3)
    model, _, trees = _spark_trees(spark, est, pdf, list("abcd"))
    assert max(X._depth(t) for t in trees) == 12 and len(trees) == 100
    phi = sum(t["weight"] * X.shap_values(t, v) for t in trees)
    base = sum(t["weight"] * X.expected_value(t) for t in trees)
    pred = X.staged_predictions(trees, v)[0, 0, 0]
    assert np.allclose(base + phi.sum(1), pred, atol=1e-9)
    for t in trees[:12]:                                   # every subset, row by row
        own = X.shap_values(t, v[:2])
        for r in range(2):
            for i in range(4):
                rest = [j for j in range(4) if j != i]
                want = sum(math.factorial(len(s)) * math.factorial(3 - len(s)) / 24 *
                           (X.conditional_expectation(t, v[r], {*s, i}) - X.conditional_expectation(t, v[r], set(s)))
                           for k in range(4) for s in itertools.combinations(rest, k))
                assert abs(own[r, i] - want) < 1e-9


def test_stages_equal_the_smaller_models(spark):
    from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
    rng = np.random.default_rng(12)
    v = rng.standard_normal((300, 3)).round(1)
    pdf = pd.DataFrame(v, columns=list("abc")).assign(y=v[:, 0] * 2 + np.abs(v[:, 1]) + rng.normal(scale=0.2, size=300))
    one = lambda est: np.array([r["prediction"] for r in (lambda m, d, _: m.transform(d).collect())(*_spark_trees(spark, est, pdf, list("abc")))])
    boost = lambda n: GBTRegressor(labelCol="y", maxIter=n, maxDepth=3, stepSize=0.2, seed=5)
    _, _, trees = _spark_trees(spark, boost(12), pdf, list("abc"))
    got = X.staged_predictions(trees, v, [1, 5, 12])
    for i, n in enumerate((1, 5, 12)):
        assert np.allclose(got[i, 0, 0], one(boost(n)), atol=1e-9)
    tree = lambda d: RandomForestRegressor(labelCol="y", numTrees=1, maxDepth=d, featureSubsetStrategy="all", bootstrap=False, seed=5)
    _, _, trees = _spark_trees(spark, tree(7), pdf, list("abc"))
    got = X.staged_predictions(trees, v, depths=[0, 2, 4, None], min_split=[1, 60])
    assert np.allclose(got[0, 0, 0], pdf["y"].mean())
    for i, d in ((1, 2), (2, 4), (3, 7)):
        assert np.allclose(got[0, i, 0], one(tree(d)), atol=1e-9)
    t = trees[0]
    for r in range(20):                                    # no node of fewer than 60 rows is split
        k = 0
        while t["left"][k] >= 0 and t["cover"][k] >= 60:
            k = t["left"][k] if v[r, t["feature"][k]] <= t["threshold"][k] else t["right"][k]
        assert got[0, 3, 1, r] == t["value"][k]


def test_staged_grid_of_the_usual_shape(spark):
    """Every setting and fold has its predictions, from one fit for each
    setting of what cannot be staged; the error table comes from them."""
    rng = np.random.default_rng(13)
    rows = [(p, e, float(x), float(np.sin(x) + rng.normal(scale=0.1))) for p in _monthly(0, 40) for e, x in zip("abcd", rng.standard_normal(4))]
    df = spark.createDataFrame(rows, "period date, entity string, x double, y double")
    grid = {"numTrees": [2, 5], "maxDepth": [2, None], "minSplit": [2, 10], "minInstancesPerNode": [1, 4]}
    pred = M.staged_grid(df, "y", M.feature_pipeline(cat=["entity"], num=["x"]), "forest", grid, keys=["period", "entity"], n_splits=2, min_train=24, val=6)
    got = pred.toPandas()
    assert got.groupby(["config", "fold"]).size().unique().tolist() == [24] and got["config"].nunique() == 16 and got["fold"].nunique() == 2
    table = M.cv_table(M.fold_errors(pred, "y")).orderBy("rank").toPandas()
    want = got.assign(e=(got["y"] - got["pred"]) ** 2).groupby(["config", "fold"])["e"].mean().pow(0.5).groupby("config").mean()
    assert np.allclose(table.set_index("config")["mean_rmse"].sort_index(), want)
    assert table["mean_rmse"].is_monotonic_increasing and table["params"].str.contains("minSplit").all()
