"""Forecasting many series at once.

M12 (Bayesian VAR, Minnesota prior): the data pass is ONE grouped
aggregate of sufficient statistics (X'X, X'Y, AR(1) sums, last p rows);
each group's k-sized system is then solved in ``applyInPandas`` on that
single aggregated row, so a hot entity never brings its rows to one Python
worker.

M13 (seasonal ARIMA grid): each (series, order) pair is fitted in
``applyInPandas`` on the aggregated monthly series (one row per period, so
the group size is bounded by the calendar, not by the raw rows). The fit is
conditional least squares over the points that every order of the grid can
use, so the orders' BIC values compare; they are not the exact-likelihood
values of a state-space fit. Driver series may enter as regressors with
seasonal ARMA errors; ``driver_chain`` forecasts the driver first.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._util import as_list

__all__ = ["bvar_forecast", "bvar_solve", "seasonal_grid", "DEFAULT_ORDERS", "css_fit", "css_forecast", "driver_chain"]


# M12 -----------------------------------------------------------------------
def _scales(sums: np.ndarray) -> np.ndarray:
    """Residual standard deviation of each variable's own AR(1). ``sums`` per
    variable: (n, sum y, sum x, sum xx, sum xy, sum yy, N, sum z, sum zz), with
    x the lag of y and z all values. Where the AR(1) fits exactly or has no
    degrees of freedom, the standard deviation of the values."""
    n, y, x, xx, xy, yy, m, z, zz = np.asarray(sums, float).T
    gram = np.stack([np.stack([n, x], -1), np.stack([x, xx], -1)], -2)
    rhs = np.stack([y, xy], -1)[..., None]
    beta = np.linalg.pinv(gram) @ rhs
    fit = (yy[:, None, None] - 2 * beta.mT @ rhs + beta.mT @ gram @ beta)[:, 0, 0]
    sd = np.sqrt(np.divide(np.maximum(fit, 0), n - 2, out=np.zeros_like(n), where=n > 2))
    spread = np.sqrt(np.maximum(np.divide(zz - z * z / np.where(m > 0, m, 1), m - 1, out=np.zeros_like(m), where=m > 1), 0))
    return np.where(sd > 1e-12, sd, spread)


def minnesota_precision(sigma: np.ndarray, p: int, l1: float, l2: float, l3: float) -> np.ndarray:
    """Prior precisions, (equation, lag, regressor): the prior variance is
    l1^2 / lag^(2 l3) times the ratio of the variances of equation and
    regressor, times l2^2 for other variables' lags."""
    var = sigma ** 2
    ratio = np.divide(var[:, None], var, out=np.full((len(var), len(var)), np.inf), where=var > 0)
    decay = l1 ** 2 / np.arange(1, p + 1) ** (2.0 * l3)
    cross = np.where(np.eye(len(var), dtype=bool), 1.0, l2 ** 2)
    return 1.0 / np.maximum(decay[None, :, None] * (cross * ratio)[:, None, :], 1e-12)


def bvar_solve(xtx, xty, ar, tail, k, p, horizon, l1, l2, l3, intercept=True):
    """Posterior-mean coefficients and the forecast of one group, from its
    sufficient statistics. The prior mean is a random walk for every variable;
    a constant has variance 100. All k equations are solved as one batch, and
    the forecast is the power of the companion matrix on the last p rows."""
    c, m = int(intercept), int(intercept) + k * p
    gram, moment = np.asarray(xtx, float).reshape(m, m), np.asarray(xty, float).reshape(m, k)
    prior = np.hstack([np.full((k, c), 0.01), minnesota_precision(_scales(ar), p, l1, l2, l3).reshape(k, k * p)])
    walk = np.hstack([np.zeros((k, c)), np.eye(k), np.zeros((k, k * (p - 1)))])
    beta = np.linalg.solve(gram + prior[:, None, :] * np.eye(m), (moment.T + prior * walk)[..., None])[..., 0].T
    # state: the last p rows, newest first, and a constant 1
    size = k * p + 1
    step = np.zeros((size, size))
    step[:k, :k * p] = beta[c:].T
    step[:k, -1] = beta[0] if c else 0.0
    step[k:k * p, : k * (p - 1)] = np.eye(k * (p - 1))
    step[-1, -1] = 1.0
    state = np.append(np.asarray(tail, float).reshape(p, k)[::-1].ravel(), 1.0)
    return np.stack([(np.linalg.matrix_power(step, h) @ state)[:k] for h in range(1, horizon + 1)]), beta


def bvar_forecast(df: DataFrame, by, order: str, cols, p: int = 1, horizon: int = 12,
                  lambda1: float = 0.18, lambda2: float = 0.5, lambda3: float = 1.0,
                  intercept: bool = True) -> DataFrame:
    """Per group: Minnesota-prior BVAR(p) on ``cols`` (complete rows, in
    ``order``), forecast ``horizon`` steps. Output: by, step, period (months
    after the last one), one column per variable."""
    by, cols = as_list(by), as_list(cols)
    k = len(cols)
    # one row per (group, period) (duplicates averaged), so the lag window of
    # a group is bounded by its calendar
    d = df.select(*by, order, *cols).dropna().groupBy(*by, order).agg(*[F.avg(c).alias(c) for c in cols])
    w = Window.partitionBy(*by).orderBy(order)
    d = d.withColumn("_t", F.row_number().over(w) - 1)
    lagc = {}
    for lag in range(1, p + 1):
        for j, c in enumerate(cols):
            lagc[(lag, j)] = F.lag(c, lag).over(w)
    d = d.withColumns({f"_l{lag}_{j}": e for (lag, j), e in lagc.items()}).withColumn(
        "_nrows", F.count("*").over(Window.partitionBy(*by)))
    xs = ([F.lit(1.0)] if intercept else []) + [F.col(f"_l{lag}_{j}") for lag in range(1, p + 1) for j in range(k)]
    m = len(xs)
    inb = F.col("_t") >= p
    xtx = [F.sum(F.when(inb, xs[a] * xs[b])) for a in range(m) for b in range(m)]
    xty = [F.sum(F.when(inb, xs[a] * F.col(cols[i]))) for a in range(m) for i in range(k)]
    ar = []
    for j, c in enumerate(cols):
        yl = F.col(f"_l1_{j}") if p >= 1 else F.lag(c, 1).over(w)
        has = F.col("_t") >= 1
        ar += [F.count(F.when(has, 1)).cast("double"), F.sum(F.when(has, F.col(c))), F.sum(F.when(has, yl)),
               F.sum(F.when(has, yl * yl)), F.sum(F.when(has, F.col(c) * yl)),
               F.sum(F.when(has, F.col(c) * F.col(c))), F.count("*").cast("double"), F.sum(c),
               F.sum(F.col(c) * F.col(c))]
    tail = [F.max_by(F.col(c), F.when(F.col("_t") == F.col("_nrows") - p + i, F.col("_t")))
            for i in range(p) for c in cols]
    agg = d.groupBy(*by).agg(F.array(*xtx).alias("xtx"), F.array(*xty).alias("xty"),
                             F.array(*ar).alias("ar"), F.array(*tail).alias("tail"),
                             F.max(order).alias("_last"), F.count("*").alias("_n"))
    agg = agg.filter(F.col("_n") > p)
    schema = ", ".join([f"`{b}` {dict(d.dtypes)[b]}" for b in by] + ["step int"] + [f"`{c}` double" for c in cols])

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for _, r in pdf.iterrows():  # one row per group
            arr = np.asarray(r["ar"], float).reshape(k, 9)
            fc, _ = bvar_solve(r["xtx"], r["xty"], arr, r["tail"], k, p, horizon, lambda1, lambda2, lambda3,
                               intercept)
            for s in range(horizon):
                rows.append([r[b] for b in by] + [s + 1] + list(fc[s]))
        return pd.DataFrame(rows, columns=by + ["step"] + cols)

    out = agg.select(*by, "xtx", "xty", "ar", "tail").groupBy(*by).applyInPandas(solve, schema)
    last = agg.select(*by, "_last")
    return out.join(last, by).select(*by, "step", F.add_months("_last", F.col("step")).alias(order), *cols)


# M13 -----------------------------------------------------------------------
# The order grid, (p, d, q) x (P, D, Q, s) with d = D = 1.
DEFAULT_ORDERS = [((p, 1, q), (P, 1, Q, 12)) for p in (0, 1) for q in (0, 1) for P in (0, 1) for Q in (0, 1)]


def _difference(y, d, D, s):
    z = np.asarray(y, float)
    for _ in range(d):
        z = np.diff(z, axis=0)
    for _ in range(D):
        z = z[s:] - z[:-s]
    return z


def _product(short: np.ndarray, seasonal: np.ndarray, s: int, sign: float) -> np.ndarray:
    """Coefficients of (1 + sign sum a_i L^i)(1 + sign sum b_j L^(s j)), the
    leading 1 left out and the sign taken off again."""
    one = np.r_[1.0, sign * short]
    two = np.zeros(s * len(seasonal) + 1)
    two[0] = 1.0
    two[s::s] = sign * seasonal
    return sign * np.convolve(one, two)[1:]


def _back_filtered(g: np.ndarray, first: int, theta: np.ndarray) -> np.ndarray:
    """Columns of ``g`` divided by the moving-average polynomial, in place:
    row t loses theta_i times row t - i. Rows before ``first`` are zero."""
    g[:first] = 0.0
    lags = [(i, f) for i, f in enumerate(theta, 1) if f]
    for t in range(first, len(g)) if lags else ():
        for i, f in lags:
            if t - i >= first:
                g[t] -= f * g[t - i]
    return g


def _lagged(w: np.ndarray, poly: np.ndarray) -> np.ndarray:
    """poly(L) w, rows before the polynomial's length being incomplete."""
    out = poly[0] * w
    for i in np.flatnonzero(poly[1:]) + 1:
        out[i:] += poly[i] * w[: len(w) - i]
    return out


class _SeasonalArma:
    """Regression with seasonal ARMA errors on differenced data: parameters
    (c, regressors, short AR, seasonal AR, short MA, seasonal MA), residuals
    from zero residuals before the first usable point, and their derivatives
    from the same filter, all columns at once."""

    def __init__(self, z: np.ndarray, x: np.ndarray, order, seasonal, start: int):
        (self.p, _, self.q), (self.P, _, self.Q, self.s) = order, seasonal
        self.z, self.x, self.start, self.first = z, x, start, self.p + self.s * self.P

    def split(self, par: np.ndarray) -> list[np.ndarray]:
        return np.split(par[1:], np.cumsum([self.x.shape[1], self.p, self.P, self.q]))

    def polynomials(self, par):
        _, a, b, m, n = self.split(par)
        return _product(a, b, self.s, -1.0), _product(m, n, self.s, 1.0)

    def residuals(self, par: np.ndarray) -> np.ndarray:
        phi, theta = self.polynomials(par)
        w = self.z - self.x @ self.split(par)[0]
        return _back_filtered(_lagged(w, np.r_[1.0, -phi]) - par[0], self.first, theta)

    def derivatives(self, par: np.ndarray, e: np.ndarray) -> np.ndarray:
        beta, a, b, m, n = self.split(par)
        phi, theta = self.polynomials(par)
        w, s = self.z - self.x @ beta, self.s
        shift = lambda v, i: np.r_[np.zeros(min(i, len(v))), v[: max(len(v) - i, 0)]]
        spread = lambda c, sign: np.r_[1.0, np.kron(sign * c, np.r_[np.zeros(s - 1), 1.0])] if len(c) else np.ones(1)
        season_w, short_w = _lagged(w, spread(b, -1.0)), _lagged(w, np.r_[1.0, -a])
        season_e, short_e = _lagged(e, spread(n, 1.0)), _lagged(e, np.r_[1.0, m])
        g = [-np.ones(len(w)), *(-_lagged(self.x, np.r_[1.0, -phi])).T]
        g += [-shift(season_w, i) for i in range(1, self.p + 1)] + [-shift(short_w, s * j) for j in range(1, self.P + 1)]
        g += [-shift(season_e, i) for i in range(1, self.q + 1)] + [-shift(short_e, s * j) for j in range(1, self.Q + 1)]
        return _back_filtered(np.stack(g, axis=1), self.first, theta)


def max_lag_of(orders) -> int:
    """Largest lag of the autoregressive part over a grid of orders."""
    return max((p + s * P for (p, _, _), (P, _, _, s) in orders), default=0)


def css_fit(y, order, seasonal, start: int | None = None, steps: int = 30, exog=None):
    """Conditional least squares of a regression with seasonal ARMA errors
    (product polynomials) on the differenced series: by damped Gauss-Newton
    steps from the least-squares regression without ARMA terms, the
    regressors' coefficients being moved together with the others. ``exog``
    has one row per value of ``y`` and one column per regressor. ``start`` is
    the first scored point; with the grid's largest lag all orders are scored
    on the same points. Returns dict(c, beta, phi, theta, sigma2, llf, aic,
    bic, hqic, nobs) or raises."""
    p, d, q = order
    P, D, Q, s = seasonal
    z = _difference(y, d, D, s)
    x = np.zeros((len(np.asarray(y)), 0)) if exog is None else np.asarray(exog, float).reshape(len(z) + d + s * D, -1)
    x = _difference(x, d, D, s)
    start = max(p + s * P, start or 0)
    nobs, arma, r = len(z) - start, p + q + P + Q, x.shape[1]
    if nobs < arma + r + 8:
        raise ValueError("series too short")
    if not (np.isfinite(z).all() and np.isfinite(x).all()):
        raise ValueError("missing values")
    model = _SeasonalArma(z, x, order, seasonal, start)
    flat = np.linalg.lstsq(np.c_[np.ones(nobs), x[start:]], z[start:], rcond=None)[0]
    par = np.r_[flat, np.zeros(arma)]
    full, damp = model.residuals(par), 1e-3
    for _ in range(steps if arma else 0):
        e, jac = full[start:], model.derivatives(par, full)[start:]
        grad, hess = jac.T @ e, jac.T @ jac
        while True:
            trial = par + np.linalg.solve(hess + damp * np.diag(np.diag(hess) + 1e-12), -grad)
            trial[1 + r:] = np.clip(trial[1 + r:], -0.999, 0.999)
            new = model.residuals(trial)
            gain = float(e @ e - new[start:] @ new[start:])
            if gain > 0 or damp > 1e6:
                break
            damp *= 10
        if gain <= 0:
            break
        par, full, damp = trial, new, damp / 10
        if gain <= 1e-10 * float(e @ e):
            break
    e = full[start:]
    phi, theta = model.polynomials(par)
    sigma2 = float(np.mean(e ** 2))
    with np.errstate(divide="ignore"):       # a perfect fit has sigma2 = 0, llf = +inf
        llf = float(-0.5 * nobs * (np.log(2 * np.pi * sigma2) + 1.0))
    used = arma + r + 2
    return dict(c=float(par[0]), beta=par[1: 1 + r], phi=phi, theta=theta, residuals=full, sigma2=sigma2, llf=llf, nobs=nobs,
                aic=-2 * llf + 2 * used, bic=-2 * llf + used * float(np.log(nobs)), hqic=-2 * llf + 2 * used * float(np.log(np.log(nobs))))


def css_forecast(y, fit, order, seasonal, horizon, exog=None, exog_future=None):
    """Forecast with future shocks 0: of the errors u = y - X beta, whose
    differences are undone by one recursion ((1 - L)^d (1 - L^s)^D u = z), plus
    the regressors' future values times beta. Only as many steps as there are
    future values."""
    (_, d, _), (_, D, _, s) = order, seasonal
    phi, theta, beta = fit["phi"], fit["theta"], fit["beta"]
    u, ahead = np.asarray(y, float), np.zeros(horizon)
    if len(beta):
        future = np.asarray(exog_future, float).reshape(-1, len(beta))[:horizon]
        u, ahead, horizon = u - np.asarray(exog, float).reshape(len(u), -1) @ beta, future @ beta, len(future)
    z = _difference(u, d, D, s)
    e = np.r_[fit["residuals"], np.zeros(horizon)]
    z = np.r_[z, np.zeros(horizon)]
    back = np.ones(1)
    for unit in [np.array([1.0, -1.0])] * d + [np.r_[1.0, np.zeros(s - 1), -1.0]] * D:
        back = np.convolve(back, unit)
    back = -back[1:]
    levels = np.r_[u, np.zeros(horizon)]
    last = lambda x, t, w: float(x[t - len(w): t][::-1] @ w) if len(w) else 0.0
    for h in range(horizon):
        t = len(z) - horizon + h
        z[t] = fit["c"] + last(z, t, phi) + last(e, t, theta)
        levels[len(u) + h] = z[t] + last(levels, len(u) + h, back)
    return levels[len(u):] + ahead


def seasonal_grid(df: DataFrame, by, order: str, value: str, orders=None, horizon: int = 12, exog=(),
                  exog_future: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Fit every order of the grid to every series; rank by BIC per series
    (failures kept as rows with status); forecast with the best order.
    Returns (grid results, forecasts).

    ``exog`` names driver columns of ``df`` that enter as regressors (rows
    without a driver value are left out of the fit); ``exog_future`` holds
    their values after the last month, as (by, order, exog) rows. A series is
    forecast for the months right after its last one that have all drivers."""
    by, exog = as_list(by), as_list(exog)
    if bool(exog) != (exog_future is not None):
        raise ValueError("exog and exog_future go together")
    orders = orders or DEFAULT_ORDERS
    common = max_lag_of(orders)
    spark = df.sparkSession
    og = spark.createDataFrame([(i, str(o), str(so)) for i, (o, so) in enumerate(orders)],
                               "order_id int, pdq string, pdqs string")
    # one row per (series, period): a group never exceeds the calendar length,
    # whatever the number of raw rows behind a hot series
    drivers = [F.avg(F.col(c).cast("double")).alias(f"_x{i}") for i, c in enumerate(exog)]
    series = (df.filter(F.col(value).isNotNull()).groupBy(*by, order)
                .agg(F.avg(F.col(value).cast("double")).alias("_y"), *drivers))
    names = [f"_x{i}" for i in range(len(exog))]
    for c in names:
        series = series.filter(F.col(c).isNotNull())
    last = series.groupBy(*by).agg(F.max(order).alias("_last"))
    if exog:
        ahead = exog_future.groupBy(*by, order).agg(*drivers).join(last, by).filter(
            (F.col(order) > F.col("_last")) & (F.col(order) <= F.add_months("_last", horizon)))
        series = series.unionByName(ahead.select(*by, order, F.lit(None).cast("double").alias("_y"), *names))
    from .joins import repeat_for_each
    x = repeat_for_each(series, og)
    types = dict(df.dtypes)
    schema = ", ".join([f"`{b}` {types[b]}" for b in by] +
                       ["order_id int", "pdq string", "pdqs string", "bic double", "aic double", "hqic double",
                        "nobs int", "beta array<double>", "status string", "forecast array<double>"])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        oid = int(pdf["order_id"].iloc[0])
        o, so = orders[oid]
        key = [pdf[b].iloc[0] for b in by]
        known = pdf["_y"].notna().to_numpy()
        y, past, future = pdf["_y"].to_numpy()[known], pdf[names].to_numpy()[known], pdf.loc[~known]
        # drivers right after the last month, up to the first gap
        when = pd.to_datetime(future[order])
        month = (when.dt.year * 12 + when.dt.month).to_numpy()
        end = pd.Timestamp(pdf[order].iloc[int(known.sum()) - 1]) if known.any() else pd.Timestamp(0)
        steps = int(np.cumprod(month == end.year * 12 + end.month + 1 + np.arange(len(month))).sum()) if len(month) else 0
        try:
            f = css_fit(y, o, so, common, exog=past if names else None)
            fc = css_forecast(y, f, o, so, horizon, past, future[names].to_numpy()[:steps])
            row = key + [oid, str(o), str(so), f["bic"], f["aic"], f["hqic"], f["nobs"], list(map(float, f["beta"])), "ok", list(map(float, fc))]
        except Exception as ex:  # noqa: BLE001 - failures are kept as rows
            row = key + [oid, str(o), str(so), None, None, None, None, None, f"failed: {type(ex).__name__}", None]
        return pd.DataFrame([row], columns=by + ["order_id", "pdq", "pdqs", "bic", "aic", "hqic", "nobs", "beta", "status",
                                                 "forecast"])

    res = x.groupBy(*by, "order_id").applyInPandas(fit, schema)
    w = Window.partitionBy(*by).orderBy(F.col("bic").asc_nulls_last(), "order_id")
    res = res.withColumn("rank", F.row_number().over(w))
    best = res.filter((F.col("rank") == 1) & (F.col("status") == "ok")).join(last, by)
    fc = best.select(*by, "pdq", "pdqs", "_last", F.posexplode("forecast").alias("_i", "forecast")).select(
        *by, "pdq", "pdqs", F.add_months("_last", F.col("_i") + 1).alias(order), "forecast")
    return (res if exog else res.drop("beta")).drop("forecast"), fc


def driver_chain(df: DataFrame, by, order: str, driver: str, value: str, orders=None, horizon: int = 12) -> tuple[DataFrame, DataFrame]:
    """Two-stage forecast: the grid on ``driver``, then the grid on ``value``
    with the driver as regressor and its forecast as the regressor's future.
    Returns (grid results of the value, rows of by, order, driver and value
    forecasts)."""
    by = as_list(by)
    _, first = seasonal_grid(df, by, order, driver, orders, horizon)
    ahead = first.select(*by, order, F.col("forecast").alias(driver))
    # the driver's fits feed both the value's fits and the result
    from ..session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    ahead = ahead.checkpoint(eager=True)
    grid, second = seasonal_grid(df, by, order, value, orders, horizon, exog=[driver], exog_future=ahead)
    both = second.select(*by, order, "pdq", "pdqs", F.col("forecast").alias(f"{value}_forecast")).join(
        ahead.withColumnRenamed(driver, f"{driver}_forecast"), [*by, order])
    return grid, both.select(*by, order, "pdq", "pdqs", f"{driver}_forecast", f"{value}_forecast")


# Python workers must not need this package installed: functions of this
# module travel by value inside the task closures.
def _ship_by_value() -> None:
    import sys

    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_by_value()
