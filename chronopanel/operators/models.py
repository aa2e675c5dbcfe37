"""Modelling on Spark ML.

Data passes are distributed: Spark ML estimators, or ONE aggregate of
sufficient statistics (Gram sums) whose size depends on the number of
features, not on rows. Only those k x k statistics reach the driver.
"""

from __future__ import annotations

import functools
import itertools
import math
import sys
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._util import as_list
from .explain import export_trees, staged_predictions
from .windows import fold_table, month_positions, running_counts

__all__ = ["ols", "gram_blocks", "lasso_path_cv", "lasso_select", "fold_borders", "row_borders", "prefix_grams", "select_features", "align_features",
           "feature_pipeline", "feature_map", "cv_fits", "tune_forest", "tune_gbt", "staged_grid", "fold_errors", "cv_table", "refit", "score_scenarios"]


# M01 -----------------------------------------------------------------------
def ols(df: DataFrame, y: str, xs, intercept: bool = True) -> DataFrame:
    """Ordinary least squares with standard errors, t and p values (normal
    equations solver; the summary statistics are k-sized)."""
    xs = as_list(xs)
    d = df.select(y, *xs).dropna()
    va = VectorAssembler(inputCols=xs, outputCol="_f")
    lr = LinearRegression(featuresCol="_f", labelCol=y, solver="normal", fitIntercept=intercept,
                          regParam=0.0, standardization=False)
    m = lr.fit(va.transform(d))
    s = m.summary
    names = xs + (["const"] if intercept else [])
    coefs = list(m.coefficients) + ([m.intercept] if intercept else [])
    rows = [(n, float(c), float(se), float(t), float(p)) for n, c, se, t, p in
            zip(names, coefs, s.coefficientStandardErrors, s.tValues, s.pValues)]
    return df.sparkSession.createDataFrame(rows, "name string, coef double, std_err double, t_stat double, p_value double")


# M02 -----------------------------------------------------------------------
def gram_blocks(df: DataFrame, y: str, xs, block: str) -> dict:
    """Sufficient statistics per block in ONE aggregate: n, sum x, sum y,
    X'X, X'y, y'y. Returns numpy arrays indexed by block (k-sized)."""
    xs = as_list(xs)
    k = len(xs)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    aggs = [F.count("*").alias("n"), F.sum(y).alias("sy"), F.sum(F.col(y) * F.col(y)).alias("syy")]
    aggs += [F.sum(x).alias(f"sx{i}") for i, x in enumerate(xs)]
    aggs += [F.sum(F.col(x) * F.col(y)).alias(f"sxy{i}") for i, x in enumerate(xs)]
    aggs += [F.sum(F.col(xs[i]) * F.col(xs[j])).alias(f"g{i}_{j}") for i, j in pairs]
    rows = df.groupBy(block).agg(*aggs).collect()
    out = {}
    for r in rows:
        G = np.zeros((k, k))
        for i, j in pairs:
            G[i, j] = G[j, i] = r[f"g{i}_{j}"]
        out[r[block]] = dict(n=r["n"], sy=r["sy"], syy=r["syy"], sx=np.array([r[f"sx{i}"] for i in range(k)]),
                             sxy=np.array([r[f"sxy{i}"] for i in range(k)]), G=G)
    return out


def _merge(stats) -> dict:
    stats = list(stats)
    return dict(n=sum(s["n"] for s in stats), sy=sum(s["sy"] for s in stats), syy=sum(s["syy"] for s in stats),
                sx=sum(s["sx"] for s in stats), sxy=sum(s["sxy"] for s in stats), G=sum(s["G"] for s in stats))


def _centered(s):
    n = s["n"]
    mx, my = s["sx"] / n, s["sy"] / n
    C = s["G"] / n - np.outer(mx, mx)
    c = s["sxy"] / n - mx * my
    return C, c, mx, my


def _yy(s) -> float:
    return float(s["syy"] / s["n"] - (s["sy"] / s["n"]) ** 2)


def _cd(C, c, alpha, b0=None, yy=None, tol=1e-4, max_iter=50_000):
    """Coordinate descent for 1/2 b'Cb - c'b + alpha |b|_1 (covariance form,
    C = X'X/n and c = X'y/n of centred data). Stops on the duality gap
    relative to ``yy`` = y'y/n (as scikit-learn's ``tol``), or on tiny
    updates when ``yy`` is not given."""
    k = len(c)
    b = np.zeros(k) if b0 is None else b0.copy()
    d = np.diag(C).copy()
    d[d <= 0] = 1.0
    own = np.diag(C).tolist()
    for _ in range(max_iter):
        w_max = d_max = 0.0
        rest = c - C @ b                                 # kept up to date within a sweep
        for j in range(k):
            was = b.item(j)
            r = rest.item(j) + own[j] * was
            nb = math.copysign(max(abs(r) - alpha, 0.0), r) / d.item(j)
            if nb != was:
                rest -= C[j] * (nb - was)
                b[j] = nb
                d_max = max(d_max, abs(nb - was))
            w_max = max(w_max, abs(nb))
        if yy is None:
            if d_max < 1e-10:
                break
            continue
        if w_max == 0.0 or d_max / w_max < tol:
            xta = c - C @ b                          # X'R / n
            r2 = yy + b @ C @ b - 2 * c @ b          # R'R / n
            dual = np.max(np.abs(xta)) if k else 0.0
            const = alpha / dual if dual > alpha else 1.0
            gap = 0.5 * r2 * (1 + const ** 2) if dual > alpha else r2
            gap += alpha * np.abs(b).sum() - const * (yy - c @ b)
            if gap < tol * yy:
                break
    return b


def _sse(s, b, intercept):
    """Sum of squared errors of y - intercept - x b from block sums."""
    G, sxy, sx, sy, syy, n = s["G"], s["sxy"], s["sx"], s["sy"], s["syy"], s["n"]
    return (syy - 2 * b @ sxy - 2 * intercept * sy + b @ G @ b + 2 * intercept * (b @ sx) + n * intercept ** 2)


def _scaled(s: dict, mean: np.ndarray, sd: np.ndarray) -> dict:
    """The statistics of (x - mean) / sd."""
    cross = np.outer(mean, s["sx"])
    G = s["G"] - cross - cross.T + s["n"] * np.outer(mean, mean)
    return s | dict(G=G / np.outer(sd, sd), sxy=(s["sxy"] - mean * s["sy"]) / sd, sx=(s["sx"] - s["n"] * mean) / sd)


def _standard(s: dict) -> tuple[np.ndarray, np.ndarray]:
    """Means and population standard deviations (1 where there is no spread)."""
    C, _, mx, _ = _centered(s)
    var = np.diag(C)
    return mx, np.where(var > 1e-14 * np.maximum(mx * mx, 1e-300), np.sqrt(np.maximum(var, 0.0)), 1.0)


def _lasso_cv(full: dict, folds, n_alphas: int, eps: float, scale_in_fold: bool):
    """The path over (training, validation) statistics, and the coefficients
    on ``full`` at the alpha with the smallest mean error."""
    C, c, _, _ = _centered(full)
    amax = float(np.max(np.abs(c))) if len(c) else 0.0
    alphas = np.logspace(np.log10(amax), np.log10(amax * eps), n_alphas) if amax > 0 else np.array([0.0])
    mse = np.full((len(folds), len(alphas)), np.nan)
    for f, (tr, va) in enumerate(folds):
        if va is None or tr["n"] == 0 or va["n"] == 0:
            continue
        Ct, ct, mx, my = _centered(tr)
        sd = np.sqrt(np.clip(np.diag(Ct), 1e-300, None)) if scale_in_fold else np.ones(len(ct))
        Cs, cs = Ct / np.outer(sd, sd), ct / sd
        b = np.zeros(len(ct))
        yy = _yy(tr)
        for a_i, a in enumerate(alphas):
            b = _cd(Cs, cs, a, b, yy=yy)
            braw = b / sd
            icpt = my - mx @ braw
            mse[f, a_i] = _sse(va, braw, icpt) / va["n"]
    mean = np.nanmean(mse, axis=0)
    best = int(np.nanargmin(mean))
    b = np.zeros(len(c))
    yy = _yy(full)
    for a in alphas[: best + 1]:
        b = _cd(C, c, a, b, yy=yy)
    return alphas, mean, float(alphas[best]), b, mse[:, best]


def lasso_path_cv(stats: dict, n_splits: int, n_alphas: int = 200, eps: float = 1e-3,
                  scale_in_fold: bool = False):
    """LASSO over a log-spaced alpha path with expanding row folds. ``stats``
    maps block 0..n_splits to sufficient statistics. Returns (alphas,
    mean validation MSE per alpha, best alpha, coefficients on all rows,
    validation MSE per fold at the best alpha). ``scale_in_fold``
    re-standardises each training fold by its own spread (no information
    from the validation rows), instead of the all-rows scaling."""
    folds = [(_merge(stats[b] for b in range(f + 1) if b in stats), stats.get(f + 1)) for f in range(n_splits)]
    return _lasso_cv(_merge(stats.values()), folds, n_alphas, eps, scale_in_fold)


def fold_borders(n: int, n_splits: int) -> list[tuple[int, int]]:
    """(rows of training, end of validation) of expanding row folds over n rows."""
    t = n // (n_splits + 1)
    return [(n - (n_splits - i) * t, n - (n_splits - i - 1) * t) for i in range(n_splits)]


def row_borders(df: DataFrame, order, n_rows: int, positions, rest=()) -> tuple[list, dict[int, tuple]]:
    """Where the rows at ``positions`` (0-based, in the order of the columns
    ``order``, then of ``rest``) begin, without numbering or sorting all rows.

    Column by column: the distinct values' counts are added up
    (``running_counts``); a position inside a value's rows is looked for among
    the next column's values in those rows alone, until it falls on a border.
    Returns the key columns in use and, per position, (key values, rows with
    that very key that still come before the position)."""
    levels = [[c] for c in as_list(order)] + ([as_list(rest)] if as_list(rest) else [])
    keys, found, open_ = [], {}, {p: ((), p) for p in sorted(set(positions)) if 0 < p < n_rows}
    spark = df.sparkSession
    for level in levels:
        if not open_:
            break
        prefixes = sorted({v for v, _ in open_.values()}, key=str)
        at = {v: i for i, v in enumerate(prefixes)}
        if keys:
            # at most one prefix a position
            wanted = spark.createDataFrame([(i, *v) for i, v in enumerate(prefixes)], "_prefix int, " + ", ".join(
                f"`_k{j}` {df.schema[k].dataType.simpleString()}" for j, k in enumerate(keys)))
            part = df.join(F.broadcast(wanted), [F.col(k).eqNullSafe(F.col(f"_k{j}")) for j, k in enumerate(keys)])
        else:
            part = df.withColumn("_prefix", F.lit(0))
        counts = running_counts(part.groupBy("_prefix", *level).agg(F.count("*").alias("_c")), ["_prefix"], level, "_c")
        hit = [(F.col("_prefix") == at[v]) & (F.col("before") <= o) & (F.col("upto") > o) for v, o in open_.values()]
        any_hit = hit[0]
        for h in hit[1:]:
            any_hit = any_hit | h
        rows = counts.filter(any_hit).collect()
        keys += level
        inside = {}
        for p, (v, o) in open_.items():
            r = next(r for r in rows if r["_prefix"] == at[v] and r["before"] <= o < r["upto"])
            v = (*v, *[r[c] for c in level])
            if o == r["before"]:
                found[p] = (v, 0)
            else:
                inside[p] = (v, o - r["before"])
        open_ = inside
    return keys, found | open_


def prefix_grams(df: DataFrame, y: str, xs, order, positions, n: int | None = None) -> dict[int, dict]:
    """Sufficient statistics of the rows before each position of the order, as
    prefix sums of one aggregate over the blocks between the positions. Rows
    that tie in ``order`` are ordered by y and the features, so the blocks do
    not depend on the partitioning; rows equal in all of them are shared out
    by number."""
    xs = as_list(xs)
    n = df.count() if n is None else n
    keys, borders = row_borders(df, order, n, positions, [y, *xs])
    inner = sorted(borders)

    def reached(values):
        """Is the row's key at or after the border's (a prefix of the keys)?"""
        out = F.lit(True)
        for k, v in reversed(list(zip(keys, values))):
            c = F.col(k)
            v = F.lit(v).cast(df.schema[k].dataType)
            out = F.coalesce((c > v) | ((c == v) & out), v.isNull() & (c.isNotNull() | out), F.lit(False))
        return out.cast("int")

    block = sum((reached(borders[p][0]) for p in inner), F.lit(0))
    stats = gram_blocks(df.withColumn("_blk", block), y, xs, "_blk")
    k = len(xs)
    zero = dict(n=0, sy=0.0, syy=0.0, sx=np.zeros(k), sxy=np.zeros(k), G=np.zeros((k, k)))
    out, total = {0: zero, n: zero}, zero
    for i in range(len(inner) + 1):
        total = _merge([total, stats.get(i, zero)])
        if i < len(inner):
            values, more = borders[inner[i]]
            row = dict(zip(keys, values))
            extra = zero
            if more:  # ``more`` copies of one row come before the border
                v, w = np.array([float(row[x]) for x in xs]), float(row[y])
                extra = dict(n=more, sy=more * w, syy=more * w * w, sx=more * v, sxy=more * w * v, G=more * np.outer(v, v))
            out[inner[i]] = _merge([total, extra])
    out[n] = total
    return out


def _between(prefix: dict[int, dict], a: int, b: int) -> dict:
    return {k: prefix[b][k] - prefix[a][k] for k in prefix[b]}


def lasso_select(df: DataFrame, y: str, xs, order, n_splits: int = 5, n_alphas: int = 200,
                 eps: float = 1e-3, scale: str = "fold", inner_splits: int = 3) -> DataFrame:
    """Feature selection with LASSO and expanding row folds (``TimeSeriesSplit``).

    The borders of all folds are found from cumulative counts (``row_borders``)
    and one distributed pass sums the Gram blocks between them; the alpha paths
    and the coordinate descents run on differences of their prefix sums, one
    task for each outer fold.
    ``scale="fold"`` standardises again inside each training fold, so
    validation rows do not reach the scaler; ``scale="all"`` leaves it fitted
    on all rows that the selection sees.

    The nested error is that of the whole selection: each of the ``n_splits``
    training folds chooses its own alpha by ``inner_splits`` folds of its own
    rows and is scored on the rows after it.
    Output: feature, coef (standardised scale), abs_coef, selected, alpha,
    cv_rmse mean and spread over the folds at the chosen alpha, nested_rmse
    mean and spread (population std over folds).
    """
    xs = as_list(xs)
    d = df.select(*as_list(order), y, *[x for x in xs if x not in as_list(order)]).dropna()
    mom = d.agg(F.count("*").alias("n"), *[F.avg(x).alias(f"m{i}") for i, x in enumerate(xs)],
                *[F.stddev_pop(x).alias(f"s{i}") for i, x in enumerate(xs)]).first()
    n = mom["n"]
    z = d.select(*as_list(order), y, *[((F.col(x) - mom[f"m{i}"]) /
                                        (mom[f"s{i}"] if mom[f"s{i}"] else 1.0)).alias(f"_z{i}") for i, x in enumerate(xs)])
    outer = fold_borders(n, n_splits)
    nested = {end: fold_borders(end, inner_splits) for end, _ in outer}
    every = [p for pairs in [outer, *nested.values()] for pair in pairs for p in pair]
    prefix = prefix_grams(z, y, [f"_z{i}" for i in range(len(xs))], order, every, n)
    in_fold = scale == "fold"
    pairs = lambda borders, of=lambda s: s: [(of(_between(prefix, 0, a)), of(_between(prefix, a, b))) for a, b in borders]

    def choose(batches):
        """Fold 0 is the selection on all rows, fold f that of the f-th
        training fold with the scaling of its own rows."""
        for pdf in batches:
            for f in pdf["fold"]:
                if f == 0:
                    _, _, best, b, fold_mse = _lasso_cv(prefix[n], pairs(outer), n_alphas, eps, in_fold)
                    yield pd.DataFrame({"fold": [f], "alpha": [best], "coef": [b.tolist()], "errors": [np.sqrt(fold_mse).tolist()]})
                    continue
                end, stop = outer[f - 1]
                mean, sd = _standard(_between(prefix, 0, end))
                scaled = lambda s: _scaled(s, mean, sd)
                train, test = pairs([(end, stop)], scaled)[0]
                _, _, best, b, _ = _lasso_cv(train, pairs(nested[end], scaled), n_alphas, eps, in_fold)
                _, _, mx, my = _centered(train)
                error = np.sqrt(_sse(test, b, my - mx @ b) / test["n"]) if test["n"] else np.nan
                yield pd.DataFrame({"fold": [f], "alpha": [best], "coef": [b.tolist()], "errors": [[float(error)]]})

    spark = df.sparkSession
    found = {r["fold"]: r for r in spark.range(n_splits + 1, numPartitions=n_splits + 1).select(F.col("id").cast("int").alias("fold"))
             .mapInPandas(choose, "fold int, alpha double, coef array<double>, errors array<double>").collect()}
    rmse, errors = found[0]["errors"], [found[f]["errors"][0] for f in range(1, n_splits + 1)]
    rows = [(x, c, abs(c), abs(c) > 0, found[0]["alpha"], float(np.mean(rmse)), float(np.std(rmse)),
             float(np.mean(errors)), float(np.std(errors))) for x, c in zip(xs, found[0]["coef"])]
    return df.sparkSession.createDataFrame(
        rows, "feature string, coef double, abs_coef double, selected boolean, alpha double, "
              "cv_rmse_mean double, cv_rmse_std double, nested_rmse_mean double, nested_rmse_std double")


# M03 / M04 -----------------------------------------------------------------
def select_features(df: DataFrame, selected, keep=()) -> tuple[DataFrame, list]:
    """Keep ``keep`` columns plus the selected features present; also return
    the selected features that are absent."""
    selected = as_list(selected)
    absent = [c for c in selected if c not in df.columns]
    return df.select(*as_list(keep), *[c for c in selected if c in df.columns]), absent


def align_features(df: DataFrame, expected, fill: float | None = 0.0, keep=()) -> DataFrame:
    """Columns in the model's order; absent ones filled with ``fill`` (or an
    error when ``fill`` is None: strict mode)."""
    expected = as_list(expected)
    absent = [c for c in expected if c not in df.columns]
    if absent and fill is None:
        raise KeyError(f"features absent: {absent}")
    cols = [F.col(c) if c in df.columns else F.lit(float(fill)).alias(c) for c in expected]
    return df.select(*as_list(keep), *cols)


# M05 -----------------------------------------------------------------------
def feature_pipeline(cat=(), num=(), scale: bool = False, out: str = "features") -> list:
    """Stages: one-hot entity (unknown values kept in an extra slot),
    numeric pass-through or standardised, assembled into ``out``."""
    stages, cols = [], []
    for c in as_list(cat):
        stages += [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep"),
                   OneHotEncoder(inputCol=f"{c}_idx", outputCol=f"{c}_oh", handleInvalid="keep")]
        cols.append(f"{c}_oh")
    num = as_list(num)
    if num and scale:
        stages += [VectorAssembler(inputCols=num, outputCol="_num", handleInvalid="keep"),
                   StandardScaler(inputCol="_num", outputCol="_num_s", withMean=True, withStd=True)]
        cols.append("_num_s")
    else:
        cols += num
    stages.append(VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep"))
    return stages


def feature_map(df: DataFrame, vector_col: str = "features") -> DataFrame:
    """(index, name) of every slot of an assembled feature vector, read
    from the ML attribute metadata Spark keeps in the schema (no job). One-hot
    slots are named ``<column>_<category>``."""
    meta = df.schema[vector_col].metadata.get("ml_attr", {})
    rows = []
    for kind in ("numeric", "binary", "nominal"):
        for a in meta.get("attrs", {}).get(kind, []):
            rows.append((int(a["idx"]), str(a.get("name", f"f_{a['idx']}")), kind))
    if not rows:
        rows = [(i, f"f_{i}", "numeric") for i in range(int(meta.get("num_attrs", 0)))]
    return df.sparkSession.createDataFrame(sorted(rows), "index int, name string, kind string")


# M06-M08 -------------------------------------------------------------------
def _rmse(pred: DataFrame, y: str) -> tuple[float, int]:
    r = pred.agg(F.sqrt(F.avg((F.col(y) - F.col("prediction")) ** 2)).alias("r"), F.count("*").alias("n")).first()
    return float(r["r"]) if r["r"] is not None else float("nan"), int(r["n"])


def cv_fits(df: DataFrame, y: str, stages, make_estimator, grid: dict, period: str = "period",
            n_splits: int = 5, min_train: int = 24, val: int = 6, threads: int = 4) -> DataFrame:
    """Fit every (parameter set, month fold) pair (expanding month folds) and
    score the validation months.

    Rows carry their month's position and are written once; a fold is a filter
    on the position, not a copy. The feature stages are fitted once for each
    fold on its training months, and its assembled rows are kept while the
    fold's parameter sets are fitted. Each fit is a distributed Spark ML job;
    a bounded thread pool keeps several folds in flight."""
    from ..session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    ends = {r["fold"]: r["train_end"] for r in
            fold_table(df.select(period), period, n_splits, min_train, val).select("fold", "train_end").distinct().collect()}
    placed = df.join(month_positions(df, period), period).checkpoint(eager=True)
    keys = sorted(grid)
    combos = [dict(zip(keys, v)) for v in itertools.product(*[grid[k] for k in keys])]

    def run(fold):
        end = ends[fold]
        train = placed.filter(F.col("_pos") < end)
        features = Pipeline(stages=list(stages)).fit(train)
        keep = lambda d: features.transform(d).select(y, "features").persist()
        fit_on, score_on = keep(train), keep(placed.filter((F.col("_pos") >= end) & (F.col("_pos") < end + val)))
        try:
            out = []
            for ci, params in enumerate(combos):
                rmse, nv = _rmse(make_estimator(params).fit(fit_on).transform(score_on), y)
                out.append((ci, str(sorted(params.items())), fold, rmse, nv))
            return out
        finally:
            fit_on.unpersist()
            score_on.unpersist()

    with ThreadPoolExecutor(max_workers=threads) as ex:
        res = [r for rows in ex.map(run, sorted(ends)) for r in rows]
    return df.sparkSession.createDataFrame(res, "config int, params string, fold int, rmse double, n_val long")


def tune_forest(df: DataFrame, y: str, stages, grid: dict, seed: int = 42, **kw) -> DataFrame:
    def est(p):
        return RandomForestRegressor(featuresCol="features", labelCol=y, seed=seed, **p)
    return cv_fits(df, y, stages, est, grid, **kw)


def tune_gbt(df: DataFrame, y: str, stages, grid: dict, seed: int = 42, **kw) -> DataFrame:
    """Gradient-boosted trees (no L1/L2 leaf penalties in Spark's GBT)."""
    def est(p):
        return GBTRegressor(featuresCol="features", labelCol=y, seed=seed, **p)
    return cv_fits(df, y, stages, est, grid, **kw)


#: Grid keys that one fitted ensemble serves, by the estimator's name.
STAGED = {"forest": ("numTrees", "maxDepth", "minSplit"), "gbt": ("maxIter",)}


def staged_grid(df: DataFrame, y: str, stages, kind: str, grid: dict, keys=(), period: str = "period", n_splits: int = 5,
                min_train: int = 24, val: int = 6, seed: int = 42, threads: int = 4) -> DataFrame:
    """Predictions of every setting of a grid on its validation folds, from far
    fewer fits: (config, params, fold, the columns of ``keys``, y, pred).

    A boosted ensemble of n rounds begins with those of fewer rounds; a forest
    of n trees grown to depth d holds the smaller forests, the shallower ones
    and those that split no node of fewer than ``minSplit`` rows. So each
    setting of the other parameters is fitted once per fold, with the largest
    ``numTrees`` and ``maxDepth`` (``maxIter``), and all its stages are scored
    in one walk through its trees. Spark draws a forest's samples for all its
    trees together: a smaller forest is one of that size, not the one that a
    fit of its own would draw. ``maxDepth`` None is Spark's limit of 30."""
    from ..session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    keys, staged = as_list(keys), STAGED[kind]
    names = sorted(grid)
    rest = [k for k in names if k not in staged]
    deep = lambda d: 30 if d is None else d
    combos = [dict(zip(names, v)) for v in itertools.product(*[grid[k] for k in names])]
    config = {tuple(sorted(c.items(), key=str)): i for i, c in enumerate(combos)}
    sizes = sorted(grid.get("numTrees" if kind == "forest" else "maxIter", [20]))
    depths, splits = grid.get("maxDepth", [5]), grid.get("minSplit", [1])
    ends = {r["fold"]: r["train_end"] for r in
            fold_table(df.select(period), period, n_splits, min_train, val).select("fold", "train_end").distinct().collect()}
    placed = df.join(month_positions(df, period), period).checkpoint(eager=True)
    types = dict(df.dtypes)
    schema = ", ".join(["config int", "params string", "fold int"] + [f"`{k}` {types[k]}" for k in keys] + [f"`{y}` double", "pred double"])

    def estimator(setting):
        if kind == "forest":
            return RandomForestRegressor(featuresCol="features", labelCol=y, seed=seed, numTrees=sizes[-1], maxDepth=max(map(deep, depths)), **setting)
        return GBTRegressor(featuresCol="features", labelCol=y, seed=seed, maxIter=sizes[-1], **setting)

    def scorer(trees, setting, fold):
        def run(batches):
            for pdf in batches:
                if not len(pdf):
                    continue
                x = np.stack(pdf["_x"].to_numpy()).astype(float)
                if kind == "forest":
                    sums = staged_predictions(trees.value, x, sizes, [None if d is None else d for d in depths], splits)
                    share = len(trees.value) / np.array(sizes, float)
                    stages = [({"numTrees": n, "maxDepth": d, "minSplit": m}, sums[i, j, k] * share[i])
                              for i, n in enumerate(sizes) for j, d in enumerate(depths) for k, m in enumerate(splits)]
                else:
                    sums = staged_predictions(trees.value, x, sizes)
                    stages = [({"maxIter": n}, sums[i, 0, 0]) for i, n in enumerate(sizes)]
                for own, pred in stages:
                    params = setting | {k: v for k, v in own.items() if k in grid}
                    yield pdf[[*keys, y]].assign(config=config[tuple(sorted(params.items(), key=str))], params=str(sorted(params.items(), key=str)),
                                                 fold=fold, pred=pred)[["config", "params", "fold", *keys, y, "pred"]]

        return run

    def fit(fold):
        end, out = ends[fold], []
        train = placed.filter(F.col("_pos") < end)
        features = Pipeline(stages=list(stages)).fit(train)
        fit_on = features.transform(train).select(y, "features").persist()
        score_on = features.transform(placed.filter((F.col("_pos") >= end) & (F.col("_pos") < end + val)))
        score_on = score_on.select(*keys, F.col(y).cast("double").alias(y), vector_to_array("features").alias("_x"))
        try:
            for values in itertools.product(*[grid[k] for k in rest]):
                setting = dict(zip(rest, values))
                model = estimator(setting).fit(fit_on)
                trees = df.sparkSession.sparkContext.broadcast(export_trees(model, df.sparkSession))
                out.append(score_on.mapInPandas(scorer(trees, setting, fold), schema))
            return out
        finally:
            fit_on.unpersist()

    with ThreadPoolExecutor(max_workers=threads) as ex:
        parts = [d for found in ex.map(fit, sorted(ends)) for d in found]
    return functools.reduce(DataFrame.unionByName, parts)


def fold_errors(predictions: DataFrame, y: str) -> DataFrame:
    """RMSE and rows of every configuration and fold, as ``cv_table`` takes them."""
    e = F.col(y) - F.col("pred")
    return predictions.groupBy("config", "params", "fold").agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.count("*").alias("n_val"))


def cv_table(results: DataFrame) -> DataFrame:
    """Mean and spread of the fold RMSE per configuration, ranked; the best
    configuration has rank 1 (smallest mean, then config id)."""
    g = results.groupBy("config", "params").agg(F.avg("rmse").alias("mean_rmse"),
                                                F.stddev_pop("rmse").alias("std_rmse"),
                                                F.count("*").alias("n_folds"))
    return g.withColumn("rank", F.row_number().over(Window.orderBy("mean_rmse", "config")))


# M09 / M10 -----------------------------------------------------------------
def refit(df: DataFrame, y: str, stages, estimator):
    """Fit the chosen configuration on all rows (train + test)."""
    return Pipeline(stages=list(stages) + [estimator]).fit(df.filter(F.col(y).isNotNull()))


def score_scenarios(model, df: DataFrame, keys=("period", "entity", "scenario"),
                    pred_log: str = "pred_log_model", pred: str = "pred_model") -> DataFrame:
    """One ``transform`` over the whole scenario panel; log predictions and
    their level back-transform, in long form."""
    out = model.transform(df)
    return out.select(*as_list(keys), F.col("prediction").alias(pred_log), F.exp("prediction").alias(pred))


# Python workers must not need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
