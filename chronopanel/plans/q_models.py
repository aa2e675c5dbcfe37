"""Registered modelling, forecasting and attribution queries."""

from __future__ import annotations

import uuid

from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import explain as X
from ..operators import forecast as FC
from ..operators import models as M
from ..operators import windows as W
from ..sources.files import load_features, load_model, save_model
from . import panels as P
from .registry import register

FEATURES = ["l1", "l12", "ls"]


def model_panel(t, complete: bool = False):
    """(period, entity, region, y = log price, l1, l12 = log price lags,
    ls = log order count) from the nation panel; ``complete`` drops rows
    with a missing lag (training rows)."""
    x = P.nation_lags(t)
    if complete:
        x = x.dropna(subset=["avg_price_lag1", "avg_price_lag12"])
    return x.select("period", "entity", "region", F.log("avg_price").alias("y"),
                    F.log("avg_price_lag1").alias("l1"), F.log("avg_price_lag12").alias("l12"),
                    F.log("sales_count").alias("ls"))


def scenario_features(t):
    """Scenario rows with model features: l1 = log of the previous month of
    the same scenario path, with history prepended for the first month (the
    corrected default; Spark trees reject missing features), l12 and ls
    from history."""
    fc = P.scenario_fc(t)
    w = Window.partitionBy("entity", "scenario").orderBy("period")
    fc = fc.withColumn("_l1p", F.lag("pred_log").over(w))
    h = model_panel(t).select("period", "entity", "region", F.col("l1").alias("_l1h"), "l12", "ls")
    x = fc.join(h, ["period", "entity"], "left")
    return x.withColumn("l1", F.coalesce("_l1p", "_l1h")).drop("_l1p", "_l1h").dropna(subset=FEATURES)


@register("ols_simple", "M01", ctes=["nation_lags"], digits={"coef": 6, "std_err": 6, "t_stat": 4}, sql="""
x AS (SELECT ln(avg_price) AS y, ln(avg_price_lag1) AS x FROM nation_lags WHERE avg_price_lag1 IS NOT NULL),
s AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a, regr_count(y, x) AS n, regr_sxx(y, x) AS sxx,
             regr_syy(y, x) AS syy, regr_sxy(y, x) AS sxy, regr_avgx(y, x) AS mx FROM x),
e AS (SELECT *, (syy - b * sxy) / (n - 2) AS s2 FROM s)
SELECT 'x' AS name, b AS coef, sqrt(s2 / sxx) AS std_err, b / sqrt(s2 / sxx) AS t_stat FROM e
UNION ALL SELECT 'const', a, sqrt(s2 * (1.0 / n + mx * mx / sxx)), a / sqrt(s2 * (1.0 / n + mx * mx / sxx)) FROM e""")
def ols_simple(t):
    x = P.nation_lags(t).select(F.log("avg_price").alias("y"), F.log("avg_price_lag1").alias("x"))
    return M.ols(x, "y", ["x"]).select("name", "coef", "std_err", "t_stat")


@register("ols", "M01")
def ols(t):
    return M.ols(model_panel(t), "y", FEATURES)


def lasso_panel(t):
    """(period, entity, y = log price, logs of lagged prices and counts)."""
    x = W.add_lags(P.nation_month(t).select("period", "entity", "avg_price", "sales_count"), "entity", "period",
                   ["avg_price", "sales_count"], [1, 2, 3, 6, 12])
    x = x.select("period", "entity", F.log("avg_price").alias("y"),
                 *[F.log(c).alias(c) for c in x.columns if "_lag" in c])
    return x


@register("lasso_select", "M02", materialize=["nation_month"])
def lasso_select(t):
    x = lasso_panel(t)
    return M.lasso_select(x, "y", [c for c in x.columns if "_lag" in c], order=["period", "entity"], n_splits=5, n_alphas=200)


# One feature: the coefficient is the covariance, shrunk by alpha, so the whole
# selection with its outer and inner folds has a closed form. Model 0 is the
# selection on all rows; models 1 to 5 are the outer training folds.
@register("lasso_single", "M02", materialize=["nation_month"], ctes=["nation_lags"], digits={
    "coef": 7, "alpha": 7, "cv_rmse_mean": 7, "cv_rmse_std": 7, "nested_rmse_mean": 7, "nested_rmse_std": 7}, sql="""
r AS (SELECT ln(avg_price) AS y, ln(avg_price_lag12) AS x, row_number() OVER (ORDER BY period, entity) - 1 AS i
      FROM nation_lags WHERE avg_price_lag12 IS NOT NULL),
c AS (SELECT count(*) AS n FROM r),
m AS (SELECT 0 AS m, n AS size, 5 AS k, n AS stop FROM c UNION ALL
      SELECT CAST(j AS INTEGER), n - (6 - j) * (n // 6), 3, n - (5 - j) * (n // 6) FROM c, range(1, 6) o(j)),
f AS (SELECT m, f, size - (k - f) * (size // (k + 1)) AS a, size - (k - f - 1) * (size // (k + 1)) AS b FROM m, range(5) g(f) WHERE f < k),
fs AS (SELECT m, avg(y) AS my, avg(x) AS mx, stddev_pop(x) AS sd, covar_pop(x, y) / stddev_pop(x) AS cov FROM m JOIN r ON i < size GROUP BY m),
al AS (SELECT m, j, pow(10, log10(abs(cov)) + (log10(abs(cov) * 0.001) - log10(abs(cov))) * j / 199.0) AS alpha FROM fs, range(200) g(j)),
tr AS (SELECT m, f, avg(y) AS my, avg(x) AS mx, stddev_pop(x) AS sd, covar_pop(x, y) / stddev_pop(x) AS cov FROM f JOIN r ON i < a GROUP BY m, f),
va AS (SELECT m, f, count(*) AS n, sum(y) AS sy, sum(x) AS sx, sum(x * y) AS sxy, sum(x * x) AS sxx, sum(y * y) AS syy
       FROM f JOIN r ON i >= a AND i < b GROUP BY m, f),
p AS (SELECT tr.m, tr.f, j, alpha, sign(cov) * greatest(abs(cov) - alpha, 0) / sd AS b, my, mx FROM tr JOIN al ON al.m = tr.m),
e AS (SELECT p.m, p.f, j, alpha, (syy - 2 * b * sxy - 2 * (my - mx * b) * sy + b * b * sxx + 2 * (my - mx * b) * b * sx + n * (my - mx * b) * (my - mx * b)) / n AS mse
      FROM p JOIN va ON va.m = p.m AND va.f = p.f),
best AS (SELECT m, arg_min(j, (mse, j)) AS j, arg_min(alpha, (mse, j)) AS alpha FROM (SELECT m, j, alpha, avg(mse) AS mse FROM e GROUP BY m, j, alpha) GROUP BY m),
cv AS (SELECT avg(sqrt(mse)) AS cv_rmse_mean, stddev_pop(sqrt(mse)) AS cv_rmse_std FROM e JOIN best ON best.m = e.m AND best.j = e.j WHERE e.m = 0),
nb AS (SELECT m.m, size, stop, my, mx, sign(cov) * greatest(abs(cov) - alpha, 0) / sd AS b FROM m JOIN fs ON fs.m = m.m JOIN best ON best.m = m.m WHERE m.m > 0),
ne AS (SELECT avg(e) AS nested_rmse_mean, stddev_pop(e) AS nested_rmse_std
       FROM (SELECT m, sqrt(avg((y - my - (x - mx) * b) * (y - my - (x - mx) * b))) AS e FROM nb JOIN r ON i >= size AND i < stop GROUP BY m))
SELECT 'avg_price_lag12' AS feature, sign(cov) * greatest(abs(cov) - alpha, 0) AS coef, alpha, cv_rmse_mean, cv_rmse_std, nested_rmse_mean, nested_rmse_std
FROM fs, best, cv, ne WHERE fs.m = 0 AND best.m = 0""")
def lasso_single(t):
    x = P.nation_lags(t).select("period", "entity", F.log("avg_price").alias("y"), F.log("avg_price_lag12").alias("avg_price_lag12"))
    out = M.lasso_select(x, "y", ["avg_price_lag12"], order=["period", "entity"], n_splits=5, n_alphas=200)
    return out.select("feature", "coef", "alpha", "cv_rmse_mean", "cv_rmse_std", "nested_rmse_mean", "nested_rmse_std")


@register("align_features", "M03 M04", ctes=["nation_lags"], digits={"avg_price_lag1": 6, "avg_price_lag12": 6}, sql="""
SELECT period, entity, avg_price_lag12, avg_price_lag1, 0.0::DOUBLE AS not_in_data FROM nation_lags""")
def align_features(t):
    x, absent = M.select_features(P.nation_lags(t), ["avg_price_lag1", "avg_price_lag12", "not_in_data"],
                                   keep=["period", "entity"])
    return M.align_features(x, ["avg_price_lag12", "avg_price_lag1", "not_in_data"], fill=0.0,
                            keep=["period", "entity"])


def _stages():
    return M.feature_pipeline(cat=["region"], num=FEATURES, scale=False)


_PANEL_SQL = """
mp AS (SELECT period, entity, region, ln(avg_price_lag1) AS l1, ln(avg_price_lag12) AS l12, ln(sales_count) AS ls
       FROM nation_lags WHERE avg_price_lag1 IS NOT NULL AND avg_price_lag12 IS NOT NULL),
reg AS (SELECT region, row_number() OVER (ORDER BY count(*) DESC, region) - 1 AS idx FROM mp GROUP BY region)"""


@register("feature_pipeline", "M05", ctes=["nation_lags"], digits={"l1": 6, "l12": 6, "ls": 6}, sql=_PANEL_SQL + """,
s AS (SELECT avg(l1) AS a1, stddev_samp(l1) AS d1, avg(l12) AS a2, stddev_samp(l12) AS d2, avg(ls) AS a3, stddev_samp(ls) AS d3 FROM mp)
SELECT period, entity, CAST(idx AS BIGINT) AS region_slot, CAST(1 + (SELECT count(*) FROM reg) + 3 AS BIGINT) AS n_slots,
       (l1 - a1) / d1 AS l1, (l12 - a2) / d2 AS l12, (ls - a3) / d3 AS ls
FROM mp JOIN reg ON reg.region = mp.region, s""")
def feature_pipeline(t):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    d = model_panel(t, complete=True)
    model = Pipeline(stages=M.feature_pipeline(cat=["region"], num=FEATURES, scale=True)).fit(d)
    out = model.transform(d).select("period", "entity", vector_to_array("features").alias("v"))
    scaled = [F.element_at("v", i - len(FEATURES)).alias(c) for i, c in enumerate(FEATURES)]
    return out.select("period", "entity", (F.array_position("v", F.lit(1.0)) - 1).alias("region_slot"),
                      F.size("v").cast("bigint").alias("n_slots"), *scaled)


@register("feature_map", "P36 M05", ctes=["nation_lags"], sql=_PANEL_SQL + """,
n AS (SELECT count(*) AS k FROM reg)
SELECT CAST(idx AS BIGINT) AS "index", 'region_oh_' || region AS name, 'binary' AS kind FROM reg
UNION ALL SELECT CAST(k AS BIGINT), 'region_oh___unknown', 'binary' FROM n
UNION ALL SELECT CAST(k + 1 + i AS BIGINT), ['l1', 'l12', 'ls'][i + 1], 'numeric' FROM n, range(3) r(i)""")
def feature_map(t):
    from pyspark.ml import Pipeline
    d = model_panel(t, complete=True)
    model = Pipeline(stages=_stages()).fit(d)
    return M.feature_map(model.transform(d), "features")


@register("tune_forest", "M06 M08 W12")
def tune_forest(t):
    res = M.tune_forest(model_panel(t, complete=True), "y", _stages(), {"numTrees": [10, 20], "maxDepth": [4]},
                        n_splits=3, min_train=36, val=6)
    return M.cv_table(res)


@register("tune_gbt", "M07 M08 W12")
def tune_gbt(t):
    res = M.tune_gbt(model_panel(t, complete=True), "y", _stages(), {"maxIter": [10, 20], "maxDepth": [3], "stepSize": [0.1]},
                     n_splits=3, min_train=36, val=6)
    return M.cv_table(res)


FOREST_GRID = {"numTrees": [5, 10, 20], "maxDepth": [2, 4, 8], "minSplit": [2, 10], "minInstancesPerNode": [1, 4],
               "featureSubsetStrategy": ["sqrt", "all"]}
BOOST_GRID = {"maxIter": [3, 6, 9], "maxDepth": [2, 3], "stepSize": [0.1, 0.3]}
_FOLD_SQL = """
p AS (SELECT period, entity, avg_price FROM nation_lags WHERE avg_price_lag1 IS NOT NULL AND avg_price_lag12 IS NOT NULL),
pos AS (SELECT period, row_number() OVER (ORDER BY period) - 1 AS i, count(*) OVER () AS total FROM (SELECT DISTINCT period FROM p)),
f AS (SELECT CAST(f AS BIGINT) AS fold, CASE WHEN f = 2 THEN max(total) - 6 ELSE CAST(floor(36 + (max(total) - 6 - 36) / 2.0 * f) AS BIGINT) END AS train_end
      FROM pos, range(3) r(f) GROUP BY f)
SELECT CAST(c AS BIGINT) AS config, fold, CAST(count(*) AS BIGINT) AS n_val, sum(ln(avg_price)) AS y_sum, 0.0::DOUBLE AS rest
FROM range({configs}) g(c), f JOIN pos ON i >= train_end AND i < train_end + 6 JOIN p USING (period) GROUP BY c, fold"""


def _staged(t, kind, grid):
    return M.staged_grid(model_panel(t, complete=True), "y", _stages(), kind, grid, keys=["period", "entity"], n_splits=3, min_train=36, val=6)


def _fold_check(t, kind, grid):
    """Rows and log prices of every setting's validation folds, and how far the
    reported error is from one taken over the stored predictions."""
    from ..session import checkpoint_dir
    checkpoint_dir(t.spark)
    pred = _staged(t, kind, grid).checkpoint(eager=True)
    said = M.fold_errors(pred, "y")
    again = pred.groupBy("config", "fold").agg(F.sum("y").alias("y_sum"), F.sqrt(F.sum(F.pow(F.col("pred") - F.col("y"), 2)) / F.count("pred")).alias("_again"))
    return said.join(again, ["config", "fold"]).select(
        "config", "fold", "n_val", "y_sum", F.abs(F.round(F.col("rmse") - F.col("_again"), 9)).alias("rest"))


@register("staged_forest", "M06 M08 W12", materialize=["nation_month"], ctes=["nation_lags"], digits={"y_sum": 5}, sql=_FOLD_SQL.format(configs=72))
def staged_forest(t):
    """72 settings x 3 folds from 12 fits."""
    return _fold_check(t, "forest", FOREST_GRID)


@register("staged_gbt", "M07 M08 W12", materialize=["nation_month"], ctes=["nation_lags"], digits={"y_sum": 5}, sql=_FOLD_SQL.format(configs=12))
def staged_gbt(t):
    """12 settings x 3 folds from 12 fits."""
    return _fold_check(t, "gbt", BOOST_GRID)


# One tree of one split, of month number and year (fewer distinct values than
# bins, so every midpoint is tried): the split feature's value is the side's
# mean less the mean of all rows, the other feature's is 0.
@register("tree_shap_stump", "M14", materialize=["nation_month"], ctes=["nation_month"], digits={"shap_value": 6, "pred": 6, "base_value": 6}, sql="""
d AS (SELECT period, entity, ln(avg_price) AS y, month(period)::DOUBLE AS mon, year(period)::DOUBLE AS yr FROM nation_month),
v AS (SELECT 'mon' AS f, mon AS x, y FROM d UNION ALL SELECT 'yr', yr, y FROM d),
g AS (SELECT f, x, count(*) AS n, sum(y) AS s FROM v GROUP BY f, x),
c AS (SELECT f, (x + lead(x) OVER w) / 2 AS cut, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER (PARTITION BY f) AS n, sum(s) OVER (PARTITION BY f) AS s
      FROM g WINDOW w AS (PARTITION BY f ORDER BY x)),
b AS (SELECT f, cut, sl / nl AS l, (s - sl) / (n - nl) AS r, s / n AS base FROM c WHERE cut IS NOT NULL ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC LIMIT 1),
p AS (SELECT period, entity, base, CASE WHEN CASE f WHEN 'mon' THEN mon ELSE yr END <= cut THEN l ELSE r END AS pred, f FROM d, b)
SELECT period, entity, k AS feature, CASE WHEN k = f THEN pred - base ELSE 0 END AS shap_value, pred, base AS base_value
FROM p, (VALUES ('mon'), ('yr')) n(k)""")
def tree_shap_stump(t):
    d = P.nation_month(t).select("period", "entity", F.log("avg_price").alias("y"), F.month("period").cast("double").alias("mon"),
                                 F.year("period").cast("double").alias("yr"))
    est = RandomForestRegressor(featuresCol="features", labelCol="y", numTrees=1, maxDepth=1, featureSubsetStrategy="all", bootstrap=False, seed=1)
    model = M.refit(d, "y", M.feature_pipeline(num=["mon", "yr"]), est)
    return X.tree_shap(model.stages[-1], model.transform(d), ["period", "entity"]).select(
        "period", "entity", "feature", "shap_value", "pred", "base_value")


def _forest(t, num_trees=20, depth=4):
    d = model_panel(t, complete=True).filter(F.col("y").isNotNull())
    est = RandomForestRegressor(featuresCol="features", labelCol="y", numTrees=num_trees, maxDepth=depth, seed=42)
    return M.refit(d, "y", _stages(), est)


@register("score_scenarios", "M09 M10", materialize=["nation_month"])
def score_scenarios(t):
    model = _forest(t)
    return M.score_scenarios(model, scenario_features(t))


@register("tree_shap", "M14", materialize=["nation_month"])
def tree_shap(t):
    model = _forest(t)
    scored = model.transform(scenario_features(t))
    return X.tree_shap(model.stages[-1], scored, ["period", "entity", "scenario"])


@register("tree_shap_additivity", "M14", materialize=["nation_month"], ctes=["scenario_fc", "nation_lags"], sql="""
w AS (SELECT period, entity, scenario, lag(pred_log) OVER (PARTITION BY entity, scenario ORDER BY period) AS l1p FROM scenario_fc),
h AS (SELECT period, entity, avg_price_lag1, avg_price_lag12, sales_count FROM nation_lags)
SELECT w.period, w.entity, w.scenario, 0.0::DOUBLE AS rest, CAST(count(*) OVER () AS BIGINT) AS n_rows
FROM w JOIN h ON h.period = w.period AND h.entity = w.entity
WHERE coalesce(l1p, ln(avg_price_lag1)) IS NOT NULL AND avg_price_lag12 IS NOT NULL AND sales_count IS NOT NULL""")
def tree_shap_additivity(t):
    """What the attributions of a row leave of its prediction: nothing."""
    g = tree_shap(t).groupBy("period", "entity", "scenario").agg(
        F.abs(F.round(F.first("pred") - F.first("base_value") - F.sum("shap_value"), 6)).alias("rest"))
    return g.withColumn("n_rows", g.select(F.count("*")).scalar())


@register("bvar_forecast", "M12 W03 W07", materialize=["nation_month"])
def bvar_forecast(t):
    nm = P.nation_month(t).select("period", "entity", "avg_price", "sales_count")
    nm = W.log_return(nm, "entity", "period", "avg_price", out="dlog_price")
    nm = nm.withColumn("log_sales", F.log("sales_count"))
    fc = FC.bvar_forecast(nm, "entity", "period", ["dlog_price", "log_sales"], p=2, horizon=12)
    last = nm.groupBy("entity").agg(F.max_by("avg_price", "period").alias("anchor"))
    fc = fc.join(last, "entity")
    return W.levels_from_dlog(fc, "entity", "period", "dlog_price", "anchor", out="price_level").drop("anchor")


@register("seasonal_grid", "M13", materialize=["nation_month"])
def seasonal_grid(t):
    nm = P.nation_month(t).groupBy("period", "region").agg(F.sum("sales_count").cast("double").alias("sales"))
    res, _ = FC.seasonal_grid(nm, "region", "period", "sales", horizon=12)
    return res


@register("seasonal_forecast", "M13 U09", materialize=["nation_month"])
def seasonal_forecast(t):
    nm = P.nation_month(t).groupBy("period", "region").agg(F.sum("sales_count").cast("double").alias("sales"))
    _, fc = FC.seasonal_grid(nm, "region", "period", "sales", horizon=12)
    return fc


WALK = [((0, 1, 0), (0, 1, 0, 12))]
# Twelve months of the seasonal random walk with drift: the differences'
# constant c gives y[T+h] = y[T+h-12] + (y[T] - y[T-12]) + c h.
_REGION_SQL = """
s AS (SELECT region, period, sum(sales_count)::DOUBLE AS x, sum(total_price) AS y,
             row_number() OVER (PARTITION BY region ORDER BY period) AS t FROM nation_month GROUP BY region, period),
z AS (SELECT region, t, x - lag(x, 1) OVER w - lag(x, 12) OVER w + lag(x, 13) OVER w AS zx,
             y - lag(y, 1) OVER w - lag(y, 12) OVER w + lag(y, 13) OVER w AS zy FROM s WINDOW w AS (PARTITION BY region ORDER BY t)),
l AS (SELECT region, max(t) AS T, max(period) AS last FROM s GROUP BY region),
wx AS (SELECT region, avg(zx) AS c, var_pop(zx) AS v, count(zx) AS n FROM z WHERE zx IS NOT NULL GROUP BY region),
fx AS (SELECT l.region, h, CAST(l.last + to_months(CAST(h AS INTEGER)) AS DATE) AS period, a.x + b.x - d.x + wx.c * h AS f, v, n
       FROM l JOIN wx USING (region) CROSS JOIN range(1, 13) r(h) JOIN s a ON a.region = l.region AND a.t = l.T - 12 + h
       JOIN s b ON b.region = l.region AND b.t = l.T JOIN s d ON d.region = l.region AND d.t = l.T - 12)"""


def region_series(t):
    """(period, region, sales, revenue) by month."""
    return P.nation_month(t).groupBy("period", "region").agg(
        F.sum("sales_count").cast("double").alias("sales"), F.sum("total_price").alias("revenue"))


@register("seasonal_walk", "M13 U09", materialize=["nation_month"], ctes=["nation_month"], digits={"forecast": 4, "bic": 5}, sql=_REGION_SQL + """
SELECT region, period, f AS forecast, n * (ln(2 * pi() * v) + 1) + 2 * ln(n) AS bic, CAST(n AS BIGINT) AS nobs FROM fx""")
def seasonal_walk(t):
    """The grid's simplest order, whose fit and forecast have a closed form."""
    res, fc = FC.seasonal_grid(region_series(t), "region", "period", "sales", orders=WALK, horizon=12)
    return fc.select("region", "period", "forecast").join(res.select("region", "bic", "nobs"), "region")


@register("seasonal_chain", "M13 U09", materialize=["nation_month"])
def seasonal_chain(t):
    """Two-stage forecast over the whole grid: order counts first, then
    revenue with the counts as regressor."""
    _, fc = FC.driver_chain(region_series(t), "region", "period", "sales", "revenue", horizon=12)
    return fc


@register("seasonal_chain_walk", "M13 U09", materialize=["nation_month"], ctes=["nation_month"],
          digits={"sales_forecast": 4, "revenue_forecast": 3, "beta": 5, "bic": 5}, sql=_REGION_SQL + """,
wy AS (SELECT region, regr_slope(zy, zx) AS b, regr_intercept(zy, zx) AS c, (regr_syy(zy, zx) - regr_slope(zy, zx) * regr_sxy(zy, zx)) / regr_count(zy, zx) AS v
       FROM z WHERE zx IS NOT NULL GROUP BY region),
u AS (SELECT s.region, t, y - b * x AS u FROM s JOIN wy USING (region))
SELECT fx.region, fx.period, fx.f AS sales_forecast, wy.b * fx.f + a.u + p.u - q.u + wy.c * h AS revenue_forecast, wy.b AS beta,
       n * (ln(2 * pi() * wy.v) + 1) + 3 * ln(n) AS bic
FROM fx JOIN wy ON wy.region = fx.region JOIN l ON l.region = fx.region JOIN u a ON a.region = l.region AND a.t = l.T - 12 + h
     JOIN u p ON p.region = l.region AND p.t = l.T JOIN u q ON q.region = l.region AND q.t = l.T - 12""")
def seasonal_chain_walk(t):
    """The two-stage forecast with the order that has a closed form."""
    grid, fc = FC.driver_chain(region_series(t), "region", "period", "sales", "revenue", orders=WALK, horizon=12)
    return fc.drop("pdq", "pdqs").join(grid.select("region", F.get("beta", F.lit(0)).alias("beta"), "bic"), "region")


# Least squares on one feature: the fitted, saved and scored model has a closed form.
_LINE_SQL = """
x AS (SELECT ln(avg_price) AS y, ln(avg_price_lag1) AS x FROM nation_lags WHERE avg_price_lag1 IS NOT NULL AND avg_price_lag12 IS NOT NULL),
m AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM x)"""


def _line(t):
    est = LinearRegression(featuresCol="features", labelCol="y", solver="normal", regParam=0.0)
    return M.refit(model_panel(t, complete=True), "y", M.feature_pipeline(num=["l1"]), est)


@register("saved_model", "S11 M04", materialize=["nation_month"], ctes=["nation_lags"], digits={"pred": 6}, sql=_LINE_SQL + """
SELECT period, entity, a + b * ln(avg_price_lag1) AS pred, 'l1' AS features FROM nation_lags, m WHERE avg_price_lag1 IS NOT NULL""")
def saved_model(t):
    """A model is saved with its feature list, loaded again, and scores rows
    whose columns are aligned to that list."""
    from ..session import checkpoint_dir
    path = f"{checkpoint_dir(t.spark).rstrip('/')}/saved-model-{uuid.uuid4().hex}"
    save_model(_line(t), path, features=["l1"])
    features = load_features(t.spark, path)
    rows = M.align_features(model_panel(t).drop("y").dropna(subset=["l1"]), features, fill=None, keep=["period", "entity"])
    return load_model(path).transform(rows).select("period", "entity", F.col("prediction").alias("pred"), F.lit(",".join(features)).alias("features"))


@register("score_scenarios_line", "M09 M10", materialize=["nation_month"], ctes=["scenario_fc", "nation_lags"], digits={"pred_log_model": 6, "pred_model": 3},
          sql=_LINE_SQL + """,
w AS (SELECT period, entity, scenario, lag(pred_log) OVER (PARTITION BY entity, scenario ORDER BY period) AS l1p FROM scenario_fc),
h AS (SELECT period, entity, avg_price_lag1, avg_price_lag12, sales_count FROM nation_lags),
p AS (SELECT w.period, w.entity, w.scenario, a + b * coalesce(l1p, ln(avg_price_lag1)) AS v FROM w JOIN h ON h.period = w.period AND h.entity = w.entity, m
      WHERE coalesce(l1p, ln(avg_price_lag1)) IS NOT NULL AND avg_price_lag12 IS NOT NULL AND sales_count IS NOT NULL)
SELECT period, entity, scenario, v AS pred_log_model, exp(v) AS pred_model FROM p""")
def score_scenarios_line(t):
    """Refit on all rows, then one pass over all scenarios, with the level
    back-transform."""
    return M.score_scenarios(_line(t), scenario_features(t))


# One variable, one lag: normal equations of two unknowns with the prior's
# precisions 0.01 (constant) and 1 / 0.18^2 (own lag, prior mean 1).
@register("bvar_single", "M12", materialize=["nation_month"], ctes=["nation_month"], digits={"log_sales": 7}, sql="""
d AS (SELECT entity, period, ln(sales_count) AS y, lag(ln(sales_count)) OVER (PARTITION BY entity ORDER BY period) AS x FROM nation_month),
s AS (SELECT entity, count(x) + 0.01 AS n, sum(x) AS sx, sum(x * x) + 1 / (0.18 * 0.18) AS sxx, sum(y) FILTER (x IS NOT NULL) AS sy,
             sum(x * y) + 1 / (0.18 * 0.18) AS sxy, max(period) AS last, arg_max(y, period) AS y0 FROM d GROUP BY entity),
b AS (SELECT entity, last, y0, (n * sxy - sx * sy) / (n * sxx - sx * sx) AS b, (sxx * sy - sx * sxy) / (n * sxx - sx * sx) AS a FROM s)
SELECT entity, h AS step, CAST(last + to_months(CAST(h AS INTEGER)) AS DATE) AS period, pow(b, h) * y0 + a * (1 - pow(b, h)) / (1 - b) AS log_sales
FROM b, range(1, 7) r(h)""")
def bvar_single(t):
    nm = P.nation_month(t).select("period", "entity", F.log("sales_count").alias("log_sales"))
    return FC.bvar_forecast(nm, "entity", "period", ["log_sales"], p=1, horizon=6)


# Normal equations of three regressors through the inverse of their centred
# cross products.
@register("ols_three", "M01", materialize=["nation_month"], ctes=["nation_lags"], digits={"coef": 6, "std_err": 6, "t_stat": 4}, sql="""
x AS (SELECT ln(avg_price) AS y, ln(avg_price_lag1) AS p, ln(avg_price_lag12) AS q, ln(sales_count) AS r FROM nation_lags
      WHERE avg_price_lag1 IS NOT NULL AND avg_price_lag12 IS NOT NULL),
s AS (SELECT count(*) AS n, avg(y) AS my, avg(p) AS mp, avg(q) AS mq, avg(r) AS mr, count(*) * var_pop(y) AS yy,
             count(*) * covar_pop(p, y) AS py, count(*) * covar_pop(q, y) AS qy, count(*) * covar_pop(r, y) AS ry,
             count(*) * var_pop(p) AS pp, count(*) * var_pop(q) AS qq, count(*) * var_pop(r) AS rr,
             count(*) * covar_pop(p, q) AS pq, count(*) * covar_pop(p, r) AS pr, count(*) * covar_pop(q, r) AS qr FROM x),
d AS (SELECT *, pp * (qq * rr - qr * qr) - pq * (pq * rr - qr * pr) + pr * (pq * qr - qq * pr) AS det FROM s),
i AS (SELECT *, (qq * rr - qr * qr) / det AS ipp, (pp * rr - pr * pr) / det AS iqq, (pp * qq - pq * pq) / det AS irr,
             (pr * qr - pq * rr) / det AS ipq, (pq * qr - pr * qq) / det AS ipr, (pq * pr - pp * qr) / det AS iqr FROM d),
b AS (SELECT *, ipp * py + ipq * qy + ipr * ry AS bp, ipq * py + iqq * qy + iqr * ry AS bq, ipr * py + iqr * qy + irr * ry AS br FROM i),
e AS (SELECT *, (yy - bp * py - bq * qy - br * ry) / (n - 4) AS s2, my - bp * mp - bq * mq - br * mr AS b0,
             1.0 / n + mp * mp * ipp + mq * mq * iqq + mr * mr * irr + 2 * (mp * mq * ipq + mp * mr * ipr + mq * mr * iqr) AS i0 FROM b),
c AS (SELECT unnest(['l1', 'l12', 'ls', 'const']) AS name, unnest([bp, bq, br, b0]) AS coef, unnest([sqrt(s2 * ipp), sqrt(s2 * iqq), sqrt(s2 * irr), sqrt(s2 * i0)]) AS std_err FROM e)
SELECT name, coef, std_err, coef / std_err AS t_stat FROM c""")
def ols_three(t):
    return M.ols(model_panel(t), "y", FEATURES).select("name", "coef", "std_err", "t_stat")
