"""Registered aggregation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggs as A
from ..operators import windows as W
from ..operators.reshape import time_split
from . import panels as P
from .registry import register

D6 = 6


@register("collapse_series", "A01", ctes=["nation_month"], digits={"total_price": 2, "avg_price": D6}, sql="""
SELECT period, CAST(coalesce(sum(sales_count), 0) AS BIGINT) AS sales_count, coalesce(sum(total_price), 0) AS total_price,
       avg(avg_price) AS avg_price
FROM nation_month GROUP BY period""")
def collapse_series(t):
    return A.collapse(P.nation_month(t), "period", ["sales_count", "total_price", "avg_price"],
                      {"sales_count": "sum", "total_price": "sum", "avg_price": "mean"})


@register("collapse_first_median", "A01", ctes=["nation_month"], digits={"avg_price": D6, "sales_count": D6, "total_price": 2}, sql="""
SELECT period, arg_min(avg_price, entity) AS avg_price, quantile_cont(sales_count, 0.5) AS sales_count, max(total_price) AS total_price
FROM nation_month GROUP BY period""")
def collapse_first_median(t):
    return A.collapse(P.nation_month(t), "period", ["avg_price", "sales_count", "total_price"],
                      {"avg_price": "first", "sales_count": "median", "total_price": "max"}, order="entity")


@register("series_median", "A02", ctes=["nation_month"], digits={"avg_price": D6}, sql="""
SELECT period, region, quantile_cont(avg_price, 0.5) AS avg_price FROM nation_month GROUP BY 1, 2""")
def series_median(t):
    return A.series_by(P.nation_month(t), ["period", "region"], "avg_price", "median")


@register("series_first", "A02", ctes=["nation_month"], digits={"avg_price": D6}, sql="""
SELECT region, arg_min(avg_price, period) AS avg_price
FROM (SELECT region, period, avg(avg_price) AS avg_price FROM nation_month GROUP BY 1, 2) GROUP BY region""")
def series_first(t):
    s = A.series_by(P.nation_month(t), ["region", "period"], "avg_price", "mean")
    return A.series_by(s, ["region"], "avg_price", "first", order="period")


@register("trailing_shares", "A03", materialize=["nation_month"], ctes=["nation_month"], digits={"share": 12}, sql="""
r AS (SELECT * FROM nation_month
      WHERE period >= CAST((SELECT max(period) FROM nation_month) - INTERVAL 11 MONTH AS DATE))
SELECT entity, sum(sales_count) / (SELECT sum(sales_count) FROM r) AS share FROM r GROUP BY entity""")
def trailing_shares(t):
    return A.trailing_shares(P.nation_month(t), "period", "entity", "sales_count", 12)


@register("winsorized_mean", "A04", digits={"winsorized_mean": 4}, sql="""
q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.05) AS lo, quantile_cont(l_extendedprice, 0.95) AS hi
      FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY 1)
SELECT l.l_returnflag, avg(greatest(q.lo, least(q.hi, l.l_extendedprice))) AS winsorized_mean
FROM lineitem l JOIN q ON l.l_returnflag = q.l_returnflag WHERE l.l_extendedprice IS NOT NULL GROUP BY 1""")
def winsorized_mean(t):
    return A.winsorized_mean(t("lineitem"), "l_extendedprice", 0.05, by=["l_returnflag"])


@register("trimmed_mean", "A05", digits={"trimmed_mean": 4}, sql="""
q AS (SELECT l_linestatus, quantile_cont(l_extendedprice, 0.1) AS lo, quantile_cont(l_extendedprice, 0.9) AS hi
      FROM lineitem GROUP BY 1)
SELECT l.l_linestatus, avg(CASE WHEN l.l_extendedprice BETWEEN q.lo AND q.hi THEN l.l_extendedprice END) AS trimmed_mean
FROM lineitem l JOIN q ON l.l_linestatus = q.l_linestatus WHERE l.l_extendedprice IS NOT NULL GROUP BY 1""")
def trimmed_mean(t):
    return A.trimmed_mean(t("lineitem"), "l_extendedprice", 0.1, by=["l_linestatus"])


_DESC_COLS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _describe_sql():
    parts = []
    for c in _DESC_COLS:
        parts.append(f"""SELECT '{c}' AS "column", count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std,
       CAST(min({c}) AS DOUBLE) AS min, quantile_cont({c}, 0.01) AS p1, quantile_cont({c}, 0.05) AS p5,
       quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.95) AS p95, quantile_cont({c}, 0.99) AS p99,
       CAST(max({c}) AS DOUBLE) AS max FROM lineitem""")
    return "\nUNION ALL\n".join(parts)


@register("describe_numeric", "A06", digits={c: 4 for c in ("mean", "std", "min", "p1", "p5", "p50", "p95", "p99", "max")},
          sql=_describe_sql())
def describe_numeric(t):
    return A.describe_numeric(t("lineitem"), list(_DESC_COLS))


@register("group_stats", "A07", digits={c: 4 for c in ("mean", "median", "std", "min", "max", "q25", "q75", "iqr")} | {"cv": 9},
          sql="""
SELECT o_orderpriority, count(*) AS n, avg(o_totalprice) AS mean, quantile_cont(o_totalprice, 0.5) AS median,
       stddev_samp(o_totalprice) AS std, min(o_totalprice) AS min, max(o_totalprice) AS max,
       quantile_cont(o_totalprice, 0.25) AS q25, quantile_cont(o_totalprice, 0.75) AS q75,
       quantile_cont(o_totalprice, 0.75) - quantile_cont(o_totalprice, 0.25) AS iqr,
       CASE WHEN avg(o_totalprice) <> 0 THEN stddev_samp(o_totalprice) / avg(o_totalprice) END AS cv
FROM orders WHERE o_totalprice IS NOT NULL AND o_orderpriority IS NOT NULL GROUP BY 1""")
def group_stats(t):
    return A.group_stats(t("orders"), "o_orderpriority", "o_totalprice")


@register("skewness_g1", "A08", digits={"skewness": 9}, sql="\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", CASE WHEN count({c}) >= 3 THEN skewness({c}) END AS skewness FROM lineitem"""
    for c in _DESC_COLS))
def skewness_g1(t):
    return A.skewness_g1(t("lineitem"), list(_DESC_COLS))


def _corr_sql():
    cols = list(_DESC_COLS)
    parts = []
    for i, a in enumerate(cols):
        for b in cols:
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS corr FROM lineitem")
    return "\nUNION ALL\n".join(parts)


@register("corr_matrix", "A09", digits={"corr": 9}, sql=_corr_sql())
def corr_matrix(t):
    return A.corr_matrix(t("lineitem"), list(_DESC_COLS))


@register("missing_summary", "A10", ctes=["nation_lags"], digits={"missing_pct": 9}, sql="\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", CAST(count_if({c} IS NULL{" OR isnan(" + c + ")" if d else ""}) AS BIGINT) AS missing_count,
       count_if({c} IS NULL{" OR isnan(" + c + ")" if d else ""}) / count(*) AS missing_pct FROM nation_lags"""
    for c, d in (("period", 0), ("entity", 0), ("region", 0), ("avg_price", 1), ("sales_count", 0),
                 ("total_price", 1), ("avg_price_high", 1), ("avg_price_low", 1), ("avg_price_lag1", 1),
                 ("avg_price_lag12", 1))))
def missing_summary(t):
    return A.missing_summary(P.nation_lags(t))


@register("overview", "A11", sql="""
x AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS period, l_returnflag, l_linestatus FROM lineitem)
SELECT count(*) AS rows, CAST(3 AS BIGINT) AS cols, min(period) AS period_min, max(period) AS period_max,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM x)) AS duplicate_rows FROM x""")
def overview(t):
    x = t("lineitem").select(P.month_of("l_shipdate").alias("period"), "l_returnflag", "l_linestatus")
    return A.overview(x, "period")


@register("regression_metrics", "A12", ctes=["nation_lags"], digits={
    "rmse_log": 9, "mae_log": 9, "r2_log": 9, "rmse_level": 3, "mae_level": 3, "r2_level": 9}, sql="""
x AS (SELECT region, ln(avg_price) AS y, ln(avg_price_lag1) AS yhat FROM nation_lags
      WHERE avg_price_lag1 IS NOT NULL)
SELECT region, count(*) AS n,
       sqrt(avg((y - yhat) * (y - yhat))) AS rmse_log, avg(abs(y - yhat)) AS mae_log,
       1 - sum((y - yhat) * (y - yhat)) / (count(y - yhat) * var_pop(y)) AS r2_log,
       sqrt(avg((exp(y) - exp(yhat)) * (exp(y) - exp(yhat)))) AS rmse_level, avg(abs(exp(y) - exp(yhat))) AS mae_level,
       1 - sum((exp(y) - exp(yhat)) * (exp(y) - exp(yhat))) / (count(exp(y) - exp(yhat)) * var_pop(exp(y))) AS r2_level
FROM x GROUP BY region""")
def regression_metrics(t):
    x = P.nation_lags(t).select("region", F.log("avg_price").alias("y"), F.log("avg_price_lag1").alias("yhat"))
    return A.regression_metrics(x, "y", "yhat", by=["region"])


@register("benchmark_profile", "A13 J06 W03", ctes=["nation_month", "market_month"], digits={
    "avg_ratio": 9, "median_ratio": 9, "volatility": 9, "corr_log_return": 9}, sql="""
b AS (SELECT period, avg_price AS b, ln(avg_price) - lag(ln(avg_price)) OVER (ORDER BY period) AS blr FROM market_month),
j AS (SELECT e.entity, e.period, e.avg_price AS v, b.b, b.blr,
             ln(e.avg_price) - lag(ln(e.avg_price)) OVER (PARTITION BY e.entity ORDER BY e.period) AS lr
      FROM nation_month e JOIN b ON e.period = b.period),
g AS (SELECT entity, count(*) AS n_common, avg(v / b) AS avg_ratio, quantile_cont(v / b, 0.5) AS median_ratio,
             stddev_samp(lr) AS volatility, count_if(lr IS NOT NULL AND blr IS NOT NULL) AS np, corr(lr, blr) AS c
      FROM j GROUP BY entity)
SELECT entity, n_common, avg_ratio, median_ratio, volatility, CASE WHEN np >= 6 THEN c END AS corr_log_return
FROM g WHERE n_common >= 6""")
def benchmark_profile(t):
    return A.benchmark_profile(P.nation_month(t), P.market_month(t), "period", "entity", "avg_price", "avg_price")


@register("investment_metrics", "A14 W05 W06", materialize=["nation_month"], ctes=["scenario_fc"], digits={
    "current_price_base": 4, "forecast_price_base_h": 4, "expected_return_base": 9, "volatility_base": 9,
    "downside_max_drawdown_low": 9, "scenario_spread_high_minus_low": 4, "stability_score": 9, "expected_return_base_pct": 2,
    "downside_max_drawdown_low_pct": 2}, sql="""
x AS (SELECT entity, period, lower(trim(scenario)) AS sc, pred AS p FROM scenario_fc),
a AS (SELECT entity, coalesce(min(CASE WHEN sc = 'base' THEN period END), min(period)) AS anchor FROM x GROUP BY 1),
w AS (SELECT x.*, a.anchor FROM x JOIN a ON x.entity = a.entity
      WHERE x.period >= a.anchor AND x.period <= CAST(a.anchor + INTERVAL 12 MONTH AS DATE)),
r AS (SELECT *, p / lag(p) OVER (PARTITION BY entity, sc ORDER BY period) - 1 AS ret,
             p / max(p) OVER (PARTITION BY entity, sc ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 AS dd
      FROM w),
g AS (SELECT entity, min(anchor) AS anchor, count_if(sc = 'base') AS nb, count_if(sc = 'low') AS nl,
             arg_min(p, period) FILTER (WHERE sc = 'base') AS p0, arg_max(p, period) FILTER (WHERE sc = 'base') AS pt,
             stddev_samp(ret) FILTER (WHERE sc = 'base') AS vol, count(ret) FILTER (WHERE sc = 'base') AS nr,
             min(dd) FILTER (WHERE sc = 'low') AS dd,
             arg_max(p, period) FILTER (WHERE sc = 'high') AS hi_last, arg_max(p, period) FILTER (WHERE sc = 'low') AS lo_last
      FROM r GROUP BY entity)
SELECT entity, strftime(anchor, '%Y-%m') AS anchor_month, CAST(12 AS BIGINT) AS horizon_months,
       p0 AS current_price_base, pt AS forecast_price_base_h,
       CASE WHEN p0 <> 0 THEN (pt - p0) / p0 END AS expected_return_base,
       CASE WHEN nr >= 2 THEN vol END AS volatility_base,
       CASE WHEN nl >= 2 THEN dd END AS downside_max_drawdown_low,
       hi_last - lo_last AS scenario_spread_high_minus_low,
       CASE WHEN nr >= 2 AND vol > 0 THEN (CASE WHEN p0 <> 0 THEN (pt - p0) / p0 END) / vol END AS stability_score,
       round_even(CASE WHEN p0 <> 0 THEN (pt - p0) / p0 END * 100, 2) AS expected_return_base_pct,
       round_even(CASE WHEN nl >= 2 THEN dd END * 100, 2) AS downside_max_drawdown_low_pct
FROM g WHERE nb >= 2""")
def investment_metrics(t):
    return A.investment_metrics(P.scenario_fc(t))


@register("top_drivers", "A15", materialize=["nation_month"], ctes=["attrib_long"], digits={"magnitude": 9, "shap_mean": 9}, sql="""
g AS (SELECT entity, scenario, trim(feature) AS feature, avg(abs_shap) AS magnitude, avg(shap_value) AS shap_mean
      FROM attrib_long WHERE abs_shap IS NOT NULL GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY entity, scenario ORDER BY magnitude DESC, feature) AS rank FROM g)
SELECT entity, scenario, feature, magnitude, shap_mean, CAST(rank AS BIGINT) AS rank,
       CASE WHEN shap_mean > 0 THEN 'up' WHEN shap_mean < 0 THEN 'down' END AS direction
FROM r WHERE rank <= 5""")
def top_drivers(t):
    return A.top_drivers(P.attrib_long(t), k=5, keys=["entity", "scenario"])


@register("horizon_drivers", "A16", materialize=["nation_month"], ctes=["attrib_long"], digits={"mean_shap": 9, "mean_abs_shap": 9}, sql="""
g AS (SELECT entity, scenario, feature, avg(shap_value) AS mean_shap, avg(abs(shap_value)) AS mean_abs_shap
      FROM attrib_long GROUP BY 1, 2, 3),
s AS (SELECT *, CASE WHEN mean_shap > 0 THEN 'up' WHEN mean_shap < 0 THEN 'down' END AS side FROM g),
r AS (SELECT *, row_number() OVER (PARTITION BY entity, scenario, side ORDER BY CASE WHEN side = 'up' THEN -mean_abs_shap ELSE mean_shap END, feature) AS rank
      FROM s WHERE side IS NOT NULL)
SELECT entity, scenario, feature, mean_shap, mean_abs_shap, side, CAST(rank AS BIGINT) AS rank FROM r WHERE rank <= 3""")
def horizon_drivers(t):
    return A.horizon_drivers(P.attrib_long(t), ["entity", "scenario"], k=3)


@register("rank_entities", "A17", materialize=["nation_month"], ctes=["scenario_fc"], digits={"score": 4}, sql="""
SELECT entity, avg(pred) AS score FROM scenario_fc WHERE scenario = 'base'
GROUP BY entity HAVING avg(pred) IS NOT NULL ORDER BY score DESC, entity LIMIT 5""")
def rank_entities(t):
    fc = P.scenario_fc(t).filter(F.col("scenario") == "base")
    return A.rank_entities(fc, "pred", how="mean", k=5)


@register("rank_entities_last", "A17", materialize=["nation_month"], ctes=["scenario_fc"], digits={"score": 4}, sql="""
SELECT entity, arg_max(pred, period) AS score FROM scenario_fc WHERE scenario = 'high'
GROUP BY entity ORDER BY score ASC, entity LIMIT 5""")
def rank_entities_last(t):
    fc = P.scenario_fc(t).filter(F.col("scenario") == "high")
    return A.rank_entities(fc, "pred", how="last", k=5, highest=False)


@register("coverage", "A18", ctes=["supplier_month"], sql="""
SELECT entity, count(DISTINCT period) AS n_periods, min(period) AS first_period, max(period) AS last_period
FROM supplier_month GROUP BY entity""")
def coverage(t):
    return A.coverage(P.supplier_month(t), "entity", "period")


@register("infer_frequency", "A19", ctes=["nation_month", "event_day"], digits={"median_gap_days": 6}, sql="""
f AS (SELECT 'nation_month' AS panel, period FROM (SELECT DISTINCT period FROM nation_month)
      UNION ALL SELECT 'event_day', period FROM (SELECT DISTINCT period FROM event_day)),
g AS (SELECT panel, period, datediff('day', lag(period) OVER (PARTITION BY panel ORDER BY period), period) AS gap FROM f),
a AS (SELECT panel, count(*) AS n_periods, quantile_cont(gap, 0.5) AS median_gap_days FROM g GROUP BY panel)
SELECT panel, n_periods, median_gap_days,
       CASE WHEN n_periods < 3 THEN 'Unknown' WHEN median_gap_days BETWEEN 25 AND 35 THEN 'Monthly'
            ELSE 'Irregular' END AS frequency FROM a""")
def infer_frequency(t):
    a = A.infer_frequency(P.nation_month(t), "period").withColumn("panel", F.lit("nation_month"))
    b = A.infer_frequency(P.event_day(t), "period").withColumn("panel", F.lit("event_day"))
    return a.unionByName(b)


@register("importance", "A20", materialize=["nation_month"], ctes=["attrib_long"], digits={"mean_abs_shap": 9}, sql="""
SELECT feature, avg(abs(shap_value)) AS mean_abs_shap FROM attrib_long GROUP BY feature""")
def importance(t):
    return A.importance(P.attrib_long(t))


@register("available_values", "A21", materialize=["nation_month"], ctes=["scenario_fc"], sql="""
SELECT 'entity' AS "column", count(DISTINCT entity) AS n_values, min(entity) AS first_value, max(entity) AS last_value
FROM scenario_fc
UNION ALL SELECT 'scenario', count(DISTINCT scenario), min(scenario), max(scenario) FROM scenario_fc
UNION ALL SELECT 'period', count(DISTINCT period), CAST(min(period) AS VARCHAR), CAST(max(period) AS VARCHAR) FROM scenario_fc""")
def available_values(t):
    fc = P.scenario_fc(t).withColumn("period", F.col("period").cast("string"))
    return A.available(fc, ["entity", "scenario", "period"]).groupBy("column").agg(
        F.count("value").alias("n_values"), F.min("value").alias("first_value"), F.max("value").alias("last_value"))


@register("scenario_fan", "A22", materialize=["nation_month"], ctes=["scenario_fc"], digits={
    f"{c}_{s}": (9 if c == "pred_log" else 4) for s in ("base", "low", "high") for c in ("pred_log", "pred")}, sql="""
w AS (SELECT period, entity,
             max(CASE WHEN scenario = 'base' THEN pred_log END) AS pred_log_base, max(CASE WHEN scenario = 'base' THEN pred END) AS pred_base,
             max(CASE WHEN scenario = 'low' THEN pred_log END) AS lo_log, max(CASE WHEN scenario = 'low' THEN pred END) AS lo,
             max(CASE WHEN scenario = 'high' THEN pred_log END) AS hi_log, max(CASE WHEN scenario = 'high' THEN pred END) AS hi
      FROM scenario_fc GROUP BY 1, 2)
SELECT period, entity, pred_log_base, pred_base,
       CASE WHEN lo > hi THEN hi_log ELSE lo_log END AS pred_log_low, CASE WHEN lo > hi THEN hi ELSE lo END AS pred_low,
       CASE WHEN lo > hi THEN lo_log ELSE hi_log END AS pred_log_high, CASE WHEN lo > hi THEN lo ELSE hi END AS pred_high,
       coalesce(lo > hi, false) AS swapped
FROM w""")
def scenario_fan(t):
    return A.scenario_fan(P.scenario_fc(t))


@register("weighted_mean", "A23", ctes=["nation_month"], digits={"weighted_mean": 4}, sql="""
SELECT region, sum(coalesce(avg_price * sales_count, 0.0)) /
       sum(CASE WHEN avg_price IS NOT NULL THEN coalesce(CAST(sales_count AS DOUBLE), 0.0) ELSE 0.0 END) AS weighted_mean
FROM nation_month GROUP BY region""")
def weighted_mean(t):
    return A.weighted_mean(P.nation_month(t), [("avg_price", "sales_count")], by=["region"])


_PRED_SQL = """
lg AS (SELECT period, entity, ln(avg_price) AS y, ln(lag(avg_price, 1) OVER w) AS l1,
              ln(lag(avg_price, 12) OVER w) AS l12, ln(lag(avg_price, 3) OVER w) AS l3
       FROM nation_month WINDOW w AS (PARTITION BY entity ORDER BY period)),
preds AS (SELECT period, entity, 'naive' AS model, y, l1 AS yhat FROM lg
          UNION ALL SELECT period, entity, 'seasonal', y, l12 FROM lg
          UNION ALL SELECT period, entity, 'blend', y, (l1 + l3) / 2 FROM lg),
sp AS (SELECT *, CASE WHEN period < DATE '2000-01-01' THEN 'train' ELSE 'test' END AS split FROM preds
       WHERE y IS NOT NULL AND yhat IS NOT NULL),
met AS (SELECT model, split, count(*) AS n, sqrt(avg((y - yhat) * (y - yhat))) AS rmse, avg(abs(y - yhat)) AS mae,
               1 - sum((y - yhat) * (y - yhat)) / (count(y - yhat) * var_pop(y)) AS r2
        FROM sp GROUP BY 1, 2)"""


def model_predictions(t):
    """Long prediction table (period, entity, model, y, yhat, split) of three
    naive log-price predictors; the train/test cut is 2000-01."""
    nm = P.nation_month(t).select("period", "entity", "avg_price")
    x = W.add_lags(nm, "entity", "period", ["avg_price"], [1, 3, 12])
    arr = F.array(F.struct(F.lit("naive").alias("model"), F.log("avg_price_lag1").alias("yhat")),
                  F.struct(F.lit("seasonal").alias("model"), F.log("avg_price_lag12").alias("yhat")),
                  F.struct(F.lit("blend").alias("model"),
                           ((F.log("avg_price_lag1") + F.log("avg_price_lag3")) / 2).alias("yhat")))
    p = x.select("period", "entity", F.log("avg_price").alias("y"), F.explode(arr).alias("s")).select(
        "period", "entity", "y", "s.*").filter(F.col("y").isNotNull() & F.col("yhat").isNotNull())
    return time_split(p, "period", {"train": ("1900-01-01", "1999-12-31"), "test": ("2000-01-01", "2999-12-31")})


def model_metrics(t):
    p = model_predictions(t)
    return A.regression_metrics(p, "y", "yhat", by=["model", "split"], log_scale=False)


@register("compare_models", "M11 A12", materialize=["nation_month"], ctes=["nation_month"], digits={"rmse": 9, "mae": 9, "r2": 9}, sql=_PRED_SQL + """
SELECT model, split, n, rmse, mae, r2 FROM met""")
def compare_models(t):
    return model_metrics(t).select("model", "split", "n", "rmse", "mae", "r2")


@register("model_selection", "A24", materialize=["nation_month"], ctes=["nation_month"], digits={
    "test_metric": 9, "train_metric": 9, "improvement_pct": 6, "gap_pct": 6}, sql=_PRED_SQL + """,
te AS (SELECT model, rmse FROM met WHERE split = 'test'), tr AS (SELECT model, rmse FROM met WHERE split = 'train')
SELECT te.model, te.rmse AS test_metric, tr.rmse AS train_metric,
       CASE WHEN (SELECT rmse FROM te WHERE model = 'naive') <> 0
            THEN ((SELECT rmse FROM te WHERE model = 'naive') - te.rmse) / (SELECT rmse FROM te WHERE model = 'naive') * 100 END
         AS improvement_pct,
       CASE WHEN tr.rmse <> 0 THEN (te.rmse - tr.rmse) / tr.rmse * 100 END AS gap_pct,
       te.rmse = (SELECT min(rmse) FROM te) AS is_best, te.rmse = (SELECT max(rmse) FROM te) AS is_worst
FROM te LEFT JOIN tr ON te.model = tr.model""")
def model_selection(t):
    m = model_metrics(t)
    return A.model_selection(m.filter("split = 'test'"), m.filter("split = 'train'"), "naive")


@register("split_summary", "A25 D01", ctes=["nation_month"], sql="""
SELECT CASE WHEN period <= DATE '1999-12-31' THEN 'train' ELSE 'test' END AS split, count(*) AS rows,
       min(period) AS start, max(period) AS "end"
FROM nation_month WHERE period BETWEEN DATE '1995-01-01' AND DATE '2001-12-31' GROUP BY 1""")
def split_summary(t):
    s = time_split(P.nation_month(t), "period", {"train": ("1995-01-01", "1999-12-31"),
                                                  "test": ("2000-01-01", "2001-12-31")})
    return A.split_summary(s, "split", "period")


@register("forecast_path", "A26", materialize=["nation_month"], ctes=["scenario_fc"], digits={"value_last": 4, "value_at": 4}, sql="""
SELECT entity, scenario, count(*) AS path_len, min(period) AS first_period, max(period) AS last_period,
       arg_max(pred, period) AS value_last,
       avg(CASE WHEN period = (SELECT max(period) FROM scenario_fc) THEN pred END) AS value_at
FROM scenario_fc GROUP BY 1, 2""")
def forecast_path(t):
    fc = P.scenario_fc(t)
    last = fc.select(F.max("period")).scalar()
    x = A.forecast_path(fc, at=None).select("entity", "scenario", F.size("path").cast("bigint").alias("path_len"),
                                            "first_period", "last_period", "value_last")
    at = fc.groupBy("entity", "scenario").agg(F.avg(F.when(F.col("period") == last, F.col("pred"))).alias("value_at"))
    return x.join(at, ["entity", "scenario"])
