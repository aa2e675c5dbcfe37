"""Registered window queries (W01-W13) and the flagship query."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggs, windows as W
from . import panels as P
from .registry import register

D6 = 6


@register("panel_yoy_stats", "S01 W01 W02 A07 L01", ctes=["nation_month"], digits={
    c: D6 for c in ("mean", "median", "std", "min", "max", "q25", "q75", "iqr", "cv")}, sql="""
y AS (
  SELECT entity, period,
         CASE WHEN lag(avg_price, 12) OVER w <> 0 THEN (avg_price / lag(avg_price, 12) OVER w - 1) * 100 END AS v
  FROM nation_month WINDOW w AS (PARTITION BY entity ORDER BY period))
SELECT entity, count(*) AS n, avg(v) AS mean, quantile_cont(v, 0.5) AS median, stddev_samp(v) AS std,
       min(v) AS min, max(v) AS max, quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.75) AS q75,
       quantile_cont(v, 0.75) - quantile_cont(v, 0.25) AS iqr,
       CASE WHEN avg(v) <> 0 THEN stddev_samp(v) / avg(v) END AS cv
FROM y WHERE v IS NOT NULL GROUP BY entity""")
def panel_yoy_stats(t):
    """Flagship: nation panel -> lags -> year-on-year change -> per-entity
    statistics, sorted by entity."""
    nm = P.nation_month(t)
    x = W.add_lags(nm, "entity", "period", ["avg_price"], [1, 3, 12])
    x = W.yoy(x, "entity", "period", "avg_price", 12)
    return aggs.group_stats(x, "entity", "avg_price_yoy").orderBy("entity")


@register("lag_features", "W01", ctes=["supplier_month"], digits={
    "revenue": 4, "avg_discount": D6, "revenue_lag1": 4, "revenue_lag2": 4, "revenue_lag3": 4,
    "revenue_lag12": 4, "qty": 4, "qty_lag1": 4, "qty_lag2": 4, "qty_lag3": 4, "qty_lag12": 4}, sql="""
SELECT period, entity, qty, revenue, avg_discount, line_count,
       lag(qty, 1) OVER w AS qty_lag1, lag(qty, 2) OVER w AS qty_lag2, lag(qty, 3) OVER w AS qty_lag3,
       lag(qty, 12) OVER w AS qty_lag12,
       lag(revenue, 1) OVER w AS revenue_lag1, lag(revenue, 2) OVER w AS revenue_lag2,
       lag(revenue, 3) OVER w AS revenue_lag3, lag(revenue, 12) OVER w AS revenue_lag12
FROM supplier_month WINDOW w AS (PARTITION BY entity ORDER BY period)""")
def lag_features(t):
    return W.add_lags(P.supplier_month(t), "entity", "period", ["qty", "revenue"], [1, 2, 3, 12])


@register("lag_features_calendar", "W01", materialize=["nation_month"], ctes=["nation_month"], digits={
    "avg_price": D6, "avg_price_lag1": D6, "avg_price_lag12": D6}, sql="""
SELECT a.period, a.entity, a.avg_price, b.avg_price AS avg_price_lag1, c.avg_price AS avg_price_lag12
FROM nation_month a
LEFT JOIN nation_month b ON b.entity = a.entity AND b.period = CAST(a.period - INTERVAL 1 MONTH AS DATE)
LEFT JOIN nation_month c ON c.entity = a.entity AND c.period = CAST(a.period - INTERVAL 12 MONTH AS DATE)""")
def lag_features_calendar(t):
    nm = P.nation_month(t).select("period", "entity", "avg_price")
    return W.add_lags(nm, "entity", "period", ["avg_price"], [1, 12], mode="calendar")


@register("lag_features_daily", "W01", digits={"value_sum": D6, "value_sum_lag1": D6, "value_sum_lag2": D6}, sql="""
d AS (SELECT CAST(ts AS DATE) AS period, event_type AS entity, count(*) AS events, sum(value) AS value_sum FROM events GROUP BY 1, 2),
l AS (SELECT a.*, k, coalesce(b.period, e.period) AS source
      FROM d a CROSS JOIN (VALUES (1), (2)) v(k)
      LEFT JOIN d b ON b.entity = a.entity AND b.period = CAST(a.period - to_months(k) AS DATE)
      LEFT JOIN d e ON e.entity = a.entity AND a.period = last_day(a.period) AND e.period = last_day(CAST(a.period - to_months(k) AS DATE)))
SELECT l.period, l.entity, any_value(l.events) AS events, any_value(l.value_sum) AS value_sum,
       max(s.events) FILTER (k = 1) AS events_lag1, max(s.value_sum) FILTER (k = 1) AS value_sum_lag1,
       max(s.events) FILTER (k = 2) AS events_lag2, max(s.value_sum) FILTER (k = 2) AS value_sum_lag2
FROM l LEFT JOIN d s ON s.entity = l.entity AND s.period = l.source GROUP BY l.period, l.entity""")
def lag_features_daily(t):
    """Calendar lags of a daily panel: month ends clamp to the earlier month's
    last day."""
    return W.add_lags(P.event_day(t), "entity", "period", ["events", "value_sum"], [1, 2], mode="calendar")


@register("yoy_change", "W02", ctes=["nation_month"], digits={"sales_count_yoy": D6}, sql="""
SELECT period, entity, sales_count,
       CASE WHEN lag(sales_count, 12) OVER w <> 0
            THEN (sales_count / lag(sales_count, 12) OVER w - 1) * 100 END AS sales_count_yoy
FROM nation_month WINDOW w AS (PARTITION BY entity ORDER BY period)""")
def yoy_change(t):
    nm = P.nation_month(t).select("period", "entity", "sales_count")
    return W.yoy(nm, "entity", "period", "sales_count", 12)


@register("log_return", "W03", ctes=["nation_month"], digits={"avg_price_logret": 9}, sql="""
SELECT period, entity, ln(avg_price) - lag(ln(avg_price)) OVER (PARTITION BY entity ORDER BY period) AS avg_price_logret
FROM nation_month""")
def log_return(t):
    nm = P.nation_month(t).select("period", "entity", "avg_price")
    return W.log_return(nm, "entity", "period", "avg_price").drop("avg_price")


@register("rebase_100", "W04", ctes=["nation_month"], digits={"avg_price_index": D6}, sql="""
SELECT period, entity,
       avg_price / first_value(avg_price) OVER (PARTITION BY entity ORDER BY period
                                                ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) * 100
         AS avg_price_index
FROM nation_month""")
def rebase_100(t):
    nm = P.nation_month(t).select("period", "entity", "avg_price")
    return W.rebase(nm, "entity", "period", "avg_price").drop("avg_price")


@register("pct_change", "W05", ctes=["supplier_month"], digits={"revenue_pct": 9}, sql="""
SELECT period, entity,
       CASE WHEN lag(revenue) OVER w <> 0 THEN revenue / lag(revenue) OVER w - 1 END AS revenue_pct
FROM supplier_month WINDOW w AS (PARTITION BY entity ORDER BY period)""")
def pct_change(t):
    sm = P.supplier_month(t).select("period", "entity", "revenue")
    return W.pct_change(sm, "entity", "period", "revenue").drop("revenue")


@register("drawdown", "W06", ctes=["nation_month"], digits={
    "avg_price": D6, "avg_price_runmax": D6, "avg_price_drawdown": 9}, sql="""
SELECT period, entity, avg_price,
       max(avg_price) OVER w AS avg_price_runmax, avg_price / max(avg_price) OVER w - 1 AS avg_price_drawdown
FROM nation_month
WINDOW w AS (PARTITION BY entity ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def drawdown(t):
    nm = P.nation_month(t).select("period", "entity", "avg_price")
    return W.drawdown(nm, "entity", "period", "avg_price")


@register("levels_from_dlog", "W07 W03", ctes=["nation_month"], digits={"avg_price": 2, "level": 2}, sql="""
d AS (
  SELECT period, entity, avg_price,
         coalesce(ln(avg_price) - lag(ln(avg_price)) OVER w, 0) AS dlog,
         first_value(avg_price) OVER (PARTITION BY entity ORDER BY period
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS anchor
  FROM nation_month WINDOW w AS (PARTITION BY entity ORDER BY period))
SELECT period, entity, avg_price,
       anchor * exp(sum(dlog) OVER (PARTITION BY entity ORDER BY period
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS level
FROM d""")
def levels_from_dlog(t):
    """Round trip: log returns cumulated from the first level give the path back."""
    nm = P.nation_month(t).select("period", "entity", "avg_price")
    x = W.log_return(nm, "entity", "period", "avg_price", out="dlog").fillna(0.0, ["dlog"])
    w = W._w("entity", "period").rowsBetween(W.Window.unboundedPreceding, W.Window.unboundedFollowing)
    x = x.withColumn("anchor", F.first("avg_price").over(w))
    return W.levels_from_dlog(x, "entity", "period", "dlog", "anchor", out="level").select(
        "period", "entity", "avg_price", "level")


@register("tail_per_group", "W08", ctes=["nation_month"], digits={"avg_price": D6}, sql="""
SELECT period, entity, avg_price FROM (
  SELECT period, entity, avg_price, row_number() OVER (PARTITION BY entity ORDER BY period DESC) AS rn
  FROM nation_month) WHERE rn <= 3""")
def tail_per_group(t):
    return W.tail_per_group(P.nation_month(t).select("period", "entity", "avg_price"), "entity", "period", 3)


@register("rank_columns", "W09", ctes=["nation_month"], digits={"mean_price": D6, "price_std": D6}, sql="""
s AS (SELECT entity, avg(avg_price) AS mean_price, CAST(sum(sales_count) AS BIGINT) AS sales, stddev_samp(avg_price) AS price_std
      FROM nation_month GROUP BY entity)
SELECT entity, mean_price, sales, price_std,
       rank() OVER (ORDER BY mean_price DESC) AS rank_mean_price,
       rank() OVER (ORDER BY sales DESC) AS rank_sales,
       rank() OVER (ORDER BY price_std ASC) AS rank_price_std,
       rank() OVER (ORDER BY mean_price DESC) + rank() OVER (ORDER BY sales DESC)
         + rank() OVER (ORDER BY price_std ASC) AS rank_sum
FROM s""")
def rank_columns(t):
    s = P.nation_month(t).groupBy("entity").agg(F.avg("avg_price").alias("mean_price"),
                                                F.sum("sales_count").alias("sales"),
                                                F.stddev_samp("avg_price").alias("price_std"))
    return W.rank_columns(s, {"mean_price": True, "sales": True, "price_std": False})


@register("driver_cards", "W10 A15", materialize=["nation_month"], ctes=["attrib_long"], digits={"magnitude": 9, "share": 9}, sql="""
m AS (SELECT entity, scenario, feature, avg(abs_shap) AS magnitude FROM attrib_long GROUP BY 1, 2, 3),
tot AS (SELECT entity, scenario, sum(abs(magnitude)) AS tot FROM m GROUP BY 1, 2)
SELECT m.entity, m.scenario, m.feature, m.magnitude,
       CASE WHEN tot > 0 THEN abs(magnitude) / tot END AS share,
       row_number() OVER (PARTITION BY m.entity, m.scenario ORDER BY abs(magnitude) DESC, m.feature) AS card_rank,
       CASE WHEN abs(magnitude) / tot >= 0.25 THEN 'high' WHEN abs(magnitude) / tot >= 0.10 THEN 'medium'
            ELSE 'low' END AS importance
FROM m JOIN tot ON m.entity = tot.entity AND m.scenario = tot.scenario""")
def driver_cards(t):
    m = P.attrib_long(t).groupBy("entity", "scenario", "feature").agg(F.avg("abs_shap").alias("magnitude"))
    return W.driver_cards(m, ["entity", "scenario"])


@register("upsample_linear", "W11", ctes=["nation_quarter"], digits={"avg_price": 2}, sql="""
q AS (SELECT entity, period, avg_price,
             lead(period) OVER w AS nxt, lead(avg_price) OVER w AS nxt_v
      FROM nation_quarter WINDOW w AS (PARTITION BY entity ORDER BY period)),
e AS (SELECT entity, period, avg_price, nxt, nxt_v,
             CASE WHEN nxt IS NULL THEN 0 ELSE datediff('month', period, nxt) END AS n,
             unnest(generate_series(0, CASE WHEN nxt IS NULL THEN 0 ELSE datediff('month', period, nxt) - 1 END)) AS k
      FROM q)
SELECT entity, CAST(period + to_months(CAST(k AS INTEGER)) AS DATE) AS period,
       CASE WHEN k = 0 THEN avg_price ELSE avg_price + (nxt_v - avg_price) * k / n END AS avg_price
FROM e""")
def upsample_linear(t):
    return W.upsample_linear(P.nation_quarter(t), "entity", "period", ["avg_price"])


@register("month_folds", "W12", ctes=["nation_month"], sql="""
p AS (SELECT period, dense_rank() OVER (ORDER BY period) - 1 AS pos FROM (SELECT DISTINCT period FROM nation_month)),
tot AS (SELECT count(*) AS n FROM p),
f AS (SELECT i AS fold,
             CAST(CASE WHEN i = 4 THEN (SELECT n FROM tot) - 6
                       ELSE floor(24 + ((SELECT n FROM tot) - 6 - 24) / 4.0 * i) END AS INTEGER) AS train_end
      FROM range(5) r(i)),
ft AS (SELECT f.fold, p.period, CASE WHEN p.pos < f.train_end THEN 'train' ELSE 'validation' END AS role, f.train_end
       FROM f JOIN p ON p.pos < f.train_end + 6)
SELECT CAST(ft.fold AS BIGINT) AS fold, ft.role, CAST(ft.train_end AS BIGINT) AS train_end,
       count(*) AS n_rows, min(nm.period) AS first_period, max(nm.period) AS last_period
FROM nation_month nm JOIN ft ON nm.period = ft.period GROUP BY 1, 2, 3""")
def month_folds(t):
    x = W.month_folds(P.nation_month(t), "period", n_splits=5, min_train=24, val=6)
    return x.groupBy(F.col("fold").cast("bigint").alias("fold"), "role",
                     F.col("train_end").cast("bigint").alias("train_end")).agg(
        F.count("*").alias("n_rows"), F.min("period").alias("first_period"), F.max("period").alias("last_period"))


@register("row_folds", "W13", ctes=["supplier_month"], sql="""
x AS (SELECT period, entity, row_number() OVER (ORDER BY period, entity) - 1 AS row_idx FROM supplier_month),
n AS (SELECT count(*) AS n FROM x),
f AS (SELECT i AS fold, (SELECT n FROM n) - (5 - i) * ((SELECT n FROM n) // 6) AS val_start,
             (SELECT n FROM n) - (5 - i) * ((SELECT n FROM n) // 6) + ((SELECT n FROM n) // 6) AS val_end
      FROM range(5) r(i))
SELECT CAST(f.fold AS BIGINT) AS fold, CASE WHEN row_idx < val_start THEN 'train' ELSE 'validation' END AS role,
       count(*) AS n_rows, min(row_idx) AS first_idx, max(row_idx) AS last_idx
FROM x JOIN f ON x.row_idx < f.val_end GROUP BY 1, 2""")
def row_folds(t):
    x = W.row_folds(P.supplier_month(t).select("period", "entity"), ["period", "entity"], n_splits=5)
    return x.groupBy(F.col("fold").cast("bigint").alias("fold"), "role").agg(
        F.count("*").alias("n_rows"), F.min("row_idx").alias("first_idx"), F.max("row_idx").alias("last_idx"))
