"""Registered join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggs as A
from ..operators import joins as J
from . import panels as P
from .registry import register

D6 = 6


@register("expand_entities", "J01", ctes=["market_month"], digits={"avg_price": D6}, sql="""
SELECT m.period, m.avg_price, n.n_name AS entity FROM market_month m CROSS JOIN nation n""")
def expand_entities(t):
    nations = t("nation").select(F.col("n_name").alias("entity"))
    return J.expand_entities(P.market_month(t).select("period", "avg_price"), nations)


@register("merge_panel", "J02", ctes=["nation_month", "market_month", "ship_nation_month"], digits={
    "avg_price": D6, "market_price": D6, "qty": 4, "avg_discount": D6}, sql="""
SELECT a.period, a.entity, a.avg_price, a.sales_count, m.market_price, m.market_sales, s.qty, s.avg_discount
FROM nation_month a
LEFT JOIN (SELECT period, avg_price AS market_price, sales_count AS market_sales FROM market_month) m ON a.period = m.period
LEFT JOIN ship_nation_month s ON a.period = s.period AND a.entity = s.entity""")
def merge_panel(t):
    base = P.nation_month(t).select("period", "entity", "avg_price", "sales_count")
    mk = P.market_month(t).select("period", F.col("avg_price").alias("market_price"),
                                  F.col("sales_count").alias("market_sales"))
    return J.merge_panel(base, [mk, P.ship_nation_month(t)], keys=["period", "entity"])


@register("inner_panel", "J03", ctes=["nation_month", "ship_nation_month"], digits={"avg_price": D6, "qty": 4}, sql="""
SELECT a.period, a.entity, a.avg_price, s.qty FROM nation_month a
JOIN ship_nation_month s ON a.period = s.period AND a.entity = s.entity""")
def inner_panel(t):
    a = P.nation_month(t).select("period", "entity", "avg_price")
    b = P.ship_nation_month(t).select("period", "entity", "qty")
    return J.inner_panel(a, b)


@register("checked_join", "J04 J05", ctes=["nation_month", "market_month"], digits={"avg_price": D6, "market_price": D6},
          sql="""
SELECT a.period, a.entity, a.avg_price, m.avg_price AS market_price
FROM nation_month a LEFT JOIN market_month m ON a.period = m.period""")
def checked_join(t):
    a = P.nation_month(t).select("period", "entity", "avg_price")
    m = P.market_month(t).select("period", F.col("avg_price").alias("market_price"))
    return J.checked_join(a, m, ["period"], "left", validate="many_to_one")


@register("duplicate_keys", "J05", sql="""
SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS period, count(*) AS n
FROM orders GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_keys(t):
    o = t("orders").select("o_custkey", P.month_of("o_orderdate").alias("period"))
    return J.duplicate_keys(o, ["o_custkey", "period"])


@register("align_periods", "J06", materialize=["nation_month"], ctes=["nation_month", "ship_nation_month"], sql="""
SELECT 'orders' AS side, count(*) AS rows, min(period) AS first_period, max(period) AS last_period FROM nation_month
WHERE period IN (SELECT period FROM ship_nation_month)
UNION ALL
SELECT 'shipments', count(*), min(period), max(period) FROM ship_nation_month
WHERE period IN (SELECT period FROM nation_month)""")
def align_periods(t):
    a, b = J.align_periods(P.nation_month(t), P.ship_nation_month(t))
    f = lambda d, s: d.agg(F.count("*").alias("rows"), F.min("period").alias("first_period"),
                           F.max("period").alias("last_period")).withColumn("side", F.lit(s))
    return f(a, "orders").unionByName(f(b, "shipments"))


@register("asof_anchor", "J07", materialize=["nation_month"], ctes=["nation_month", "scenario_fc"], digits={"anchor_value": D6}, sql="""
s AS (SELECT entity, min(period) AS start FROM scenario_fc GROUP BY entity),
j AS (SELECT h.entity, h.period, h.avg_price, s.start FROM nation_month h JOIN s ON h.entity = s.entity),
g AS (SELECT entity, arg_max(avg_price, period) FILTER (WHERE period < start) AS vb,
             max(period) FILTER (WHERE period < start) AS pb, arg_max(avg_price, period) AS vl, max(period) AS pl
      FROM j GROUP BY entity)
SELECT entity, CASE WHEN pb IS NOT NULL THEN pb ELSE pl END AS anchor_period,
       CASE WHEN pb IS NOT NULL THEN vb ELSE vl END AS anchor_value, pb IS NOT NULL AS strictly_before
FROM g""")
def asof_anchor(t):
    starts = P.scenario_fc(t).groupBy("entity").agg(F.min("period").alias("start"))
    return J.asof_anchor(P.nation_month(t), starts, value="avg_price")


@register("disaggregate", "J08 A03", materialize=["nation_month"], ctes=["nation_month", "market_month"], digits={"sales_count": 6}, sql="""
r AS (SELECT * FROM nation_month WHERE period >= CAST((SELECT max(period) FROM nation_month) - INTERVAL 11 MONTH AS DATE)),
sh AS (SELECT entity, sum(sales_count) / (SELECT sum(sales_count) FROM r) AS share FROM r GROUP BY entity)
SELECT m.period, m.avg_price IS NOT NULL AS has_price, sh.entity, m.sales_count * sh.share AS sales_count
FROM market_month m CROSS JOIN sh""")
def disaggregate(t):
    shares = A.trailing_shares(P.nation_month(t), "period", "entity", "sales_count", 12)
    total = P.market_month(t).select("period", F.col("avg_price").isNotNull().alias("has_price"),
                                     F.col("sales_count").cast("double").alias("sales_count"))
    return J.disaggregate(total, shares, ["sales_count"], ["share"])


@register("attach_values", "J09 U02", ctes=["nation_month"], digits={"feature_value": D6, "shap_value": D6}, sql="""
m AS (SELECT avg(sales_count) AS ms, avg(avg_price) AS mp FROM nation_month),
w AS (SELECT period, entity, CAST(sales_count AS DOUBLE) AS sales_count, avg_price,
             0.1 * (sales_count - (SELECT ms FROM m)) AS shap_sales_count, 0.001 * (avg_price - (SELECT mp FROM m)) AS shap_avg_price
      FROM nation_month)
SELECT period, entity, 'sales_count' AS feature, sales_count AS feature_value, shap_sales_count AS shap_value FROM w
UNION ALL SELECT period, entity, 'avg_price', avg_price, shap_avg_price FROM w""")
def attach_values(t):
    nm = P.nation_month(t)
    ms = nm.select(F.avg("sales_count")).scalar()
    mp = nm.select(F.avg("avg_price")).scalar()
    vals = nm.select("period", "entity", "sales_count", "avg_price")
    shap = nm.select("period", "entity", (F.lit(0.1) * (F.col("sales_count") - ms)).alias("shap_sales_count"),
                     (F.lit(0.001) * (F.col("avg_price") - mp)).alias("shap_avg_price"))
    return J.attach_values(vals, shap, ["period", "entity"], ["sales_count", "avg_price"])


@register("missing_periods", "J11", ctes=["nation_month"], sql="""
r AS (SELECT entity, min(period) AS a, max(period) AS b FROM nation_month GROUP BY entity),
cal AS (SELECT entity, CAST(unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS DATE) AS period FROM r)
SELECT entity, period FROM cal
WHERE NOT EXISTS (SELECT 1 FROM nation_month n WHERE n.entity = cal.entity AND n.period = cal.period)""")
def missing_periods(t):
    return J.missing_periods(P.nation_month(t).select("entity", "period"), "period", by=["entity"])


@register("missing_periods_suppliers", "J11", ctes=["supplier_month"], sql="""
r AS (SELECT entity, min(period) AS a, max(period) AS b FROM supplier_month GROUP BY entity),
cal AS (SELECT entity, CAST(unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS DATE) AS period FROM r)
SELECT entity, period FROM cal
WHERE NOT EXISTS (SELECT 1 FROM supplier_month n WHERE n.entity = cal.entity AND n.period = cal.period)""")
def missing_periods_suppliers(t):
    return J.missing_periods(P.supplier_month(t).select("entity", "period"), "period", by=["entity"])
