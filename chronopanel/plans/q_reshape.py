"""Registered sort / limit / set-operation / reshaping / sampling queries (L, U, D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggs as A
from ..operators import reshape as R
from ..operators.columns import order_by_list
from ..session import checkpoint_dir
from . import panels as P
from .registry import register

D6 = 6

# Display order of the regions.
REGION_ORDER = ("EUROPE", "ASIA", "AMERICA", "AFRICA", "MIDDLE EAST")


@register("sort_output", "L01 P35", ctes=["nation_month"], digits={"avg_price": D6}, sql="""
SELECT period, region, entity, avg_price FROM nation_month""")
def sort_output(t):
    nm = P.nation_month(t).select("period", "region", "entity", "avg_price")
    return order_by_list(nm, "region", REGION_ORDER, then=["period", "entity"])


@register("top_k_premium", "L02 A13", ctes=["nation_month", "market_month"], digits={"avg_ratio": 9}, sql="""
j AS (SELECT e.entity, e.avg_price / m.avg_price AS r FROM nation_month e JOIN market_month m ON e.period = m.period)
SELECT entity, avg(r) AS avg_ratio FROM j GROUP BY entity HAVING count(*) >= 6
ORDER BY avg_ratio DESC NULLS LAST, entity LIMIT 3""")
def top_k_premium(t):
    prof = A.benchmark_profile(P.nation_month(t), P.market_month(t), "period", "entity", "avg_price", "avg_price")
    return R.top_k(prof.select("entity", "avg_ratio"), "avg_ratio", 3, tie=["entity"])


_INV_SQL = """
x AS (SELECT entity, period, lower(trim(scenario)) AS sc, pred AS p FROM scenario_fc),
a AS (SELECT entity, coalesce(min(CASE WHEN sc = 'base' THEN period END), min(period)) AS anchor FROM x GROUP BY 1),
w AS (SELECT x.*, a.anchor FROM x JOIN a ON x.entity = a.entity
      WHERE x.period >= a.anchor AND x.period <= CAST(a.anchor + INTERVAL 12 MONTH AS DATE)),
r AS (SELECT *, p / lag(p) OVER (PARTITION BY entity, sc ORDER BY period) - 1 AS ret,
             p / max(p) OVER (PARTITION BY entity, sc ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 AS dd
      FROM w),
g AS (SELECT entity, count_if(sc = 'base') AS nb, count_if(sc = 'low') AS nl,
             arg_min(p, period) FILTER (WHERE sc = 'base') AS p0, arg_max(p, period) FILTER (WHERE sc = 'base') AS pt,
             stddev_samp(ret) FILTER (WHERE sc = 'base') AS vol, count(ret) FILTER (WHERE sc = 'base') AS nr,
             min(dd) FILTER (WHERE sc = 'low') AS dd,
             arg_max(p, period) FILTER (WHERE sc = 'high') - arg_max(p, period) FILTER (WHERE sc = 'low') AS spread
      FROM r GROUP BY entity),
inv AS (SELECT entity, CASE WHEN p0 <> 0 THEN (pt - p0) / p0 END AS expected_return_base,
               CASE WHEN nr >= 2 THEN vol END AS volatility_base,
               CASE WHEN nl >= 2 THEN dd END AS downside_max_drawdown_low,
               CASE WHEN nr >= 2 AND vol > 0 THEN (CASE WHEN p0 <> 0 THEN (pt - p0) / p0 END) / vol END AS stability_score
        FROM g WHERE nb >= 2)"""


# Ranks count the better rows; a missing metric has no rank.
_RANKS = ("rank_stability", "stability_score", "DESC"), ("rank_return", "expected_return_base", "DESC"), ("rank_vol", "volatility_base", ""), \
    ("rank_downside", "downside_abs", ""), ("rank_spread", "spread", "")


def _leaders_sql(k=3, then="\nSELECT board, entity, metric_value, position FROM b WHERE keep"):
    ranks = ", ".join(f"CASE WHEN {c} IS NOT NULL THEN rank() OVER (PARTITION BY {c} IS NULL ORDER BY {c} {d}) END AS {r}" for r, c, d in _RANKS)
    boards = "\nUNION ALL ".join(
        f"SELECT '{name}' AS board, entity, CAST({m} AS DOUBLE) AS metric_value, row_number() OVER (ORDER BY {o}, entity) AS position, {n} AS k FROM rk"
        for name, m, o, n in (("stable", "stability_score", "stability_score DESC NULLS LAST, expected_return_base DESC NULLS LAST", k),
                              ("return", "expected_return_base", "expected_return_base DESC NULLS LAST, stability_score DESC NULLS LAST", k),
                              ("defensive", "defensive_rank_sum", "defensive_rank_sum NULLS LAST, stability_score DESC NULLS LAST", k),
                              ("risk", "downside_abs", "downside_abs DESC NULLS LAST, spread DESC NULLS LAST, volatility_base DESC NULLS LAST", 1)))
    return f""",
iv AS (SELECT inv.*, abs(downside_max_drawdown_low) AS downside_abs, g.spread FROM inv JOIN g ON g.entity = inv.entity),
rk0 AS (SELECT *, {ranks} FROM iv),
rk AS (SELECT *, CAST(rank_vol + rank_downside + rank_spread AS BIGINT) AS defensive_rank_sum FROM rk0),
b0 AS ({boards}),
b AS (SELECT *, position <= k AS keep FROM b0)""" + then


@register("leaders", "L03 A14", materialize=["nation_month"], ctes=["scenario_fc"], digits={"metric_value": 9}, sql=_INV_SQL + _leaders_sql())
def leaders(t):
    return R.leaders(A.investment_metrics(P.scenario_fc(t)), k=3)


@register("preview", "L04", materialize=["nation_month"], ctes=["scenario_fc"], digits={"pred": 4}, sql="""
SELECT period, entity, pred, (SELECT count(*) FROM scenario_fc WHERE scenario = 'base') AS total_rows
FROM scenario_fc WHERE scenario = 'base' ORDER BY entity, period LIMIT 10""")
def preview(t):
    fc = P.scenario_fc(t).filter(F.col("scenario") == "base").select("period", "entity", "pred")
    return R.preview(fc, 10, order=["entity", "period"])


_PRI = {"urgent": "1-URGENT", "high": "2-HIGH", "medium": "3-MEDIUM", "unspecified": "4-NOT SPECIFIED", "low": "5-LOW"}


@register("union_entities", "U01", digits={"revenue": 2}, sql="""
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high' WHEN '3-MEDIUM' THEN 'medium'
            WHEN '4-NOT SPECIFIED' THEN 'unspecified' ELSE 'low' END AS entity,
       sum(o_totalprice) AS revenue
FROM orders GROUP BY 1, 2""")
def union_entities(t):
    """One pass over the orders, split into one table for each priority and
    put together again."""
    checkpoint_dir(t.spark)
    o = t("orders").groupBy(P.month_of("o_orderdate").alias("period"), F.col("o_orderpriority").alias("pri")).agg(
        F.sum("o_totalprice").alias("revenue")).checkpoint()
    return R.union_entities({name: o.filter(F.col("pri") == raw).drop("pri") for name, raw in _PRI.items()})


@register("to_long", "U02", ctes=["nation_month"], digits={"value": D6}, sql="""
SELECT period, entity, variable, value FROM (
  SELECT period, entity, 'avg_price' AS variable, avg_price AS value FROM nation_month
  UNION ALL SELECT period, entity, 'avg_price_high', avg_price_high FROM nation_month
  UNION ALL SELECT period, entity, 'avg_price_low', avg_price_low FROM nation_month)""")
def to_long(t):
    return R.to_long(P.nation_month(t), ["period", "entity"], ["avg_price", "avg_price_high", "avg_price_low"])


@register("union_splits", "U03 D01", materialize=["nation_month"], ctes=["nation_lags"], digits={"avg_price": D6, "avg_price_lag1": D6}, sql="""
SELECT period, entity, avg_price, avg_price_lag1 FROM nation_lags
WHERE avg_price_lag1 IS NOT NULL AND period BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'""")
def union_splits(t):
    """The first three quarters of the panel's months and the rest."""
    x = P.nation_lags(t).select("period", "entity", "avg_price", "avg_price_lag1")
    nm = P.nation_month(t)
    first, last = nm.select(F.min("period")).scalar(), nm.select(F.max("period")).scalar()
    months = F.round(F.months_between(last, first)) + 1
    cut = F.add_months(first, F.floor(months * 0.75).cast("int"))
    s = R.time_split(x, "period", {"train": (first, F.add_months(cut, -1)), "test": (cut, last)})
    a = s.filter("split = 'train'").drop("split")
    b = s.filter("split = 'test'").drop("split")
    return R.union_splits(a, b, drop_missing_cols=["avg_price_lag1"])


@register("union_first", "U04 L03", materialize=["nation_month"], ctes=["scenario_fc"], digits={"metric_value": 9}, sql=_INV_SQL + _leaders_sql(3, """,
lb AS (SELECT *, CASE board WHEN 'stable' THEN 0 WHEN 'return' THEN 1 WHEN 'defensive' THEN 2 ELSE 3 END AS src FROM b WHERE keep),
f AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY src, position) AS rn FROM lb)
SELECT board, entity, metric_value, position FROM f WHERE rn = 1 ORDER BY src, position, entity LIMIT 6"""))
def union_first(t):
    lb = R.leaders(A.investment_metrics(P.scenario_fc(t)), k=3)
    src = F.array_position(F.array(*[F.lit(b) for b in ("stable", "return", "defensive", "risk")]), F.col("board"))
    return R.union_first([lb.withColumn("_board_order", src)], "entity", n=6,
                         order=["_board_order", "position"]).drop("_board_order")


@register("stitch", "U05", materialize=["nation_month"], ctes=["nation_month", "scenario_fc"], digits={"avg_price": D6}, sql="""
SELECT period, entity, avg_price, 'history' AS series FROM nation_month
WHERE period < (SELECT min(period) FROM scenario_fc)
UNION ALL SELECT period, entity, pred, 'forecast' FROM scenario_fc WHERE scenario = 'base'""")
def stitch(t):
    fc = P.scenario_fc(t)
    start = fc.select(F.min("period")).scalar()
    hist = P.nation_month(t).filter(F.col("period") < start).select("period", "entity", "avg_price")
    f = fc.filter(F.col("scenario") == "base").select("period", "entity", F.col("pred").alias("avg_price"))
    return R.stitch(hist, f)


@register("make_scenarios", "U06 A04", materialize=["nation_month"], ctes=["nation_month"], digits={"value": 9}, sql="""
r AS (SELECT entity, sales_count FROM nation_month
      WHERE period >= CAST((SELECT max(period) FROM nation_month) - INTERVAL 23 MONTH AS DATE)),
q AS (SELECT entity, quantile_cont(sales_count, 0.1) AS lo, quantile_cont(sales_count, 0.9) AS hi FROM r GROUP BY 1),
b AS (SELECT r.entity, avg(greatest(q.lo, least(q.hi, r.sales_count))) AS v FROM r JOIN q ON r.entity = q.entity GROUP BY 1),
f AS (SELECT * FROM (VALUES ('low', 0.9), ('base', 1.0), ('high', 1.1)) s(scenario, factor))
SELECT CAST((SELECT max(period) FROM nation_month) + to_months(CAST(k + 1 AS INTEGER)) AS DATE) AS period, b.entity,
       f.scenario, b.v * f.factor AS value
FROM b CROSS JOIN f CROSS JOIN range(12) g(k)""")
def make_scenarios(t):
    nm = P.nation_month(t)
    last = nm.select(F.max("period")).scalar()
    recent = nm.filter(F.col("period") >= F.add_months(last, -23))
    base = A.winsorized_mean(recent, "sales_count", 0.1, by=["entity"], out="value")
    return R.make_scenarios(base, {"low": 0.9, "base": 1.0, "high": 1.1}, 12, value="value",
                            start=F.add_months(last, 1), by=["entity"])


@register("split_scenarios", "U07", materialize=["nation_month"], ctes=["scenario_fc"], sql="""
SELECT scenario, count(*) AS rows FROM scenario_fc GROUP BY scenario""")
def split_scenarios(t):
    return R.split_scenarios(P.scenario_fc(t))


@register("yearly_to_monthly", "U08", ctes=["nation_year"], digits={"total_price": 4}, sql="""
SELECT year, entity, sales_count, total_price / 12.0 AS total_price, make_date(CAST(year AS INTEGER), CAST(m AS INTEGER), 1) AS period
FROM nation_year CROSS JOIN range(1, 13) g(m)""")
def yearly_to_monthly(t):
    y = P.nation_year(t)
    a = R.yearly_to_monthly(y, "year", "total_price", how="apportion")
    return a.select("year", "entity", "sales_count", "total_price", "period")


@register("future_periods", "U09", ctes=["nation_month"], sql="""
SELECT CAST((SELECT max(period) FROM nation_month) + to_months(CAST(k AS INTEGER)) AS DATE) AS period
FROM range(1, 13) g(k)""")
def future_periods(t):
    return R.future_periods(P.nation_month(t), "period", 12)


@register("capped_sample", "D02", ctes=["nation_month"], digits={"avg_price": D6}, sql="""
r AS (SELECT period, entity, avg_price, row_number() OVER (PARTITION BY entity
             ORDER BY md5(concat_ws('|', CAST(period AS VARCHAR), entity, '7')), period, entity) AS rn FROM nation_month)
SELECT period, entity, avg_price FROM r WHERE rn <= 5""")
def capped_sample(t):
    """Seeded sample of at most 5 periods per entity (hash order, the same
    rows whatever the partitioning)."""
    return R.capped_sample(P.nation_month(t).select("period", "entity", "avg_price"), 5, ["period", "entity"],
                           by=["entity"], seed=7)
