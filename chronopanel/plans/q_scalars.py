"""Registered scalar-function and column-operation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import aggs as A
from ..operators import columns as C
from ..operators import windows as W
from ..operators.reshape import time_split
from . import panels as P
from .registry import register

D6 = 6

_ISO = r"(20\d{2})[-/](0[1-9]|1[0-2])"
_ANY_SQL = """coalesce(
    CASE WHEN regexp_extract({s}, '""" + _ISO + """', 0) <> ''
         THEN CAST(strptime(replace(regexp_extract({s}, '""" + _ISO + """', 0), '/', '-'), '%Y-%m') AS DATE) END,
    CAST(date_trunc('month', coalesce(try_strptime({s}, '%Y-%m-%d'), try_strptime({s}, '%Y/%m/%d'),
         try_strptime({s}, '%d/%m/%Y'), try_strptime({s}, '%d-%m-%Y'), try_strptime({s}, '%d.%m.%Y'),
         try_strptime({s}, '%Y-%m'), try_strptime({s}, '%Y/%m'), try_strptime({s}, '%d %b %Y'),
         try_strptime({s}, '%b %Y'), try_strptime({s}, '%B %Y'))) AS DATE))"""


@register("month_normalise", "P01 P02", sql="""
SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS period,
       strftime(o_orderdate, '%Y-%m') AS month_key FROM orders""")
def month_normalise(t):
    o = t("orders")
    return o.select("o_orderkey", fn.month_start("o_orderdate").alias("period"),
                    fn.month_key("o_orderdate").alias("month_key"))


@register("parse_month_text", "P06", ctes=["date_text"], sql=f"""
SELECT o_orderkey, txt, {_ANY_SQL.replace('{s}', 'trim(txt)')} AS period,
       CASE WHEN trim(txt) IS NULL OR trim(txt) = '' THEN ''
            ELSE coalesce(strftime({_ANY_SQL.replace('{s}', 'trim(txt)')}, '%Y-%m'), substr(trim(txt), 1, 7)) END AS month_key
FROM date_text""")
def parse_month_text(t):
    d = P.date_text(t)
    return d.select("o_orderkey", "txt", fn.parse_month_any("txt").alias("period"),
                    fn.norm_month("txt").alias("month_key"))


@register("parse_quarter", "P03", ctes=["date_text"], sql=r"""
SELECT o_orderkey, txt,
       CASE WHEN regexp_matches(upper(trim(txt)), '^\d{4}Q[1-4]$')
            THEN make_date(CAST(substr(trim(txt), 1, 4) AS INTEGER), CAST(substr(trim(txt), 6, 1) AS INTEGER) * 3 - 2, 1)
       END AS period
FROM date_text""")
def parse_quarter(t):
    return P.date_text(t).select("o_orderkey", "txt", fn.quarter_start("txt").alias("period"))


@register("parse_ym", "P04", ctes=["date_text"], sql=r"""
SELECT o_orderkey, txt, CAST(strptime(replace(trim(txt), 'M', '-'), '%Y-%m') AS DATE) AS period
FROM date_text WHERE regexp_matches(trim(txt), '^\d{4}M\d{2}$')""")
def parse_ym(t):
    return fn.parse_ym(P.date_text(t).select("o_orderkey", "txt"), "txt")


@register("parse_year_strict", "P05", ctes=["date_text"], sql=r"""
SELECT o_orderkey, CAST(trim(year_txt) AS BIGINT) AS year_txt FROM date_text WHERE regexp_matches(trim(year_txt), '^\d{4}$')""")
def parse_year_strict(t):
    return fn.parse_year(P.date_text(t).select("o_orderkey", "year_txt"), "year_txt", strict=True)


@register("parse_year_coerce", "P05 P09", ctes=["date_text"], sql="""
SELECT o_orderkey, CAST(TRY_CAST(year_txt AS DOUBLE) AS BIGINT) AS year_txt FROM date_text
WHERE TRY_CAST(year_txt AS DOUBLE) IS NOT NULL""")
def parse_year_coerce(t):
    return fn.parse_year(P.date_text(t).select("o_orderkey", "year_txt"), "year_txt", strict=False)


def _vote_sql():
    s = "trim(txt)"
    rules = [("dayfirst", ["%d/%m/%Y", "%d-%m-%Y", "%Y-%m-%d", "%Y/%m/%d", "%Y-%m"]),
             ("monthfirst", ["%m/%d/%Y", "%m-%d-%Y", "%Y-%m-%d", "%Y/%m/%d", "%Y-%m"]),
             ("strict_dmy", ["%d/%m/%Y"]), ("strict_mdy", ["%m/%d/%Y"])]
    parts = []
    for i, (name, fmts) in enumerate(rules):
        p = "coalesce(" + ", ".join(f"try_strptime({s}, '{f}')" for f in fmts) + ")"
        parts.append(f"SELECT '{name}' AS rule, count({p}) AS parsed, count(DISTINCT date_trunc('month', {p})) AS months, "
                     f"{-i} AS neg FROM dmy")
    return ("dmy AS (SELECT strftime(o_orderdate, '%-d/%-m/%Y') AS txt FROM orders),\nsc AS (" +
            "\nUNION ALL\n".join(parts) + ")\nSELECT rule, parsed, months FROM sc ORDER BY parsed DESC, months DESC, neg DESC LIMIT 1")


@register("best_date_format", "P07", sql=_vote_sql())
def best_date_format(t):
    o = t("orders").select(F.date_format("o_orderdate", "d/M/yyyy").alias("txt"))
    return fn.best_date_format(o, "txt")


@register("parse_with_fallback", "P08", ctes=["date_text"], sql="""
SELECT o_orderkey, CAST(date_trunc('month', coalesce(
         try_strptime(trim(txt), '%Y-%m-%d'), try_strptime(trim(txt), '%Y/%m/%d'), try_strptime(trim(txt), '%Y-%m'),
         try_strptime(trim(txt), '%m/%d/%Y'), try_strptime(trim(txt), '%d/%m/%Y'), try_strptime(trim(txt), '%d-%m-%Y'),
         try_strptime(trim(txt), '%d.%m.%Y'))) AS DATE) AS period
FROM date_text""")
def parse_with_fallback(t):
    """Every order's date text; quarter and month codes stay NULL (the
    library's ``check_parsed`` guard would report them)."""
    d = P.date_text(t)
    return d.select("o_orderkey", fn.parse_with_fallback("txt").alias("period"))


@register("to_number", "P09", digits={"k": D6}, sql=r"""
SELECT event_id, TRY_CAST(trim(regexp_extract(props, ':\s*([^}]*)', 1)) AS DOUBLE) AS k FROM events""")
def to_number(t):
    e = t("events")
    return e.select("event_id", fn.to_number(F.regexp_extract("props", r":\s*([^}]*)", 1)).alias("k"))


@register("parse_grouped_number", "P10", digits={"value": 2}, sql="""
SELECT o_orderkey, format('{:,.2f}', o_totalprice) AS txt,
       TRY_CAST(replace(trim(format('{:,.2f}', o_totalprice)), ',', '') AS DOUBLE) AS value FROM orders""")
def parse_grouped_number(t):
    o = t("orders").select("o_orderkey", F.format_number("o_totalprice", 2).alias("txt"))
    return o.withColumn("value", fn.parse_grouped_number("txt"))


_PRI = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def priority_wide(t):
    """Wide (period, entity) table: one revenue column per order priority,
    NULL where a nation had no order of that priority in the month."""
    o = t("orders").select("o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = t("customer").select("c_custkey", "c_nationkey")
    j = o.join(c, o["o_custkey"] == c["c_custkey"])
    return (j.groupBy(P.month_of("o_orderdate").alias("period"), F.col("c_nationkey").cast("bigint").alias("nation"))
            .pivot("o_orderpriority", list(_PRI)).agg(F.sum("o_totalprice"))
            .toDF("period", "nation", *[f"p{i + 1}" for i in range(len(_PRI))]))


_WIDE_SQL = """wide AS (
  SELECT CAST(date_trunc('month', o.o_orderdate) AS DATE) AS period, CAST(c.c_nationkey AS BIGINT) AS nation,
""" + ",\n".join(f"    sum(CASE WHEN o.o_orderpriority = '{p}' THEN o.o_totalprice END) AS p{i + 1}" for i, p in enumerate(_PRI)) + """
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2)"""


@register("row_sum_mean", "P11 P12", digits={"row_sum": 2, "row_mean": 4}, sql=_WIDE_SQL + """
SELECT period, nation,
       coalesce(p1, 0.0) + coalesce(p2, 0.0) + coalesce(p3, 0.0) + coalesce(p4, 0.0) + coalesce(p5, 0.0) AS row_sum,
       CASE WHEN (p1 IS NOT NULL)::INT + (p2 IS NOT NULL)::INT + (p3 IS NOT NULL)::INT + (p4 IS NOT NULL)::INT + (p5 IS NOT NULL)::INT > 0
            THEN (coalesce(p1, 0.0) + coalesce(p2, 0.0) + coalesce(p3, 0.0) + coalesce(p4, 0.0) + coalesce(p5, 0.0)) /
                 ((p1 IS NOT NULL)::INT + (p2 IS NOT NULL)::INT + (p3 IS NOT NULL)::INT + (p4 IS NOT NULL)::INT + (p5 IS NOT NULL)::INT)
       END AS row_mean
FROM wide""")
def row_sum_mean(t):
    w = priority_wide(t)
    cols = [f"p{i + 1}" for i in range(len(_PRI))]
    return w.select("period", "nation", fn.row_sum(cols).alias("row_sum"), fn.row_mean(cols).alias("row_mean"))


# Raw priority labels and their canonical names.
PRIORITY_LABELS = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium",
                   "4-NOT SPECIFIED": "unspecified", "5-LOW": "low"}


@register("map_labels", "P13", sql="""
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high'
       WHEN '3-MEDIUM' THEN 'medium' WHEN '4-NOT SPECIFIED' THEN 'unspecified' WHEN '5-LOW' THEN 'low'
       ELSE o_orderpriority END AS o_orderpriority FROM orders""")
def map_labels(t):
    return C.map_labels(t("orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", PRIORITY_LABELS)


@register("log_columns", "P14", ctes=["nation_month"], digits={"log_avg_price": 9, "log_total_price": 9}, sql="""
SELECT period, entity, CASE WHEN avg_price > 0 THEN ln(avg_price) END AS log_avg_price,
       CASE WHEN total_price > 0 THEN ln(total_price) END AS log_total_price FROM nation_month""")
def log_columns(t):
    nm = P.nation_month(t).select("period", "entity", "avg_price", "total_price")
    return C.log_columns(nm, ["avg_price", "total_price"], drop_raw=True, check=True)


@register("log_guard", "P14", ctes=["nation_month"], sql="""
SELECT 'avg_price_low' AS "column", CAST(count_if(avg_price_low IS NULL OR avg_price_low <= 0) AS BIGINT) AS bad FROM nation_month
UNION ALL SELECT 'avg_price', CAST(count_if(avg_price IS NULL OR avg_price <= 0) AS BIGINT) FROM nation_month""")
def log_guard(t):
    return C.log_guard(P.nation_month(t), ["avg_price_low", "avg_price"]).select("column", "bad")


@register("level_of", "P15", materialize=["nation_month"], ctes=["scenario_fc"], digits={"level": 4}, sql="""
SELECT period, entity, scenario, coalesce(CASE WHEN scenario <> 'low' THEN pred END, exp(pred_log)) AS level
FROM scenario_fc""")
def level_of(t):
    fc = P.scenario_fc(t)
    return fc.select("period", "entity", "scenario",
                     fn.level_of(F.when(F.col("scenario") != "low", F.col("pred")), "pred_log").alias("level"))


@register("project_columns", "P16 S07", ctes=["nation_month"], digits={"avg_price": D6}, sql="""
SELECT period, entity, avg_price, sales_count FROM nation_month""")
def project_columns(t):
    from ..sources.schema import expect_columns
    nm = expect_columns(P.nation_month(t), ["period", "entity", "avg_price", "sales_count"], "nation_month")
    x = C.drop_present(nm, ["total_price", "avg_price_high", "avg_price_low", "region", "not_there"])
    return C.project(x, ["period", "entity", "avg_price", "sales_count"])


@register("lag_families", "P17 P19 P22", ctes=["supplier_month"], digits={
    "qty": 4, "qty_lag1": 4, "qty_lag2": 4, "revenue": 4, "revenue_lag1": 4, "revenue_lag2": 4}, sql="""
x AS (SELECT period, entity, qty, revenue, lag(revenue, 2) OVER w AS revenue_lag2, lag(qty, 1) OVER w AS qty_lag1,
             lag(revenue, 1) OVER w AS revenue_lag1, lag(qty, 2) OVER w AS qty_lag2
      FROM supplier_month WINDOW w AS (PARTITION BY entity ORDER BY period))
SELECT period, entity, qty, qty_lag1, qty_lag2, revenue, revenue_lag1, revenue_lag2 FROM x
WHERE qty_lag1 IS NOT NULL AND qty_lag2 IS NOT NULL AND revenue_lag1 IS NOT NULL AND revenue_lag2 IS NOT NULL""")
def lag_families(t):
    x = W.add_lags(P.supplier_month(t), "entity", "period", ["revenue", "qty"], [2, 1])
    keep = ["period", "entity"] + C.select_families(x.columns, {"qty", "revenue"})
    x = C.order_lags(x.select(*keep))
    return C.drop_missing(x, "lags")


@register("period_filter", "P20 P21", ctes=["nation_month"], digits={"avg_price": D6}, sql="""
SELECT period, entity, avg_price FROM nation_month
WHERE period BETWEEN DATE '1996-01-01' AND DATE '2000-12-01' AND period NOT IN (DATE '1997-11-01', DATE '1999-07-01')
  AND period < DATE '2000-07-01'""")
def period_filter(t):
    nm = P.nation_month(t).select("period", "entity", "avg_price")
    x = C.period_filter(nm, "period", "1996-01-01", "2000-12-01", exclude=["1997-11-01", "1999-07-01"])
    return C.trim_before(x, "period", "2000-07-01")


@register("norm_key", "P23", sql=r"""
SELECT p_partkey, regexp_replace(lower(trim(p_name)), '[^\pL\pN]', '', 'g') AS name_key FROM part""")
def norm_key(t):
    return t("part").select("p_partkey", fn.norm_key("p_name").alias("name_key"))


@register("norm_scenario", "P24", materialize=["nation_month"], ctes=["scenario_fc"], sql="""
SELECT period, entity, CASE WHEN lower(trim(raw)) IN ('base') THEN 'base'
       WHEN lower(trim(raw)) IN ('low', 'lower') THEN 'low'
       WHEN lower(trim(raw)) IN ('high', 'higher') THEN 'high' ELSE 'base' END AS scenario
FROM (SELECT period, entity, CASE scenario WHEN 'base' THEN ' Mid ' WHEN 'low' THEN 'LOWER' ELSE ' HIGH ' END AS raw
      FROM scenario_fc)""")
def norm_scenario(t):
    fc = P.scenario_fc(t)
    raw = F.when(F.col("scenario") == "base", " Mid ").when(F.col("scenario") == "low", "LOWER").otherwise(" HIGH ")
    return fc.select("period", "entity", fn.norm_scenario(raw, on_unknown="base").alias("scenario"))


@register("filter_in", "P25 P23", ctes=["nation_month"], digits={"avg_price": D6}, sql=r"""
SELECT period, entity, avg_price FROM nation_month
WHERE regexp_replace(lower(trim(entity)), '[^\pL\pN]', '', 'g') IN ('nation1', 'nation12', 'nation7')""")
def filter_in(t):
    nm = P.nation_month(t).select("period", "entity", "avg_price")
    keys = ["nation1", "nation12", "nation7"]
    return C.filter_in(nm, "entity", keys, key=fn.norm_key)


@register("direction_flags", "P26", materialize=["nation_month"], ctes=["attrib_long"], sql="""
SELECT period, entity, scenario, feature, CASE WHEN shap_value >= 0 THEN 'up' ELSE 'down' END AS dir_up,
       CASE WHEN shap_value > 0 THEN 'up' WHEN shap_value < 0 THEN 'down' END AS dir_none
FROM attrib_long""")
def direction_flags(t):
    a = P.attrib_long(t)
    return a.select("period", "entity", "scenario", "feature", fn.direction("shap_value", "up").alias("dir_up"),
                    fn.direction("shap_value", "none").alias("dir_none"))


@register("trend_band", "P27 P28", materialize=["nation_month"], ctes=["scenario_fc"], digits={"change": 9}, sql="""
x AS (SELECT entity, scenario, arg_min(pred, period) AS p0, arg_max(pred, period) AS p1 FROM scenario_fc GROUP BY 1, 2),
y AS (SELECT entity, scenario, CASE WHEN p0 IS NOT NULL AND p0 <> 0 THEN p1 / p0 - 1 END AS change FROM x)
SELECT entity, scenario, change,
       CASE WHEN change IS NULL THEN 'unknown' WHEN change >= 0.03 THEN 'increase' WHEN change <= -0.03 THEN 'decrease'
            ELSE 'stable' END AS direction,
       CASE WHEN change IS NULL THEN 'unknown' WHEN change >= 0.08 OR change <= -0.08 THEN 'strong'
            WHEN change >= 0.03 OR change <= -0.03 THEN 'moderate' ELSE 'weak' END AS strength
FROM y""")
def trend_band(t):
    fc = P.scenario_fc(t)
    g = fc.groupBy("entity", "scenario").agg(F.min_by("pred", "period").alias("p0"), F.max_by("pred", "period").alias("p1"))
    g = g.select("entity", "scenario", fn.pct_change_of("p1", "p0").alias("change"))
    return g.select("entity", "scenario", "change", fn.trend_band("change").alias("b")).select(
        "entity", "scenario", "change", "b.direction", "b.strength")


@register("gap_band", "P29 J10", materialize=["nation_month"], ctes=["nation_month"], digits={"rmse_train": 9, "rmse_test": 9, "rmse_gap_pct": 6},
          sql="""
lg AS (SELECT period, entity, ln(avg_price) AS y, ln(lag(avg_price, 1) OVER w) AS l1,
              ln(lag(avg_price, 12) OVER w) AS l12, ln(lag(avg_price, 3) OVER w) AS l3
       FROM nation_month WINDOW w AS (PARTITION BY entity ORDER BY period)),
preds AS (SELECT period, 'naive' AS model, y, l1 AS yhat FROM lg UNION ALL SELECT period, 'seasonal', y, l12 FROM lg
          UNION ALL SELECT period, 'blend', y, (l1 + l3) / 2 FROM lg),
sp AS (SELECT *, CASE WHEN period < DATE '2000-01-01' THEN 'train' ELSE 'test' END AS split FROM preds
       WHERE y IS NOT NULL AND yhat IS NOT NULL),
met AS (SELECT model, split, sqrt(avg((y - yhat) * (y - yhat))) AS rmse FROM sp GROUP BY 1, 2),
g AS (SELECT a.model, a.rmse AS rmse_train, b.rmse AS rmse_test,
             CASE WHEN a.rmse <> 0 THEN (b.rmse - a.rmse) / abs(a.rmse) * 100 END AS rmse_gap_pct
      FROM met a LEFT JOIN met b ON a.model = b.model AND b.split = 'test' WHERE a.split = 'train')
SELECT model, rmse_train, rmse_test, rmse_gap_pct,
       CASE WHEN rmse_gap_pct IS NULL THEN 'unknown' WHEN rmse_gap_pct <= 30 THEN 'success'
            WHEN rmse_gap_pct <= 80 THEN 'info' ELSE 'warning' END AS tone
FROM g""")
def gap_band(t):
    from ..operators.joins import train_test_gap
    from .q_aggs import model_metrics
    m = model_metrics(t)
    g = train_test_gap(m.filter("split = 'train'"), m.filter("split = 'test'"), metrics=["rmse"])
    return g.select("model", "rmse_train", "rmse_test", "rmse_gap_pct", fn.gap_band("rmse_gap_pct").alias("tone"))


@register("narrate_metrics", "P30", ctes=["nation_month"], sql="""
SELECT entity, printf('%s: mean price %.2f over %d months, %d orders', entity, round(avg(avg_price) * 100.0) / 100.0, count(*),
                      sum(sales_count)) AS text
FROM nation_month GROUP BY entity""")
def narrate_metrics(t):
    g = P.nation_month(t).groupBy("entity").agg(F.avg("avg_price").alias("m"), F.count("*").alias("n"),
                                                F.sum("sales_count").alias("s"))
    return g.select("entity", fn.narrate("%s: mean price %.2f over %d months, %d orders", "entity", fn.cents("m"), "n", "s")
                    .alias("text"))


@register("coalesce_columns", "P34", ctes=["nation_month"], digits={"price": D6}, sql="""
SELECT period, entity, coalesce(avg_price_high, avg_price_low, avg_price) AS price FROM nation_month""")
def coalesce_columns(t):
    nm = P.nation_month(t).select("period", "entity", "avg_price_high", "avg_price_low", "avg_price")
    return C.coalesce_columns(nm, {"price": ["avg_price_high", "avg_price_low", "avg_price"]}).drop("avg_price")


@register("pretty_feature", "P36", materialize=["nation_month"], ctes=["attrib_long"], sql="""
SELECT DISTINCT feature, regexp_replace(feature, '^(num|cat|remainder)__', '') AS pretty FROM attrib_long""")
def pretty_feature(t):
    return P.attrib_long(t).select("feature", fn.pretty_feature("feature").alias("pretty")).distinct()


@register("real_rate", "P38 W02", ctes=["supplier_month"], digits={"real_rate": 6}, sql="""
SELECT period, entity, avg_discount * 100 -
       CASE WHEN lag(revenue, 12) OVER w <> 0 THEN (revenue / lag(revenue, 12) OVER w - 1) * 100 END AS real_rate
FROM supplier_month WINDOW w AS (PARTITION BY entity ORDER BY period)""")
def real_rate(t):
    x = W.yoy(P.supplier_month(t), "entity", "period", "revenue", 12, out="infl")
    return x.select("period", "entity", fn.real_rate(F.col("avg_discount") * 100, "infl").alias("real_rate"))


@register("filter_or_all", "P39", ctes=["nation_month"], digits={"avg_price": D6}, sql="""
SELECT 'match' AS mode, period, entity, avg_price FROM nation_month WHERE entity = 'NATION_3'
UNION ALL SELECT 'fallback', period, entity, avg_price FROM nation_month""")
def filter_or_all(t):
    nm = P.nation_month(t).select("period", "entity", "avg_price")
    a = C.filter_or_all(nm, F.col("entity") == "NATION_3").withColumn("mode", F.lit("match"))
    b = C.filter_or_all(nm, F.col("entity") == "NO_SUCH_ENTITY").withColumn("mode", F.lit("fallback"))
    return a.unionByName(b)


@register("format_columns", "S04 X10", sql="""
SELECT o_orderkey, printf('%.2f', round_even(o_totalprice, 2)) AS o_totalprice FROM orders""")
def format_columns(t):
    return C.format_columns(t("orders").select("o_orderkey", "o_totalprice"), ["o_totalprice"], 2)
