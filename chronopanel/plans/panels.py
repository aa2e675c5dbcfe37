"""Canonical panels built from the input tables.

Every builder aggregates before it joins small dimensions, so the only
large shuffles are the fact-to-fact join (orders x customer) and the
panel aggregate itself (partial aggregation happens map-side).

``CTE`` holds the same definitions in SQL (DuckDB dialect) for the oracle
queries; ``with_ctes`` assembles them with their dependencies.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import repeat_for_each
from ..operators.windows import add_lags
from ..session import table

# Priority bands that define the low and high scenario paths.
HIGH_PRIORITIES = ("1-URGENT", "2-HIGH")
LOW_PRIORITIES = ("4-NOT SPECIFIED", "5-LOW")
# Weights of the linear attribution model (feature -> weight).
ATTRIB_WEIGHTS = {"sales_count": 0.05, "avg_price_lag1": 0.4, "avg_price_lag12": 0.2, "pred_level": 0.3}
DUMMY_WEIGHT = 0.02
SCENARIO_MONTHS = 12


class Tables:
    """Lazy access to the input tables of one data folder. Tables and
    panels are memoised per query build: every use of a panel inside one
    plan is the SAME DataFrame, so Spark reuses its exchanges (and the
    stage cache serves scalar subqueries) instead of recomputing the
    fact-table join and aggregate for each use."""

    def __init__(self, spark: SparkSession, sf_dir: str, materialize=()):
        self.spark, self.sf_dir = spark, sf_dir
        self._memo: dict = {}
        self.materialize = set(materialize)

    def __call__(self, name: str) -> DataFrame:
        key = ("table", name)
        if key not in self._memo:
            self._memo[key] = table(self.spark, self.sf_dir, name)
        return self._memo[key]

    def memo(self, name: str, build):
        key = ("panel", name)
        if key not in self._memo:
            df = build(self)
            if name in self.materialize:
                # a panel used many times by one query is computed once and
                # written to the shared checkpoint folder (cuts the lineage;
                # survives executor loss), then read back by every use
                from ..session import checkpoint_dir
                checkpoint_dir(self.spark)
                df = df.checkpoint(eager=True)
            self._memo[key] = df
        return self._memo[key]


def panel(fn):
    """Memoise a panel builder on the ``Tables`` object."""
    def wrapped(t: Tables) -> DataFrame:
        return t.memo(fn.__name__, fn) if isinstance(t, Tables) else fn(t)
    wrapped.__name__, wrapped.__doc__ = fn.__name__, fn.__doc__
    return wrapped


def month_of(c: str):
    return F.trunc(F.to_date(F.col(c)), "month")


@panel
def nation_month(t: Tables) -> DataFrame:
    """(period, entity=nation, region, avg_price, sales_count, total_price,
    avg_price_high, avg_price_low) from orders x customer, aggregated by
    (month, nation key) before the two tiny dimension joins."""
    o = t("orders").select("o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = t("customer").select("c_custkey", "c_nationkey")
    p = F.col("o_totalprice")
    g = (o.join(c, o["o_custkey"] == c["c_custkey"])
         .groupBy(month_of("o_orderdate").alias("period"), F.col("c_nationkey"))
         .agg(F.avg(p).alias("avg_price"), F.count("*").alias("sales_count"), F.sum(p).alias("total_price"),
              F.avg(F.when(F.col("o_orderpriority").isin(*HIGH_PRIORITIES), p)).alias("avg_price_high"),
              F.avg(F.when(F.col("o_orderpriority").isin(*LOW_PRIORITIES), p)).alias("avg_price_low")))
    n = t("nation").select("n_nationkey", "n_name", "n_regionkey")
    r = t("region").select("r_regionkey", "r_name")
    return (g.join(n, g["c_nationkey"] == n["n_nationkey"]).join(r, F.col("n_regionkey") == r["r_regionkey"])
             .select("period", F.col("n_name").alias("entity"), F.col("r_name").alias("region"),
                     "avg_price", "sales_count", "total_price", "avg_price_high", "avg_price_low"))


@panel
def market_month(t: Tables) -> DataFrame:
    """Benchmark series: all orders by month."""
    return (t("orders").groupBy(month_of("o_orderdate").alias("period"))
            .agg(F.avg("o_totalprice").alias("avg_price"), F.count("*").alias("sales_count")))


@panel
def supplier_month(t: Tables) -> DataFrame:
    """(period=ship month, entity=supplier key, qty, revenue, avg_discount,
    line_count): a panel whose entity count grows with the data."""
    l = t("lineitem")
    return (l.groupBy(month_of("l_shipdate").alias("period"), F.col("l_suppkey").cast("string").alias("entity"))
            .agg(F.sum("l_quantity").alias("qty"),
                 F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
                 F.avg("l_discount").alias("avg_discount"), F.count("*").alias("line_count")))


@panel
def nation_lags(t: Tables) -> DataFrame:
    return add_lags(nation_month(t), "entity", "period", ["avg_price"], [1, 12])


@panel
def scenario_fc(t: Tables) -> DataFrame:
    """Prediction long table (period, entity, scenario, pred, pred_log):
    the last 12 months of the nation panel, base = all orders, low / high =
    the low / high priority bands (which may cross)."""
    nm = nation_month(t)
    last = nm.select(F.max("period")).scalar()
    recent = nm.filter(F.col("period") >= F.add_months(last, -(SCENARIO_MONTHS - 1)))
    arr = F.array(*[F.struct(F.lit(s).alias("scenario"), F.col(c).alias("pred"))
                    for s, c in (("base", "avg_price"), ("low", "avg_price_low"), ("high", "avg_price_high"))])
    x = recent.select("period", "entity", F.explode(arr).alias("s")).select("period", "entity", "s.*")
    return x.filter(F.col("pred").isNotNull()).withColumn("pred_log", F.log("pred"))


@panel
def attrib_long(t: Tables) -> DataFrame:
    """Attribution long table of a linear model over scenario_fc rows:
    shap = weight * (x - mean x); region one-hot dummies ``cat__Region_<r>``."""
    fc = scenario_fc(t)
    lg = nation_lags(t).select("period", "entity", "region", "sales_count", "avg_price_lag1", "avg_price_lag12")
    b = fc.join(lg, ["period", "entity"])
    xs = {"sales_count": F.log("sales_count"), "avg_price_lag1": F.log("avg_price_lag1"),
          "avg_price_lag12": F.log("avg_price_lag12"), "pred_level": F.col("pred_log")}
    arr = F.array(*[F.struct(F.lit(f).alias("feature"), x.alias("feature_value"),
                             F.lit(ATTRIB_WEIGHTS[f]).alias("weight")) for f, x in xs.items()])
    num = b.select("period", "entity", "scenario", F.explode(arr).alias("s")).select(
        "period", "entity", "scenario", "s.*")
    regions = t("region").select(F.col("r_name"))
    dm = repeat_for_each(b.select("period", "entity", "scenario", "region"), regions)
    dm = dm.select("period", "entity", "scenario", F.concat(F.lit("cat__Region_"), "r_name").alias("feature"),
                   F.when(F.col("r_name") == F.col("region"), 1.0).otherwise(0.0).alias("feature_value"),
                   F.lit(DUMMY_WEIGHT).alias("weight"))
    raw = num.unionByName(dm)
    means = raw.groupBy("feature").agg(F.avg("feature_value").alias("_mean"))
    shap = F.col("weight") * (F.col("feature_value") - F.col("_mean"))
    return (raw.join(means, "feature").filter(F.col("feature_value").isNotNull())
               .select("period", "entity", "scenario", "feature", "feature_value",
                       shap.alias("shap_value"), F.abs(shap).alias("abs_shap")))


@panel
def event_day(t: Tables) -> DataFrame:
    """(period=day, entity=event type, events, value_sum)."""
    return (t("events").groupBy(F.to_date("ts").alias("period"), F.col("event_type").alias("entity"))
            .agg(F.count("*").alias("events"), F.sum("value").alias("value_sum")))


@panel
def nation_quarter(t: Tables) -> DataFrame:
    """Quarterly view of the nation panel: (period=quarter start, entity, avg_price)."""
    nm = nation_month(t)
    return (nm.groupBy(F.trunc("period", "quarter").alias("period"), "entity")
            .agg((F.sum("total_price") / F.sum("sales_count")).alias("avg_price")))


@panel
def nation_year(t: Tables) -> DataFrame:
    nm = nation_month(t)
    return nm.groupBy(F.year("period").alias("year"), "entity").agg(
        F.sum("sales_count").alias("sales_count"), F.sum("total_price").alias("total_price"))


@panel
def date_text(t: Tables) -> DataFrame:
    """Order dates written as text in the formats met in statistics files
    (the format follows the order priority): ISO month, ISO day with
    slashes, day-first, quarter code, month code; plus a year text that is a
    clean year, a year with a decimal tail, or a total label."""
    o = t("orders").select("o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus", "o_totalprice")
    d, pr = F.to_date("o_orderdate"), F.col("o_orderpriority")
    txt = (F.when(pr == "1-URGENT", F.date_format(d, "yyyy-MM"))
           .when(pr == "2-HIGH", F.date_format(d, "yyyy/MM/dd"))
           .when(pr == "3-MEDIUM", F.date_format(d, "d/MM/yyyy"))
           .when(pr == "4-NOT SPECIFIED", F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string")))
           .otherwise(F.concat(F.year(d).cast("string"), F.lit("M"), F.lpad(F.month(d).cast("string"), 2, "0"))))
    st = F.col("o_orderstatus")
    ytxt = (F.when(st == "F", F.year(d).cast("string"))
            .when(st == "O", F.concat(F.year(d).cast("string"), F.lit(".0"))).otherwise(F.lit("Total")))
    return o.select("o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus", "o_totalprice",
                    txt.alias("txt"), ytxt.alias("year_txt"))


@panel
def ship_nation_month(t: Tables) -> DataFrame:
    """(period=ship month, entity=supplier nation, qty, avg_discount)."""
    l = t("lineitem").select("l_suppkey", "l_shipdate", "l_quantity", "l_discount")
    s = t("supplier").select("s_suppkey", "s_nationkey")
    g = (l.join(s, l["l_suppkey"] == s["s_suppkey"])
         .groupBy(month_of("l_shipdate").alias("period"), "s_nationkey")
         .agg(F.sum("l_quantity").alias("qty"), F.avg("l_discount").alias("avg_discount")))
    n = t("nation").select("n_nationkey", "n_name")
    return g.join(n, g["s_nationkey"] == n["n_nationkey"]).select(
        "period", F.col("n_name").alias("entity"), "qty", "avg_discount")


# ---------------------------------------------------------------------------
# SQL (DuckDB) definitions of the same panels, for the oracle queries.
CTE: dict[str, tuple[tuple[str, ...], str]] = {
    "nation_month": ((), """
  SELECT CAST(date_trunc('month', o.o_orderdate) AS DATE) AS period, n.n_name AS entity, r.r_name AS region,
         avg(o.o_totalprice) AS avg_price, count(*) AS sales_count, sum(o.o_totalprice) AS total_price,
         avg(CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o.o_totalprice END) AS avg_price_high,
         avg(CASE WHEN o.o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') THEN o.o_totalprice END) AS avg_price_low
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
       JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  GROUP BY 1, 2, 3"""),
    "market_month": ((), """
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period, avg(o_totalprice) AS avg_price,
         count(*) AS sales_count
  FROM orders GROUP BY 1"""),
    "supplier_month": ((), """
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS period, CAST(l_suppkey AS VARCHAR) AS entity,
         sum(l_quantity) AS qty, sum(l_extendedprice * (1 - l_discount)) AS revenue,
         avg(l_discount) AS avg_discount, count(*) AS line_count
  FROM lineitem GROUP BY 1, 2"""),
    "nation_lags": (("nation_month",), """
  SELECT *, lag(avg_price, 1) OVER w AS avg_price_lag1, lag(avg_price, 12) OVER w AS avg_price_lag12
  FROM nation_month WINDOW w AS (PARTITION BY entity ORDER BY period)"""),
    "scenario_fc": (("nation_month",), """
  SELECT period, entity, scenario, pred, ln(pred) AS pred_log FROM (
    SELECT period, entity, 'base' AS scenario, avg_price AS pred FROM nation_month
    UNION ALL SELECT period, entity, 'low', avg_price_low FROM nation_month
    UNION ALL SELECT period, entity, 'high', avg_price_high FROM nation_month) u
  WHERE pred IS NOT NULL
    AND period >= CAST((SELECT max(period) FROM nation_month) - INTERVAL 11 MONTH AS DATE)"""),
    "attrib_base": (("scenario_fc", "nation_lags"), """
  SELECT f.period, f.entity, f.scenario, f.pred_log, l.region, l.sales_count, l.avg_price_lag1, l.avg_price_lag12
  FROM scenario_fc f JOIN nation_lags l ON f.period = l.period AND f.entity = l.entity"""),
    "attrib_raw": (("attrib_base",), """
  SELECT period, entity, scenario, 'sales_count' AS feature, ln(sales_count) AS feature_value, 0.05::DOUBLE AS weight FROM attrib_base
  UNION ALL SELECT period, entity, scenario, 'avg_price_lag1', ln(avg_price_lag1), 0.4::DOUBLE FROM attrib_base
  UNION ALL SELECT period, entity, scenario, 'avg_price_lag12', ln(avg_price_lag12), 0.2::DOUBLE FROM attrib_base
  UNION ALL SELECT period, entity, scenario, 'pred_level', pred_log, 0.3::DOUBLE FROM attrib_base
  UNION ALL SELECT b.period, b.entity, b.scenario, 'cat__Region_' || r.r_name,
                   CASE WHEN r.r_name = b.region THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END, 0.02::DOUBLE
            FROM attrib_base b CROSS JOIN region r"""),
    "attrib_long": (("attrib_raw",), """
  SELECT a.period, a.entity, a.scenario, a.feature, a.feature_value,
         a.weight * (a.feature_value - m.mean_value) AS shap_value,
         abs(a.weight * (a.feature_value - m.mean_value)) AS abs_shap
  FROM attrib_raw a JOIN (SELECT feature, avg(feature_value) AS mean_value FROM attrib_raw GROUP BY feature) m
       ON a.feature = m.feature
  WHERE a.feature_value IS NOT NULL"""),
    "event_day": ((), """
  SELECT CAST(ts AS DATE) AS period, event_type AS entity, count(*) AS events, sum(value) AS value_sum
  FROM events GROUP BY 1, 2"""),
    "nation_quarter": (("nation_month",), """
  SELECT CAST(date_trunc('quarter', period) AS DATE) AS period, entity, sum(total_price) / sum(sales_count) AS avg_price
  FROM nation_month GROUP BY 1, 2"""),
    "date_text": ((), """
  SELECT o_orderkey, o_orderdate, o_orderpriority, o_orderstatus, o_totalprice,
         CASE o_orderpriority WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y-%m')
              WHEN '2-HIGH' THEN strftime(o_orderdate, '%Y/%m/%d')
              WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%-d/%m/%Y')
              WHEN '4-NOT SPECIFIED' THEN CAST(year(o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o_orderdate) AS VARCHAR)
              ELSE strftime(o_orderdate, '%YM%m') END AS txt,
         CASE o_orderstatus WHEN 'F' THEN CAST(year(o_orderdate) AS VARCHAR)
              WHEN 'O' THEN CAST(year(o_orderdate) AS VARCHAR) || '.0' ELSE 'Total' END AS year_txt
  FROM orders"""),
    "ship_nation_month": ((), """
  SELECT CAST(date_trunc('month', l.l_shipdate) AS DATE) AS period, n.n_name AS entity,
         sum(l.l_quantity) AS qty, avg(l.l_discount) AS avg_discount
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey
  GROUP BY 1, 2"""),
    "nation_year": (("nation_month",), """
  SELECT year(period) AS year, entity, CAST(sum(sales_count) AS BIGINT) AS sales_count, sum(total_price) AS total_price
  FROM nation_month GROUP BY 1, 2"""),
}


def _deps(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        if n in out:
            return
        for d in CTE[n][0]:
            visit(d)
        out.append(n)
    for n in names:
        visit(n)
    return out


def with_ctes(names, body: str, extra: str = "") -> str:
    """``WITH`` clause of the named panels (and their dependencies), optional
    extra CTE text, then the body."""
    parts = [f"{n} AS ({CTE[n][1]}\n)" for n in _deps(names)]
    if extra:
        parts.append(extra.strip().rstrip(","))
    b = body.strip()
    if not parts:
        return b if b.upper().startswith(("SELECT", "WITH", "(")) else "WITH " + b
    if not b.upper().startswith(("SELECT", "WITH", "(")):
        # the body opens with more CTEs: continue the list
        return "WITH " + ",\n".join(parts) + ",\n" + b
    return "WITH " + ",\n".join(parts) + "\n" + b if parts else b
