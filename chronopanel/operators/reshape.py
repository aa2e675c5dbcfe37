"""Sorting, limits, set operations, reshaping and splitting (L, U, D)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._util import as_list, col
from .joins import repeat_for_each
from .windows import rank_columns

__all__ = [
    "sort_output", "top_k", "investment_ranks", "leaders", "preview", "union_entities", "to_long",
    "union_splits", "union_first", "stitch", "make_scenarios", "split_scenarios",
    "yearly_to_monthly", "future_periods", "time_split", "capped_sample",
]


# L01-L04 -------------------------------------------------------------------
def sort_output(df: DataFrame, keys, order: dict | None = None) -> DataFrame:
    """Multi-key output sort; ``order`` maps a column to an explicit value
    order (``array_position`` of a literal list)."""
    exprs = []
    for k in as_list(keys):
        if order and k in order:
            exprs.append(F.array_position(F.array(*[F.lit(v) for v in order[k]]), F.col(k)))
        exprs.append(F.col(k))
    return df.orderBy(*exprs)


def top_k(df: DataFrame, c: str, k: int, desc: bool = True, tie=()) -> DataFrame:
    """First ``k`` rows by one metric with a deterministic tie-break
    (planned as TakeOrderedAndProject: a per-partition top-k, then a merge)."""
    o = F.desc_nulls_last(c) if desc else F.asc_nulls_last(c)
    return df.orderBy(o, *[F.asc(t) for t in as_list(tie)]).limit(k)


def investment_ranks(metrics: DataFrame) -> DataFrame:
    """Ranks of an entity-level metrics table: stability and return (highest
    first), volatility, size of the drawdown and scenario spread (lowest
    first), and the sum of the last three."""
    x = metrics.withColumn("downside_abs", F.abs("downside_max_drawdown_low"))
    named = {"rank_stability": ("stability_score", True), "rank_return": ("expected_return_base", True), "rank_vol": ("volatility_base", False),
             "rank_downside": ("downside_abs", False), "rank_spread": ("scenario_spread_high_minus_low", False)}
    x = rank_columns(x, dict(named.values()), total=None)
    x = x.withColumnsRenamed({f"rank_{c}": r for r, (c, _) in named.items()})
    return x.withColumn("defensive_rank_sum", F.col("rank_vol") + F.col("rank_downside") + F.col("rank_spread"))


def leaders(metrics: DataFrame, k: int = 3, entity: str = "entity") -> DataFrame:
    """Leader boards over an entity-level metrics table: the ``k`` most stable
    (ties by return), highest return (ties by stability) and most defensive
    (smallest sum of the volatility, drawdown and spread ranks, ties by
    stability), and the one with the highest risk (drawdown size, spread,
    volatility). Missing metrics come last. ``metrics`` may be ranked already
    (``investment_ranks``). One pass: each row is fanned out
    to the boards and ranked by one window partitioned by board, of which
    Spark keeps ``k`` rows a task before the shuffle."""
    x = metrics if "defensive_rank_sum" in metrics.columns else investment_ranks(metrics)
    neg = lambda c: -F.col(c)
    specs = [("stable", F.col("stability_score"), [neg("stability_score"), neg("expected_return_base")], k),
             ("return", F.col("expected_return_base"), [neg("expected_return_base"), neg("stability_score")], k),
             ("defensive", F.col("defensive_rank_sum"), [F.col("defensive_rank_sum"), neg("stability_score")], k),
             ("risk", F.col("downside_abs"), [neg("downside_abs"), neg("scenario_spread_high_minus_low"), neg("volatility_base")], 1)]
    arr = F.array(*[F.struct(F.lit(name).alias("board"), m.cast("double").alias("metric_value"), F.lit(n).alias("_k"),
                             *[(o[i] if i < len(o) else F.lit(0.0)).cast("double").alias(f"_o{i}") for i in range(3)]) for name, m, o, n in specs])
    x = x.select(entity, F.explode(arr).alias("s")).select(entity, "s.*")
    w = Window.partitionBy("board").orderBy(*[F.asc_nulls_last(f"_o{i}") for i in range(3)], entity)
    return (x.withColumn("position", F.row_number().over(w)).filter((F.col("position") <= k) & (F.col("position") <= F.col("_k")))
             .select("board", entity, "metric_value", "position"))


def preview(df: DataFrame, n: int, order=()) -> DataFrame:
    """First ``n`` rows (ordered) with the total row count on each row."""
    total = df.select(F.count("*")).scalar()
    d = df.orderBy(*as_list(order)) if order else df
    return d.limit(n).withColumn("total_rows", total)


# U01-U05 -------------------------------------------------------------------
def union_entities(tables: dict, entity: str = "entity") -> DataFrame:
    """Union of per-entity tables, tagging each with its entity name."""
    parts = [df.withColumn(entity, F.lit(name)) for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def to_long(df: DataFrame, ids, cols, var: str = "variable", value: str = "value") -> DataFrame:
    return df.unpivot(as_list(ids), as_list(cols), var, value)


def union_splits(a: DataFrame, b: DataFrame, drop_missing_cols=()) -> DataFrame:
    """Union of two splits that must have equal column sets; rows with a
    missing value in ``drop_missing_cols`` are dropped."""
    if set(a.columns) != set(b.columns):
        miss = sorted(set(a.columns) ^ set(b.columns))
        raise ValueError(f"column sets differ: {miss}")
    u = a.unionByName(b)
    return u.dropna(subset=as_list(drop_missing_cols)) if drop_missing_cols else u


def union_first(dfs, key: str, n: int | None = None, order=()) -> DataFrame:
    """Union, keep the first occurrence of each key (earlier input wins,
    then ``order``), optionally the first ``n`` keys."""
    parts = [d.withColumn("_src", F.lit(i)) for i, d in enumerate(dfs)]
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    o = [F.col("_src")] + [col(c) for c in as_list(order)]
    w = Window.partitionBy(key).orderBy(*o)
    u = u.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
    if n:
        u = u.orderBy(*o, key).limit(n)
    return u.drop("_rn", "_src")


def stitch(hist: DataFrame, fc: DataFrame, label: str = "series") -> DataFrame:
    return (hist.withColumn(label, F.lit("history"))
            .unionByName(fc.withColumn(label, F.lit("forecast")), allowMissingColumns=True))


# U06-U09 -------------------------------------------------------------------
def make_scenarios(base: DataFrame, factors: dict, months: int, period: str = "period",
                   value: str = "value", start=None, by=()) -> DataFrame:
    """Scenario paths: the base value (one row per group) times a factor per
    scenario, for ``months`` months from ``start`` (a Column; default the
    month after the group's period)."""
    by = as_list(by)
    sc = base.sparkSession.createDataFrame([(k, float(v)) for k, v in factors.items()],
                                           "scenario string, factor double")
    first = start if start is not None else F.add_months(F.col(period), 1)
    x = base.select(*by, first.alias("_start"), F.col(value).alias("_v"))
    x = x.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(months - 1))))
    x = repeat_for_each(x, sc)
    return x.select(F.add_months("_start", F.col("_k")).alias(period), *by, "scenario",
                    (F.col("_v") * F.col("factor")).alias(value))


def split_scenarios(df: DataFrame, path: str | None = None, scenario: str = "scenario",
                    expected=("base", "low", "high")) -> DataFrame:
    """Check every expected scenario is present (one aggregate), optionally
    write the table partitioned by scenario; returns the per-scenario counts."""
    counts = df.groupBy(scenario).agg(F.count("*").alias("rows"))
    got = {r[scenario]: r["rows"] for r in counts.filter(F.col(scenario).isin(*expected)).collect()}
    empty = [s for s in expected if not got.get(s)]
    if empty:
        raise ValueError(f"empty scenarios: {empty}")
    if path:
        df.write.mode("overwrite").partitionBy(scenario).parquet(path)
    return counts


def yearly_to_monthly(df: DataFrame, year: str, value: str, how: str = "repeat",
                      out: str = "period", digits: int | None = None) -> DataFrame:
    """Twelve monthly rows per yearly row: the value repeated, or divided by
    12; ``digits`` rounds half-even (as pandas does)."""
    x = df.withColumn("_m", F.explode(F.sequence(F.lit(1), F.lit(12))))
    v = F.col(value) if how == "repeat" else F.col(value) / 12.0
    v = F.bround(v, digits) if digits is not None else v
    return x.withColumn(out, F.make_date(F.col(year).cast("int"), F.col("_m"), F.lit(1))) \
            .withColumn(value, v).drop("_m")


def future_periods(df: DataFrame, period: str = "period", horizon: int = 12) -> DataFrame:
    """The ``horizon`` months after the last observed month (one column)."""
    last = df.select(F.max(period)).scalar()
    s = df.sparkSession.range(1)
    return s.select(F.explode(F.sequence(F.add_months(last, 1), F.add_months(last, horizon),
                                         F.expr("interval 1 month"))).alias(period))


# D01 / D02 -----------------------------------------------------------------
def time_split(df: DataFrame, period: str, ranges: dict, out: str = "split") -> DataFrame:
    """Tag rows by inclusive period ranges {name: (start, end)}; rows in no
    range are dropped."""
    expr = None
    for name, (a, b) in ranges.items():
        cond = F.col(period).between(F.lit(a).cast("date"), F.lit(b).cast("date"))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return df.withColumn(out, expr).filter(F.col(out).isNotNull())


def capped_sample(df: DataFrame, n: int, key, by=(), seed: int = 42) -> DataFrame:
    """At most ``n`` rows per group (or overall), chosen by the MD5 of the
    key's text and the seed: the same rows whatever the partitioning, and in
    any engine."""
    h = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in as_list(key)], F.lit(str(seed))).cast("binary"))
    by = as_list(by)
    if not by:
        return df.withColumn("_h", h).orderBy("_h", *as_list(key)).limit(n).drop("_h")
    w = Window.partitionBy(*by).orderBy(h, *as_list(key))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")
