"""Aggregations.

Every operator is one or two ``groupBy`` / ``agg`` stages. Group totals are
attached with scalar subqueries or a keyed join, never with an unpartitioned
window over fact rows. Quantiles of fact columns are exact with linear
interpolation (``exact_quantiles``: small groups directly, large ones by
bracketing); ``percentile`` alone is used only where a group is bounded by the
calendar (one row per period).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._util import as_list

__all__ = [
    "collapse", "series_by", "trailing_shares", "winsorized_mean", "trimmed_mean",
    "describe_numeric", "group_stats", "skewness_g1", "corr_matrix", "missing_summary",
    "overview", "regression_metrics", "benchmark_profile", "investment_metrics",
    "top_drivers", "horizon_drivers", "rank_entities", "coverage", "infer_frequency",
    "importance", "available", "scenario_fan", "weighted_mean", "model_selection",
    "split_summary", "forecast_path", "exact_quantiles", "quantile_table", "row_fingerprint",
]


# A01 -----------------------------------------------------------------------
def collapse(df: DataFrame, period: str, cols, how="sum", order=()) -> DataFrame:
    """Collapse a panel to one series row per period. ``how`` is one
    aggregate name for all columns or a dict column -> name. A ``sum`` over
    only-missing values gives 0 (pandas semantics). ``first`` takes the first
    present value by the ``order`` columns, which it needs; among rows that
    tie there, the smallest value."""
    cols, order = as_list(cols), as_list(order)
    hows = how if isinstance(how, dict) else {c: how for c in cols}
    aggs, medians = [], []
    for c in cols:
        h = hows[c]
        if h == "sum":
            aggs.append(F.coalesce(F.sum(c), F.lit(0)).alias(c))
        elif h == "mean":
            aggs.append(F.avg(c).alias(c))
        elif h == "first":
            if not order:
                raise ValueError("how='first' needs order columns")
            aggs.append(F.min_by(c, F.when(F.col(c).isNotNull(), F.struct(*order, c))).alias(c))
        elif h in ("min", "max"):
            aggs.append(getattr(F, h)(c).alias(c))
        elif h == "median":
            medians.append(c)
        else:
            raise ValueError(f"unknown aggregate {h!r}")
    out = df.groupBy(period).agg(*aggs, F.count("*").alias("_n")).drop("_n")
    for c in medians:
        out = _join_keys(out, exact_quantiles(df, c, [0.5], [period]).select(period, F.col("q").alias(c)), [period])
    return out.select(period, *cols)


# A02 -----------------------------------------------------------------------
def series_by(df: DataFrame, keys, value: str, agg: str = "mean", order: str | None = None,
              out: str | None = None) -> DataFrame:
    """Group a value by keys with a selectable aggregate: mean, median, sum,
    min, max, count, or first (smallest ``order``; deterministic)."""
    out = out or value
    v = F.col(value)
    if agg == "mean":
        a = F.avg(v)
    elif agg == "median":
        g = df.groupBy(*as_list(keys)).agg(F.count(v).alias("_n"))
        q = exact_quantiles(df, value, [0.5], keys).select(*as_list(keys), F.col("q").alias(out))
        return _join_keys(g, q, as_list(keys)).select(*as_list(keys), out)
    elif agg == "sum":
        a = F.coalesce(F.sum(v), F.lit(0))
    elif agg in ("min", "max", "count"):
        a = getattr(F, agg)(v)
    elif agg == "first":
        if order is None:
            raise ValueError("agg='first' needs an order column")
        a = F.min_by(v, F.struct(F.col(order), v))
    else:
        raise ValueError(f"unknown aggregate {agg!r}")
    return df.groupBy(*as_list(keys)).agg(a.alias(out))


# A03 -----------------------------------------------------------------------
def trailing_shares(df: DataFrame, period: str, entity: str, value: str, months: int = 12,
                    out: str = "share") -> DataFrame:
    """Share of each entity in the total of the last ``months`` periods
    (counted back from the latest period in the data, inclusive)."""
    last = df.select(F.max(period)).scalar()
    recent = df.filter(F.col(period) >= F.add_months(last, -(months - 1)))
    per = recent.groupBy(entity).agg(F.sum(value).alias("total"))
    grand = recent.select(F.sum(value)).scalar()
    return per.select(entity, F.try_divide(F.col("total"), grand).alias(out))


# A04 / A05 -----------------------------------------------------------------
def _clip_bounds(df: DataFrame, value: str, lo_p: float, hi_p: float, by) -> DataFrame:
    """Rows of ``df`` (``value`` present, not NaN) with the group's lower and
    upper quantiles attached as ``_lo`` / ``_hi``."""
    by = as_list(by)
    x = df.select(*by, value).filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    qt = exact_quantiles(x, value, [lo_p, hi_p], by)
    at = lambda p: F.max(F.when(F.col("p") == p, F.col("q")))
    if not by:
        return x.withColumn("_b", qt.agg(F.struct(at(lo_p).alias("lo"), at(hi_p).alias("hi")).alias("b")).select("b").scalar()).select(
            value, F.col("_b.lo").alias("_lo"), F.col("_b.hi").alias("_hi"))
    return _join_keys(x, qt.groupBy(*by).agg(at(lo_p).alias("_lo"), at(hi_p).alias("_hi")), by)


def _join_keys(left: DataFrame, right: DataFrame, by: list[str], how: str = "left") -> DataFrame:
    """Join on keys where NULL equals NULL, as in a grouping."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in by], *[c for c in right.columns if c not in by])
    cond = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in by]
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in by])


def winsorized_mean(df: DataFrame, value: str, limit: float, by=(), out: str = "winsorized_mean") -> DataFrame:
    """Mean after clipping at the exact ``limit`` and ``1-limit`` quantiles."""
    x = _clip_bounds(df, value, limit, 1 - limit, by)
    clipped = F.greatest(F.col("_lo"), F.least(F.col("_hi"), F.col(value)))
    return x.groupBy(*as_list(by)).agg(F.avg(clipped).alias(out))


def trimmed_mean(df: DataFrame, value: str, ratio: float, by=(), out: str = "trimmed_mean") -> DataFrame:
    """Mean of the values between the exact ``ratio`` and ``1-ratio`` quantiles."""
    x = _clip_bounds(df, value, ratio, 1 - ratio, by)
    keep = (F.col(value) >= F.col("_lo")) & (F.col(value) <= F.col("_hi"))
    return x.groupBy(*as_list(by)).agg(F.avg(F.when(keep, F.col(value))).alias(out))


# A06 -----------------------------------------------------------------------
DESCRIBE_PROBS = (0.01, 0.05, 0.5, 0.95, 0.99)


def describe_numeric(df: DataFrame, cols, probs=DESCRIBE_PROBS) -> DataFrame:
    """count, mean, std, min, quantiles, max per column, one row per column.
    The moments come from one aggregate; the quantiles of all columns from one
    ``exact_quantiles`` over (column, value) pairs. A column without any value
    keeps its row."""
    cols = as_list(cols)
    structs = [F.struct(F.lit(c).alias("column"), F.count(c).cast("bigint").alias("count"), F.avg(c).alias("mean"),
                        F.stddev_samp(c).alias("std"), F.min(F.col(c).cast("double")).alias("min"),
                        F.max(F.col(c).cast("double")).alias("max")) for c in cols]
    long = df.agg(F.array(*structs).alias("a")).select(F.explode("a").alias("s")).select("s.*")
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols])).alias("s"))
    names = [f"p{int(round(p * 100))}" for p in probs]
    q = exact_quantiles(pairs.select("s.column", "s.v"), "v", probs, ["column"]).groupBy("column").agg(
        *[F.max(F.when(F.col("p") == float(p), F.col("q"))).alias(n) for p, n in zip(probs, names)])
    return long.join(q, "column", "left").select("column", "count", "mean", "std", "min", *names, "max")


# A07 -----------------------------------------------------------------------
def group_stats(df: DataFrame, entity: str, value: str) -> DataFrame:
    """n, mean, median, std, min, max, quartiles, IQR and coefficient of
    variation per entity (missing values dropped first)."""
    d = df.filter(F.col(value).isNotNull() & F.col(entity).isNotNull()).select(
        F.col(entity).cast("string").alias(entity), value)
    g = d.groupBy(entity).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
                              F.min(value).alias("min"), F.max(value).alias("max"))
    at = lambda p: F.max(F.when(F.col("p") == p, F.col("q")))
    q = exact_quantiles(d, value, [0.25, 0.5, 0.75], [entity]).groupBy(entity).agg(
        at(0.25).alias("q25"), at(0.5).alias("median"), at(0.75).alias("q75"))
    return g.join(q, entity, "left").select(
        entity, "n", "mean", "median", "std", "min", "max", "q25", "q75", (F.col("q75") - F.col("q25")).alias("iqr"),
        F.when(F.col("mean") != 0, F.col("std") / F.col("mean")).alias("cv"))


# A08 -----------------------------------------------------------------------
def skewness_g1(df: DataFrame, cols) -> DataFrame:
    """Bias-corrected sample skewness per column (pandas ``skew``):
    ``g1 * sqrt(n(n-1)) / (n-2)``; NULL for fewer than 3 values."""
    structs = []
    for c in as_list(cols):
        n = F.count(c)
        structs.append(F.struct(F.lit(c).alias("column"),
                                F.when(n >= 3, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2)).alias("skewness")))
    return df.agg(F.array(*structs).alias("a")).select(F.explode("a").alias("s")).select("s.*")


# A09 -----------------------------------------------------------------------
def corr_matrix(df: DataFrame, cols) -> DataFrame:
    """Pearson correlation of every column pair (pairwise complete rows), in
    long form (col_a, col_b, corr), both orders and the diagonal. One
    aggregate computes the m(m+1)/2 distinct pairs."""
    cols = as_list(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    structs = [F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                        F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias("corr"))
               for a, b in pairs]
    upper = df.agg(F.array(*structs).alias("a")).select(F.explode("a").alias("s")).select("s.*")
    lower = upper.filter(F.col("col_a") != F.col("col_b")).select(
        F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "corr")
    return upper.unionByName(lower)


# A10 -----------------------------------------------------------------------
def missing_summary(df: DataFrame, cols=None, top: int | None = None) -> DataFrame:
    """Missing count and fraction per column (NaN counts as missing for
    floating columns), largest first; ``top`` keeps the first k."""
    fields = {f.name: f.dataType.typeName() for f in df.schema.fields}
    cols = as_list(cols) or list(fields)
    structs = []
    for c in cols:
        miss = F.col(c).isNull()
        if fields[c] in ("double", "float"):
            miss = miss | F.isnan(c)
        structs.append(F.struct(F.lit(c).alias("column"), F.count_if(miss).cast("bigint").alias("missing_count")))
    out = (df.agg(F.count("*").alias("n"), F.array(*structs).alias("a"))
           .select("n", F.explode("a").alias("s"))
           .select("s.column", "s.missing_count",
                   F.when(F.col("n") > 0, F.col("s.missing_count") / F.col("n")).alias("missing_pct")))
    if top:
        out = out.orderBy(F.desc("missing_count"), "column").limit(top)
    return out


# A11 -----------------------------------------------------------------------
def row_fingerprint(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes of a whole row: equal rows have equal ones, unequal
    rows differ but for a chance of 2^-128 a pair. Which values are missing
    enters as text, since the hash passes over them; nested values enter as
    JSON for the same reason."""
    flat = [F.to_json(F.struct(F.col(f"`{f.name}`"))) if f.dataType.typeName() in ("array", "map", "struct", "variant") else F.col(f"`{f.name}`")
            for f in df.schema.fields]
    gaps = F.concat(*[F.when(F.col(f"`{f.name}`").isNull(), "0").otherwise("1") for f in df.schema.fields])
    return [F.xxhash64(gaps, *flat).alias("_h1"), F.xxhash64(*flat[::-1], gaps, F.lit(1)).alias("_h2")]


def overview(df: DataFrame, period: str) -> DataFrame:
    """rows, columns, first and last period, duplicate rows (one row). Rows
    are told apart by a 128-bit fingerprint, which is all that is shuffled."""
    n_distinct = df.select(*row_fingerprint(df)).distinct().select(F.count("*")).scalar()
    return df.agg(F.count("*").alias("rows"), F.min(period).alias("period_min"),
                  F.max(period).alias("period_max")).select(
        "rows", F.lit(len(df.columns)).cast("bigint").alias("cols"), "period_min", "period_max",
        (F.col("rows") - n_distinct).alias("duplicate_rows"))


# A12 -----------------------------------------------------------------------
def regression_metrics(df: DataFrame, y: str, yhat: str, by=(), log_scale: bool = True) -> DataFrame:
    """RMSE, MAE, R2 in ONE aggregate. With ``log_scale`` the inputs are
    logs and the level-scale metrics use ``exp`` of both."""
    def block(a: Column, b: Column, sfx: str):
        e = a - b
        return [F.sqrt(F.avg(e * e)).alias(f"rmse{sfx}"), F.avg(F.abs(e)).alias(f"mae{sfx}"),
                (1 - F.try_divide(F.sum(e * e), F.count(e) * F.var_pop(a))).alias(f"r2{sfx}")]
    d = df.filter(F.col(y).isNotNull() & F.col(yhat).isNotNull())
    aggs = [F.count("*").alias("n")]
    if log_scale:
        aggs += block(F.col(y), F.col(yhat), "_log") + block(F.exp(y), F.exp(yhat), "_level")
    else:
        aggs += block(F.col(y), F.col(yhat), "")
    return d.groupBy(*as_list(by)).agg(*aggs)


# A13 -----------------------------------------------------------------------
def benchmark_profile(entity_df: DataFrame, bench_df: DataFrame, period: str, entity: str,
                      value: str, bench_value: str, min_common: int = 6) -> DataFrame:
    """Each entity against a benchmark series on their common periods:
    mean and median of the value ratio, std of the entity's log returns
    (over common periods), and their correlation with the benchmark's log
    returns (taken over the benchmark's own full calendar). Entities with
    fewer than ``min_common`` common periods are dropped."""
    b = bench_df.select(period, F.col(bench_value).alias("_b"))
    b = b.withColumn("_blr", F.log("_b") - F.log(F.lag("_b").over(Window.orderBy(period))))
    e = entity_df.select(entity, period, F.col(value).alias("_v"))
    j = e.join(b, on=period, how="inner")
    w = Window.partitionBy(entity).orderBy(period)
    j = j.withColumn("_lr", F.log("_v") - F.log(F.lag("_v").over(w)))
    ratio = F.try_divide(F.col("_v"), F.col("_b"))
    both = F.col("_lr").isNotNull() & F.col("_blr").isNotNull()
    g = j.groupBy(entity).agg(
        F.count("*").alias("n_common"), F.avg(ratio).alias("avg_ratio"),
        F.percentile(ratio, 0.5).alias("median_ratio"), F.stddev_samp("_lr").alias("volatility"),
        F.count_if(both).alias("_np"), F.corr(F.when(both, F.col("_lr")), F.when(both, F.col("_blr"))).alias("_c"))
    return g.filter(F.col("n_common") >= min_common).select(
        entity, "n_common", "avg_ratio", "median_ratio", "volatility",
        F.when(F.col("_np") >= min_common, F.col("_c")).alias("corr_log_return"))


# A14 -----------------------------------------------------------------------
def investment_metrics(fc: DataFrame, period: str = "period", entity: str = "entity",
                       scenario: str = "scenario", price: str = "pred", horizon: int = 12,
                       anchor=None) -> DataFrame:
    """Per entity, over the window [anchor, anchor + horizon months]:
    base return first-to-last available, std of base monthly returns, max
    drawdown of the low path, high-minus-low spread at the last available
    month of each, and return / volatility, with return and drawdown also in
    percent. The anchor is the first base month of the entity (or a fixed
    month). Rows come by stability, then return, highest first."""
    x = (fc.select(entity, period, F.lower(F.trim(scenario)).alias("_sc"), F.col(price).cast("double").alias("_p"))
         .filter(F.col(entity).isNotNull() & F.col(period).isNotNull() & F.col("_p").isNotNull()))
    if anchor is None:
        # per-entity window: the same hash partitioning on the entity serves
        # this window, the scenario windows and the final aggregate (one exchange)
        we = Window.partitionBy(entity)
        x = x.withColumn("_anchor", F.coalesce(F.min(F.when(F.col("_sc") == "base", F.col(period))).over(we),
                                               F.min(period).over(we)))
    else:
        x = x.withColumn("_anchor", F.lit(anchor).cast("date"))
    x = x.filter((F.col(period) >= F.col("_anchor")) & (F.col(period) <= F.add_months("_anchor", horizon)))
    w = Window.partitionBy(entity, "_sc").orderBy(period)
    x = (x.withColumn("_ret", F.try_divide(F.col("_p"), F.lag("_p").over(w)) - 1)
         .withColumn("_dd", F.try_divide(F.col("_p"), F.max("_p").over(w.rowsBetween(Window.unboundedPreceding, 0))) - 1))
    base, low, high = (F.col("_sc") == "base"), (F.col("_sc") == "low"), (F.col("_sc") == "high")
    g = x.groupBy(entity).agg(
        F.min("_anchor").alias("anchor"),
        F.count_if(base).alias("_nb"), F.count_if(low).alias("_nl"),
        F.min_by("_p", F.when(base, F.col(period))).alias("current_price_base"),
        F.max_by("_p", F.when(base, F.col(period))).alias("forecast_price_base_h"),
        F.stddev_samp(F.when(base, F.col("_ret"))).alias("_vol"),
        F.count(F.when(base, F.col("_ret"))).alias("_nr"),
        F.min(F.when(low, F.col("_dd"))).alias("_dd"),
        F.max_by("_p", F.when(high, F.col(period))).alias("_hi_last"),
        F.max_by("_p", F.when(low, F.col(period))).alias("_lo_last"))
    g = g.filter(F.col("_nb") >= 2)
    ret = F.when(F.col("current_price_base") != 0,
                 (F.col("forecast_price_base_h") - F.col("current_price_base")) / F.col("current_price_base"))
    vol = F.when(F.col("_nr") >= 2, F.col("_vol"))
    return g.select(
        entity, F.date_format("anchor", "yyyy-MM").alias("anchor_month"),
        F.lit(horizon).alias("horizon_months"), "current_price_base", "forecast_price_base_h",
        ret.alias("expected_return_base"), vol.alias("volatility_base"),
        F.when(F.col("_nl") >= 2, F.col("_dd")).alias("downside_max_drawdown_low"),
        (F.col("_hi_last") - F.col("_lo_last")).alias("scenario_spread_high_minus_low"),
        F.when(vol > 0, ret / vol).alias("stability_score"),
        F.bround(ret * 100, 2).alias("expected_return_base_pct"),
        F.bround(F.when(F.col("_nl") >= 2, F.col("_dd")) * 100, 2).alias("downside_max_drawdown_low_pct")).orderBy(
        F.desc_nulls_last("stability_score"), F.desc_nulls_last("expected_return_base"), entity)


# A15 / A16 -----------------------------------------------------------------
def top_drivers(long: DataFrame, k: int = 6, keys=(), feature: str = "feature",
                shap: str = "shap_value", abs_col: str | None = "abs_shap") -> DataFrame:
    """Mean magnitude and mean signed attribution per feature for each slice
    ``keys`` (filter the slice first), top ``k`` by magnitude per slice."""
    keys = as_list(keys)
    mag = F.col(abs_col) if abs_col else F.abs(shap)
    g = (long.filter(mag.isNotNull()).groupBy(*keys, F.trim(feature).alias(feature))
         .agg(F.avg(mag).alias("magnitude"), F.avg(shap).alias("shap_mean")))
    w = Window.partitionBy(*keys).orderBy(F.desc("magnitude"), feature) if keys else \
        Window.orderBy(F.desc("magnitude"), feature)
    g = g.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= max(1, k))
    return g.withColumn("direction", F.when(F.col("shap_mean") > 0, "up").when(F.col("shap_mean") < 0, "down"))


def horizon_drivers(long: DataFrame, keys, k: int = 5, feature: str = "feature",
                    shap: str = "shap_value") -> DataFrame:
    """Mean attribution per (slice, feature) over all periods, split into
    the top ``k`` upward (>0) drivers by mean magnitude and the top ``k``
    downward (<0) drivers by mean attribution, lowest first."""
    keys = as_list(keys)
    g = long.groupBy(*keys, feature).agg(F.avg(shap).alias("mean_shap"),
                                         F.avg(F.abs(shap)).alias("mean_abs_shap"))
    g = g.withColumn("side", F.when(F.col("mean_shap") > 0, "up").when(F.col("mean_shap") < 0, "down"))
    g = g.filter(F.col("side").isNotNull())
    w = Window.partitionBy(*keys, "side").orderBy(F.when(F.col("side") == "up", -F.col("mean_abs_shap")).otherwise(F.col("mean_shap")), feature)
    return g.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


# A17 -----------------------------------------------------------------------
def rank_entities(fc: DataFrame, value: str = "pred", entity: str = "entity",
                  period: str = "period", how: str = "mean", k: int = 5,
                  highest: bool = True) -> DataFrame:
    """Rank entities by a value aggregated over periods (mean, max, min or
    last), top ``k`` with a name tie-break. Filter the slice first."""
    if how == "last":
        a = F.max_by(value, period)
    elif how in ("mean", "avg"):
        a = F.avg(value)
    elif how in ("max", "min"):
        a = getattr(F, how)(value)
    else:
        raise ValueError(how)
    g = fc.groupBy(entity).agg(a.alias("score"))
    o = F.desc("score") if highest else F.asc("score")
    return g.filter(F.col("score").isNotNull()).orderBy(o, entity).limit(k)


# A18 / A19 -----------------------------------------------------------------
def coverage(df: DataFrame, entity: str, period: str) -> DataFrame:
    """Distinct periods, first and last period per entity."""
    return df.groupBy(entity).agg(F.count_distinct(period).alias("n_periods"),
                                  F.min(period).alias("first_period"), F.max(period).alias("last_period"))


def infer_frequency(df: DataFrame, period: str) -> DataFrame:
    """Median day gap between consecutive distinct periods: Monthly when in
    [25, 35], Irregular otherwise, Unknown with fewer than 3 periods."""
    d = df.select(period).filter(F.col(period).isNotNull()).distinct()
    d = d.withColumn("_gap", F.datediff(F.col(period), F.lag(period).over(Window.orderBy(period))))
    g = d.agg(F.count("*").alias("n_periods"), F.percentile("_gap", 0.5).alias("median_gap_days"))
    return g.select("n_periods", "median_gap_days",
                    F.when(F.col("n_periods") < 3, "Unknown")
                    .when(F.col("median_gap_days").between(25, 35), "Monthly")
                    .otherwise("Irregular").alias("frequency"))


# A20 / A21 -----------------------------------------------------------------
def importance(long: DataFrame, feature: str = "feature", shap: str = "shap_value") -> DataFrame:
    """Global importance: mean absolute attribution per feature."""
    return long.groupBy(feature).agg(F.avg(F.abs(shap)).alias("mean_abs_shap"))


def available(df: DataFrame, cols) -> DataFrame:
    """(column, value) rows of the distinct values of each column, for menus
    and validation; as many rows as there are values."""
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in as_list(cols)])
    return df.select(F.explode(arr).alias("s")).select("s.*").distinct()


# A22 -----------------------------------------------------------------------
def scenario_fan(fc: DataFrame, keys=("period", "entity"), scenario: str = "scenario",
                 cols=("pred_log", "pred"), scenarios=("base", "low", "high")) -> DataFrame:
    """Pivot scenarios to columns ``<col>_<scenario>`` and repair crossed
    bands: where low > high both level and log columns are swapped."""
    keys = as_list(keys)
    aggs = [F.max(F.when(F.col(scenario) == s, F.col(c))).alias(f"{c}_{s}") for s in scenarios for c in cols]
    w = fc.groupBy(*keys).agg(*aggs)
    if "low" in scenarios and "high" in scenarios:
        lead = cols[-1]
        w = w.withColumn("swapped", F.coalesce(F.col(f"{lead}_low") > F.col(f"{lead}_high"), F.lit(False)))
        swap = F.col("swapped")
        for c in cols:
            lo, hi = F.col(f"{c}_low"), F.col(f"{c}_high")
            w = w.withColumns({f"{c}_low": F.when(swap, hi).otherwise(lo),
                               f"{c}_high": F.when(swap, lo).otherwise(hi)})
    return w


# A23 -----------------------------------------------------------------------
def weighted_mean(df: DataFrame, pairs, by=(), out: str = "weighted_mean") -> DataFrame:
    """sum(v*w)/sum(w) over (value, weight) pairs, across columns of a row
    and across rows of a group."""
    num = sum((F.coalesce(F.col(v) * F.col(w), F.lit(0.0)) for v, w in pairs), F.lit(0.0))
    den = sum((F.when(F.col(v).isNotNull(), F.coalesce(F.col(w), F.lit(0.0))).otherwise(0.0) for v, w in pairs),
              F.lit(0.0))
    return df.groupBy(*as_list(by)).agg(F.try_divide(F.sum(num), F.sum(den)).alias(out))


# A24 -----------------------------------------------------------------------
def model_selection(test: DataFrame, train: DataFrame, baseline: str, metric: str = "rmse",
                    model: str = "model") -> DataFrame:
    """Per model: test metric, rank, improvement over the baseline in percent,
    train metric and train-to-test gap in percent, best / worst flags."""
    base = test.filter(F.col(model) == baseline).select(metric).scalar()
    best = test.select(F.min(metric)).scalar()
    worst = test.select(F.max(metric)).scalar()
    t = test.select(model, F.col(metric).alias("test_metric")).join(
        train.select(model, F.col(metric).alias("train_metric")), model, "left")
    return t.select(
        model, "test_metric", "train_metric",
        F.when(base != 0, (base - F.col("test_metric")) / base * 100).alias("improvement_pct"),
        F.when(F.col("train_metric") != 0,
               (F.col("test_metric") - F.col("train_metric")) / F.col("train_metric") * 100).alias("gap_pct"),
        (F.col("test_metric") == best).alias("is_best"), (F.col("test_metric") == worst).alias("is_worst"))


# A25 -----------------------------------------------------------------------
def split_summary(df: DataFrame, split_col: str, period: str) -> DataFrame:
    return df.groupBy(split_col).agg(F.count("*").alias("rows"), F.min(period).alias("start"),
                                     F.max(period).alias("end"))


# A26 -----------------------------------------------------------------------
def forecast_path(fc: DataFrame, keys=("entity", "scenario"), period: str = "period",
                  value: str = "pred", at=None) -> DataFrame:
    """Per key: ordered path (array of (period, value)), first and last
    month, value at the last month and, with ``at``, the mean at that month."""
    keys = as_list(keys)
    # one point per (key, period) first: the path of a key is bounded by its
    # calendar, however many raw rows a hot key has
    fc = fc.groupBy(*keys, period).agg(F.avg(value).alias(value))
    aggs = [F.array_sort(F.collect_list(F.struct(F.col(period), F.col(value)))).alias("path"),
            F.min(period).alias("first_period"), F.max(period).alias("last_period"),
            F.max_by(value, period).alias("value_last")]
    if at is not None:
        aggs.append(F.avg(F.when(F.col(period) == F.lit(at).cast("date"), F.col(value))).alias("value_at"))
    return fc.groupBy(*keys).agg(*aggs)


# Exact quantiles at scale ----------------------------------------------------
#: Groups of at most so many rows are sorted by one task each.
DIRECT_ROWS = 10_000


def _interpolated(lo, hi, place) -> Column:
    """Between the values of the ranks next to ``place``."""
    f = place - F.floor(place)
    return F.when(f == 0, lo).otherwise((1 - f) * lo + f * hi)


def exact_quantiles(df: DataFrame, value: str, probs, by=()) -> DataFrame:
    """Exact linear-interpolated quantiles; missing values and NaN dropped.
    Output: by..., p, q.

    Groups are counted first. One of at most ``DIRECT_ROWS`` rows takes Spark's
    exact ``percentile``. In a larger one each wanted rank is bracketed: a
    mergeable sketch gives two values that the rank lies between, and one more
    pass counts the rows below the brackets and gathers only the rows inside,
    equal values summed to one row before the shuffle. The sketch's resolution
    grows with the square root of the largest group, so a task sorts about as
    many values as the square root of its group. No sort or copy of the table.
    """
    from ..session import checkpoint_dir
    by, probs = as_list(by), [float(p) for p in as_list(probs)]
    if not by:
        return exact_quantiles(df.withColumn("_all", F.lit(0)), value, probs, ["_all"]).drop("_all")
    checkpoint_dir(df.sparkSession)
    x = df.select(*by, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    sizes = x.groupBy(*by).agg(F.count("*").alias("_n")).checkpoint(eager=True)      # one row a group
    most, n_big, n_all = sizes.agg(F.max("_n"), F.count_if(F.col("_n") > DIRECT_ROWS), F.count("*")).first()
    small = x if not n_big else _join_keys(x, sizes.filter(F.col("_n") <= DIRECT_ROWS), by, "inner").drop("_n")
    each = F.array(*[F.struct(F.lit(p).alias("p"), F.col("_q")[i].alias("q")) for i, p in enumerate(probs)])
    direct = small.groupBy(*by).agg(F.percentile("_v", F.array(*[F.lit(p) for p in probs])).alias("_q")).select(*by, F.inline(each))
    if not n_big:
        return direct
    bracketed = _bracketed(x, sizes.filter(F.col("_n") > DIRECT_ROWS), by, probs, most, n_big)
    return bracketed if n_big == n_all else direct.unionByName(bracketed)


def _bracketed(x: DataFrame, sizes: DataFrame, by: list[str], probs: list[float], most: int, groups: int) -> DataFrame:
    place = lambda p: (F.col("_n") - 1) * F.lit(p)
    small = F.broadcast if groups <= 100_000 else (lambda d: d)
    big = _join_keys(x, small(sizes), by, "inner")
    accuracy = int(min(max(8 * most ** 0.5, 1000), 100_000))
    # two errors of the sketch to each side, and the ends of the data
    wide = 2.0 / accuracy
    ends = [(max(p - wide, 0.0), min(p + wide, 1.0)) for p in sorted(probs)]
    sketch = F.percentile_approx("_v", [e for pair in ends for e in pair], accuracy)
    limits = big.groupBy(*by).agg(sketch.alias("_s"), F.min("_v").alias("_min"), F.max("_v").alias("_max"), F.max("_n").alias("_n"))
    limits = limits.select(*by, "_n", *[(F.col("_min") if lo == 0 else F.col("_s")[2 * i]).alias(f"_l{i}") for i, (lo, _) in enumerate(ends)],
                           *[(F.col("_max") if hi == 1 else F.col("_s")[2 * i + 1]).alias(f"_h{i}") for i, (_, hi) in enumerate(ends)]).checkpoint(eager=True)  # one row a large group
    y = _join_keys(big.drop("_n"), small(limits), by, "inner")
    # the zone of a value: how many brackets end below it; in its zone's
    # bracket it is kept, before it it is only counted
    zone = sum((F.col("_v") > F.col(f"_h{i}")).cast("int") for i in range(len(probs)))
    inside = F.coalesce(*[F.when((zone == i) & (F.col("_v") >= F.col(f"_l{i}")), F.col("_v")) for i in range(len(probs))])
    counted = y.groupBy(*by, zone.alias("_z"), inside.alias("_v")).agg(F.count("*").alias("_c"), F.first("_n").alias("_n"))
    order = Window.partitionBy(*by).orderBy("_z", F.asc_nulls_first("_v")).rowsBetween(Window.unboundedPreceding, 0)
    rows = counted.withColumn("_upto", F.sum("_c").over(order)).withColumn("_from", F.col("_upto") - F.col("_c"))
    held = lambda r: (F.col("_from") <= r) & (r < F.col("_upto"))
    wants = []
    for i, p in enumerate(probs):
        wants += [F.max(F.when(held(F.floor(place(p))), F.col("_v"))).alias(f"_a{i}"), F.max(F.when(held(F.ceil(place(p))), F.col("_v"))).alias(f"_b{i}")]
    g = rows.groupBy(*by).agg(*wants, F.first("_n").alias("_n"))
    # a rank outside its bracket has no value here; the sketch's bound excludes that
    missed = F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double")
    each = F.array(*[F.struct(F.lit(p).alias("p"), _interpolated(F.coalesce(f"_a{i}", missed), F.coalesce(f"_b{i}", missed), place(p)).alias("q"))
                     for i, p in enumerate(probs)])
    return g.select(*by, F.inline(each))


def quantile_table(df: DataFrame, value: str, probs, by=()) -> DataFrame:
    """(by..., p, q) for every probability."""
    return exact_quantiles(df, value, probs, by)
