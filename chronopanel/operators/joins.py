"""Joins (J01-J11).

Small dimension-like inputs (entity lists, share tables, one row per
entity) are broadcast only behind a size check; fact-to-fact joins are left
to Catalyst / AQE (sort-merge with skew splitting, or broadcast when the
runtime size allows).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import as_list

__all__ = [
    "repeat_for_each", "expand_entities", "merge_panel", "inner_panel", "assert_unique",
    "duplicate_keys", "checked_join", "align_periods", "asof_anchor", "disaggregate",
    "attach_values", "train_test_gap", "missing_periods",
]

# Blocks and copies of ``repeat_for_each``.
BLOCKS, COPIES = 8, 16


def repeat_for_each(df: DataFrame, small: DataFrame) -> DataFrame:
    """Repeat every row of ``df`` once per row of ``small``, of any size.

    An equi-join on (block, copy): the rows of ``small`` are dealt over
    ``BLOCKS`` blocks and stand in each of ``COPIES`` copies; a row of ``df``
    meets every block in one copy. Spark broadcasts ``small`` where its
    statistics allow and shuffles evenly by (block, copy) where they do not.
    """
    deal = lambda cols, n: F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in cols]), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = df.withColumn("_copy", deal(df.columns, COPIES)).withColumn("_block", every(BLOCKS))
    right = small.withColumn("_block", deal(small.columns, BLOCKS)).withColumn("_copy", every(COPIES))
    return left.join(right, ["_block", "_copy"]).drop("_block", "_copy")


# J01 -----------------------------------------------------------------------
def expand_entities(series: DataFrame, entities) -> DataFrame:
    """Repeat a national series for every entity. ``entities`` is a list of
    names (parameter) or a one-column dimension DataFrame."""
    if isinstance(entities, DataFrame):
        return repeat_for_each(series, entities)
    return series.withColumn("entity", F.explode(F.array(*[F.lit(e) for e in entities])))


# J02 / J03 -----------------------------------------------------------------
def merge_panel(base: DataFrame, others, keys=("period", "entity"), how: str = "left") -> DataFrame:
    """Chain of equi-joins on the panel key. Each other table is reduced to
    its key plus new columns first, so no column is duplicated."""
    keys = as_list(keys)

    def step(acc: DataFrame, o: DataFrame) -> DataFrame:
        new = [c for c in o.columns if c not in acc.columns]
        ok = [k for k in keys if k in o.columns]
        return acc.join(o.select(*ok, *new), on=ok, how=how)
    return reduce(step, as_list(others), base)


def inner_panel(a: DataFrame, b: DataFrame, keys=("period", "entity")) -> DataFrame:
    return merge_panel(a, [b], keys, how="inner")


# J05 -----------------------------------------------------------------------
def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*as_list(keys)).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def assert_unique(df: DataFrame, keys, name: str = "table") -> DataFrame:
    """Raise with up to 10 sample keys when keys repeat; returns ``df``."""
    bad = duplicate_keys(df, keys).limit(10).collect()
    if bad:
        raise ValueError(f"{name}: duplicate keys {as_list(keys)}: {[r.asDict() for r in bad]}")
    return df


# J04 -----------------------------------------------------------------------
def checked_join(a: DataFrame, b: DataFrame, keys, how: str = "left",
                 validate: str = "many_to_one") -> DataFrame:
    """Join after checking key cardinality: ``one_to_one`` needs unique keys
    on both sides, ``many_to_one`` on the right, ``one_to_many`` on the left."""
    keys = as_list(keys)
    if validate in ("one_to_one", "one_to_many"):
        assert_unique(a, keys, "left")
    if validate in ("one_to_one", "many_to_one"):
        assert_unique(b, keys, "right")
    return a.join(b, on=keys, how=how)


# J06 -----------------------------------------------------------------------
def align_periods(a: DataFrame, b: DataFrame, period: str = "period"):
    """Both tables restricted to the periods they share (two semi joins)."""
    pa, pb = a.select(period).distinct(), b.select(period).distinct()
    return a.join(pb, period, "left_semi"), b.join(pa, period, "left_semi")


# J07 -----------------------------------------------------------------------
def asof_anchor(hist: DataFrame, starts: DataFrame, entity: str = "entity", period: str = "period",
                value: str = "value", start: str = "start") -> DataFrame:
    """Per entity: the last history value strictly before the entity's
    forecast start; when there is none, the last history value at all.
    One keyed join and one aggregate with ``max_by``; no range join."""
    j = hist.select(entity, period, value).join(starts.select(entity, start), entity, "inner")
    before = F.col(period) < F.col(start)
    g = j.groupBy(entity).agg(
        F.max_by(F.col(value), F.when(before, F.col(period))).alias("_vb"),
        F.max(F.when(before, F.col(period))).alias("_pb"),
        F.max_by(F.col(value), F.col(period)).alias("_vl"), F.max(period).alias("_pl"))
    has = F.col("_pb").isNotNull()
    return g.select(entity, F.when(has, F.col("_pb")).otherwise(F.col("_pl")).alias("anchor_period"),
                    F.when(has, F.col("_vb")).otherwise(F.col("_vl")).alias("anchor_value"),
                    has.alias("strictly_before"))


# J08 -----------------------------------------------------------------------
def disaggregate(total: DataFrame, shares: DataFrame, value_cols, share_cols,
                 entity: str = "entity", check_tol: float | None = 0.01) -> DataFrame:
    """Totals times entity shares: every total row is repeated for every
    entity of the share table (one row per entity, checked small and
    broadcast). With ``check_tol`` the shares must sum to 1 within it."""
    value_cols, share_cols = as_list(value_cols), as_list(share_cols)
    if check_tol is not None:
        sums = shares.agg(*[F.sum(s).alias(s) for s in share_cols]).first()
        for s in share_cols:
            if sums[s] is None or abs(sums[s] - 1.0) > check_tol:
                raise ValueError(f"shares {s} sum to {sums[s]}, not 1")
    j = repeat_for_each(total, shares.select(entity, *share_cols))
    return j.select(*[c for c in total.columns if c not in value_cols], entity,
                    *[(F.col(v) * F.col(s)).alias(v) for v, s in zip(value_cols, share_cols)])


# J09 -----------------------------------------------------------------------
def attach_values(wide_values: DataFrame, wide_shap: DataFrame, keys, features,
                  shap_prefix: str = "shap_") -> DataFrame:
    """Long attribution rows carrying each feature's value and attribution.
    Values and attributions are zipped into structs and unpivoted in one
    pass (no join of the long table back to the wide one)."""
    keys = as_list(keys)
    j = wide_values.join(wide_shap, on=keys, how="inner")
    arr = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("feature_value"),
                             F.col(shap_prefix + f).cast("double").alias("shap_value")) for f in features])
    return j.select(*keys, F.explode(arr).alias("s")).select(*keys, "s.*")


# J10 -----------------------------------------------------------------------
def train_test_gap(train: DataFrame, test: DataFrame, model: str = "model", metrics=("rmse", "mae", "r2")) -> DataFrame:
    """Per model: train and test metric side by side, absolute and percent gap."""
    metrics = as_list(metrics)
    t = train.select(model, *[F.col(m).alias(f"{m}_train") for m in metrics])
    s = test.select(model, *[F.col(m).alias(f"{m}_test") for m in metrics])
    j = t.join(s, model, "left")
    cols = []
    for m in metrics:
        gap = F.col(f"{m}_test") - F.col(f"{m}_train")
        cols += [gap.alias(f"{m}_gap"),
                 F.when(F.col(f"{m}_train") != 0, gap / F.abs(F.col(f"{m}_train")) * 100).alias(f"{m}_gap_pct")]
    return j.select("*", *cols)


# J11 -----------------------------------------------------------------------
def missing_periods(df: DataFrame, period: str = "period", by=()) -> DataFrame:
    """Months absent between the first and last month (per group with ``by``):
    ``sequence`` + ``explode`` builds the calendar, an anti join removes the
    months present."""
    by = as_list(by)
    m = df.select(*by, F.trunc(F.col(period).cast("date"), "month").alias(period)).filter(F.col(period).isNotNull())
    rng = m.groupBy(*by).agg(F.min(period).alias("_a"), F.max(period).alias("_b"))
    cal = rng.select(*by, F.explode(F.sequence("_a", "_b", F.expr("interval 1 month"))).alias(period))
    return cal.join(m.distinct(), on=by + [period], how="left_anti")
