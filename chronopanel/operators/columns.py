"""Table-level column operations."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import as_list

__all__ = [
    "log_columns", "log_guard", "project", "drop_present", "select_families",
    "column_catalog", "order_lags", "period_filter", "trim_before", "drop_missing",
    "coalesce_columns", "order_by_list", "max_lag", "filter_or_all", "filter_in",
    "map_labels", "format_columns",
]


def log_guard(df: DataFrame, cols) -> DataFrame:
    """Count of missing or non-positive values per column, with the smallest
    and largest non-positive value (one aggregate, constant-size state)."""
    structs = [F.struct(F.lit(c).alias("column"),
                        F.count_if(F.col(c).isNull() | (F.col(c) <= 0)).cast("bigint").alias("bad"),
                        F.min(F.when(F.col(c) <= 0, F.col(c).cast("double"))).alias("min_bad"),
                        F.max(F.when(F.col(c) <= 0, F.col(c).cast("double"))).alias("max_bad"))
               for c in as_list(cols)]
    return df.agg(F.array(*structs).alias("a")).select(F.explode("a").alias("s")).select("s.*")


def log_columns(df: DataFrame, cols, drop_raw: bool = False, prefix: str = "log_",
                check: bool = False) -> DataFrame:
    """Natural log of each column. ``check`` runs the positivity guard
    first and raises with the offenders; unchecked, bad values give NULL."""
    cols = as_list(cols)
    if check:
        bad = [r for r in log_guard(df, cols).collect() if r["bad"]]
        if bad:
            samples = {r["column"]: [x[0] for x in df.filter(F.col(r["column"]).isNull() | (F.col(r["column"]) <= 0))
                                     .select(r["column"]).limit(5).collect()] for r in bad}
            raise ValueError(f"non-positive or missing values before log: {[r.asDict() for r in bad]}, "
                             f"samples {samples}")
    out = df.withColumns({prefix + c: F.when(F.col(c) > 0, F.log(c)) for c in cols})
    return out.drop(*cols) if drop_raw else out


def project(df: DataFrame, keep, strict: bool = True) -> DataFrame:
    """Select a required column list (error on absent ones unless lax)."""
    keep = as_list(keep)
    miss = [c for c in keep if c not in df.columns]
    if miss and strict:
        raise KeyError(f"missing columns: {miss}")
    return df.select(*[c for c in keep if c in df.columns])


def drop_present(df: DataFrame, cols) -> DataFrame:
    return df.drop(*[c for c in as_list(cols) if c in df.columns])


_LAG = re.compile(r"^(?P<base>.+)_lag(?P<k>\d+)$")


def select_families(columns, bases, lag_only: bool = False) -> list[str]:
    """Columns of the given base names and their ``_lag<k>`` variants."""
    out = []
    for c in columns:
        m = _LAG.match(c)
        if m and m.group("base") in bases:
            out.append(c)
        elif not lag_only and c in bases:
            out.append(c)
    return out


def column_catalog(df: DataFrame, target: str, ids=("period", "entity")) -> DataFrame:
    """One row per column with its role: target, id, dummy, lagged, base, other."""
    cols = df.columns
    bases = {(_LAG.match(c).group("base")) for c in cols if _LAG.match(c)}
    rows = []
    for i, c in enumerate(cols):
        if c == target:
            role = "target"
        elif c in ids:
            role = "id"
        elif c.startswith(("cat__", "is_", "dummy_")):
            role = "dummy"
        elif _LAG.match(c):
            role = "lagged"
        elif c in bases:
            role = "base"
        else:
            role = "other"
        rows.append((i, c, role, df.schema[c].dataType.simpleString()))
    return df.sparkSession.createDataFrame(rows, "position int, column string, role string, type string")


def order_lags(df: DataFrame, bases=None) -> DataFrame:
    """Each base column followed by its lags in ascending lag order;
    other columns keep their place."""
    cols = df.columns
    lags = {}
    for c in cols:
        m = _LAG.match(c)
        if m and (bases is None or m.group("base") in bases):
            lags.setdefault(m.group("base"), []).append((int(m.group("k")), c))
    out, placed = [], set()
    for c in cols:
        if c in placed:
            continue
        if _LAG.match(c) and _LAG.match(c).group("base") in lags and _LAG.match(c).group("base") in cols:
            continue
        out.append(c)
        placed.add(c)
        for _, lc in sorted(lags.get(c, [])):
            out.append(lc)
            placed.add(lc)
    out += [c for c in cols if c not in placed and c not in out]
    return df.select(*out)


def period_filter(df: DataFrame, period: str, start=None, end=None, exclude=()) -> DataFrame:
    """P20: inclusive [start, end] with some periods excluded."""
    c = F.col(period)
    cond = F.lit(True)
    if start is not None:
        cond = cond & (c >= F.lit(start).cast("date"))
    if end is not None:
        cond = cond & (c <= F.lit(end).cast("date"))
    if exclude:
        cond = cond & ~c.isin([F.lit(e).cast("date") for e in exclude])
    return df.filter(cond)


def trim_before(df: DataFrame, period: str, end) -> DataFrame:
    """Half-open trim ``period < end``."""
    return df.filter(F.col(period) < F.lit(end).cast("date"))


def drop_missing(df: DataFrame, how: str = "lags", cols=None) -> DataFrame:
    """Drop rows with a missing value in lag columns, given columns or any column."""
    if how == "lags":
        cols = [c for c in df.columns if _LAG.match(c)]
    elif how == "any":
        cols = df.columns
    return df.dropna(subset=as_list(cols)) if cols else df


def coalesce_columns(df: DataFrame, groups: dict) -> DataFrame:
    """{target: [candidates...]} first non-missing wins; sources dropped."""
    out = df.withColumns({t: F.coalesce(*[F.col(c) for c in cs]) for t, cs in groups.items()})
    drop = {c for t, cs in groups.items() for c in cs if c != t and c not in groups}
    return out.drop(*drop)


def order_by_list(df: DataFrame, c: str, order, then=()) -> DataFrame:
    """Sort by position in a given list (unlisted values last)."""
    pos = F.array_position(F.array(*[F.lit(v) for v in order]), F.col(c))
    return df.orderBy(F.when(pos > 0, pos).otherwise(F.lit(len(order) + 1)), *as_list(then), c)


_LAGNUM = re.compile(r"lag[_\-]?(\d+)", re.I)


def max_lag(columns) -> int:
    """Largest lag named in the columns (``x_lag12``, ``lag_3``), 0 if none."""
    ks = [int(m.group(1)) for c in columns for m in [_LAGNUM.search(c)] if m]
    return max(ks) if ks else 0


def filter_or_all(df: DataFrame, cond: Column) -> DataFrame:
    """Keep the rows matching ``cond`` unless none match, then keep all.
    The 'any match' flag is a scalar subquery (one pass, no collect)."""
    any_match = df.select(F.max(F.coalesce(cond, F.lit(False)).cast("int"))).scalar()
    return df.filter(F.coalesce(cond, F.lit(False)) | (F.coalesce(any_match, F.lit(0)) == 0))


def filter_in(df: DataFrame, c: Column | str, values, key=None) -> DataFrame:
    """P25: keep rows whose key is in a list. The list is a parameter of the
    call and becomes one IN predicate. On a plain column Spark pushes it to
    the scan; with a normalising ``key`` it is evaluated on every row."""
    cc = F.col(c) if isinstance(c, str) else c
    return df.filter((key(cc) if key else cc).isin(list(dict.fromkeys(values))))


def map_labels(df: DataFrame, c: str, mapping: dict) -> DataFrame:
    """Raw labels to canonical names; unmapped values stay."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return df.withColumn(c, F.coalesce(m[F.col(c)], F.col(c)))


def format_columns(df: DataFrame, cols, digits: int = 2) -> DataFrame:
    """Fixed-precision text (half-even rounding, like pandas)."""
    fmt = f"%.{digits}f"
    return df.withColumns({c: F.format_string(fmt, F.bround(F.col(c).cast("double"), digits)) for c in as_list(cols)})
