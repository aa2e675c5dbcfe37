from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_list(x) -> list:
    if x is None:
        return []
    if isinstance(x, (list, tuple)):
        return list(x)
    return [x]


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def with_group_stats(df: DataFrame, by, stats: dict[str, Column]) -> DataFrame:
    """Attach per-group statistics to every row.

    With no keys the statistics become one scalar subquery (computed once,
    no join). With keys they are aggregated per group (partial aggregation
    before the shuffle) and joined back on the keys; the statistics table
    has one row per group, so AQE turns the join into a broadcast when that
    table is small and keeps a shuffle join when it is not.
    """
    by = as_list(by)
    if not by:
        s = df.agg(F.struct(*[v.alias(k) for k, v in stats.items()]).alias("s")).select("s").scalar()
        for k in stats:
            df = df.withColumn(k, s.getField(k))
        return df
    g = df.groupBy(*by).agg(*[v.alias(k) for k, v in stats.items()])
    return df.join(g, on=by, how="left")
