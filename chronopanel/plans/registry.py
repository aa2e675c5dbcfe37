"""Registry of named queries: each pairs a Spark builder ``(spark, sf_dir)
-> DataFrame`` with an equivalent DuckDB SQL oracle over the same tables.

Floating columns are rounded identically on both sides to a binary grid,
``round(x * 2^b) / 2^b`` with 2^-b just below 10^-d: scaling by a power of
two is exact, so both engines perform the same IEEE operations, and values
that are round in decimal (prices, their averages) never sit on a rounding
tie. Integer columns are widened to BIGINT so schemas agree.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .panels import Tables, with_ctes


@dataclass
class Query:
    name: str
    ops: tuple[str, ...]
    build: Callable[[Tables], DataFrame]
    sql: str | None
    digits: dict = field(default_factory=dict)
    materialize: tuple = ()


REGISTRY: dict[str, Query] = {}


def register(name: str, ops, sql: str | None = None, ctes=(), digits: dict | None = None, materialize=()):
    """Decorator. ``digits`` maps floating output columns to decimals (the
    rounding applied to both engines); ``ctes`` are panel names for the SQL."""
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        s = None
        if sql is not None:
            s = with_ctes(ctes, sql)
            s = _round_sql(s, digits or {})
        REGISTRY[name] = Query(name, tuple(ops.split()) if isinstance(ops, str) else tuple(ops),
                               fn, s, dict(digits or {}), tuple(materialize))
        return fn
    return deco


def _scale(d: int) -> float:
    return float(2 ** math.ceil(d * math.log2(10)))


def _round_sql(sql: str, digits: dict) -> str:
    if not digits:
        return sql
    rep = ", ".join(f"round({c} * {_scale(d)!r}) / {_scale(d)!r} AS {c}" for c, d in digits.items())
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) _q"


def finalize(df: DataFrame, digits: dict) -> DataFrame:
    exprs = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in digits:
            k = _scale(digits[f.name])
            exprs.append((F.round(c.cast("double") * k) / k).alias(f.name))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            exprs.append(c.cast("bigint").alias(f.name))
        else:
            exprs.append(c)
    return df.select(*exprs)


def runner(q: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return finalize(q.build(Tables(spark, sf_dir, q.materialize)), q.digits)
    run.__name__ = q.name
    return run


def load_all() -> dict[str, Query]:
    from . import (q_aggs, q_joins, q_models, q_reports, q_reshape, q_scalars,  # noqa: F401
                   q_sources, q_windows)
    return REGISTRY
