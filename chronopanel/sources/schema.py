"""Schema guards and header handling (S07-S10). These read only the
schema: no Spark job runs."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

__all__ = ["expect_columns", "schema_diff", "detect_column", "clean_header", "check_parsed"]


def expect_columns(df: DataFrame, cols, name: str = "table") -> DataFrame:
    """Raise when required columns are absent; returns ``df``."""
    miss = [c for c in cols if c not in df.columns]
    if miss:
        raise KeyError(f"{name}: missing columns {miss}; found {df.columns}")
    return df


def schema_diff(a: DataFrame, b: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """Columns only in ``a`` (missing from ``b``) and only in ``b`` (extra)."""
    spark = spark or a.sparkSession
    rows = [(c, "missing") for c in a.columns if c not in b.columns] + \
           [(c, "extra") for c in b.columns if c not in a.columns]
    return spark.createDataFrame(rows, "column string, kind string")


def _loose(s: str) -> str:
    return re.sub(r"[^0-9a-z]", "", s.lower())


def detect_column(df: DataFrame, candidates, required: bool = True) -> str | None:
    """The first candidate name present exactly, else the first whose
    case- and punctuation-free form matches a column."""
    for c in candidates:
        if c in df.columns:
            return c
    loose = {_loose(c): c for c in df.columns}
    for c in candidates:
        if _loose(c) in loose:
            return loose[_loose(c)]
    if required:
        raise KeyError(f"none of {list(candidates)} in {df.columns}")
    return None


def clean_header(df: DataFrame, first_col: str | None = None) -> DataFrame:
    """Trim names, drop byte-order marks, name an unnamed first column."""
    names = [c.replace("﻿", "").strip() for c in df.columns]
    if first_col and (names[0] == "" or names[0].startswith("_c0") or names[0].lower().startswith("unnamed")):
        names[0] = first_col
    return df.toDF(*names)


def check_parsed(df: DataFrame, raw: str, parsed: str, n: int = 10) -> DataFrame:
    """Raise with up to ``n`` samples when a parse left NULLs for non-empty
    input (P08 guard). One bounded job."""
    from pyspark.sql import functions as F
    bad = df.filter(F.col(parsed).isNull() & F.col(raw).isNotNull()).select(raw).limit(n).collect()
    if bad:
        raise ValueError(f"unparseable values in {raw}: {[r[0] for r in bad]}")
    return df
