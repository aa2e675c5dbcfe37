"""Numeric column functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "to_number", "parse_grouped_number", "row_sum", "row_mean", "safe_log",
    "level_of", "pct_change_of", "direction", "trend_band", "gap_band", "real_rate",
    "round_half_even",
]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c) -> Column:
    """Text or number to DOUBLE; unparsable text becomes NULL."""
    return F.trim(_c(c).cast("string")).try_cast("double")


def parse_grouped_number(c) -> Column:
    """P10: ``1,234,567`` -> 1234567.0; NULL when not a number."""
    return F.regexp_replace(F.trim(_c(c).cast("string")), ",", "").try_cast("double")


def row_sum(cols) -> Column:
    """Row-wise sum with missing treated as 0 (all missing gives 0)."""
    return reduce(lambda a, b: a + b, [F.coalesce(_c(c).cast("double"), F.lit(0.0)) for c in cols])


def row_mean(cols) -> Column:
    """Row-wise mean of the non-missing values; NULL when all are missing."""
    cols = [_c(c).cast("double") for c in cols]
    n = reduce(lambda a, b: a + b, [F.when(c.isNotNull() & ~F.isnan(c), 1).otherwise(0) for c in cols])
    s = reduce(lambda a, b: a + b, [F.when(c.isNotNull() & ~F.isnan(c), c).otherwise(0.0) for c in cols])
    return F.when(n > 0, s / n)


def safe_log(c) -> Column:
    """P14 element: natural log, NULL for non-positive or missing input."""
    c = _c(c)
    return F.when(c > 0, F.log(c))


def level_of(level, log) -> Column:
    """The level column, back-filled from ``exp(log)`` where missing."""
    if level is None:
        return F.exp(_c(log))
    return F.coalesce(_c(level), F.exp(_c(log)))


def pct_change_of(new, old) -> Column:
    """``new/old - 1``, NULL when the base is 0 or missing."""
    new, old = _c(new), _c(old)
    return F.when(old.isNotNull() & (old != 0), new / old - 1)


def direction(c, zero: str = "up") -> Column:
    """+1 / -1 sign flag. ``zero="up"`` counts 0 as up (``>= 0``);
    ``zero="none"`` gives NULL for 0."""
    c = _c(c)
    if zero == "up":
        return F.when(c.isNull(), None).when(c >= 0, F.lit("up")).otherwise(F.lit("down"))
    return F.when(c > 0, F.lit("up")).when(c < 0, F.lit("down"))


def trend_band(c, strong: float = 0.08, moderate: float = 0.03) -> Column:
    """(direction, strength) of a fractional change as a struct."""
    c = _c(c)
    d = (F.when(c.isNull(), "unknown").when(c >= moderate, "increase")
         .when(c <= -moderate, "decrease").otherwise("stable"))
    s = (F.when(c.isNull(), "unknown").when((c >= strong) | (c <= -strong), "strong")
         .when((c >= moderate) | (c <= -moderate), "moderate").otherwise("weak"))
    return F.struct(d.alias("direction"), s.alias("strength"))


def gap_band(c, info: float = 30.0, warn: float = 80.0) -> Column:
    """Tone of a train-to-test gap in percent: success / info / warning."""
    c = _c(c)
    return (F.when(c.isNull(), "unknown").when(c <= info, "success")
            .when(c <= warn, "info").otherwise("warning"))


def real_rate(rate, inflation) -> Column:
    """Nominal rate minus inflation (both in percent)."""
    return _c(rate) - _c(inflation)


def round_half_even(c, digits: int) -> Column:
    """Pandas-style rounding (banker's rounding)."""
    return F.bround(_c(c), digits)
