"""Period parsing and normalisation.

Months are represented as DATE values on the first day of the month.
Parsers never fail on bad text: they return NULL (``try_*`` built-ins), so
they are safe under ANSI mode.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = [
    "month_start", "month_key", "quarter_start", "ym_to_date", "is_ym", "parse_ym",
    "year_of", "parse_year", "parse_month_any", "norm_month", "DATE_FORMATS",
    "best_date_format", "standardize_month", "parse_with_fallback",
]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(c) -> Column:
    """First day of the month of a date, timestamp or ISO date string."""
    c = _c(c)
    return F.trunc(F.coalesce(F.try_to_date(c.cast("string")), F.try_to_date(c.cast("string"), "yyyy-MM")), "month")


def month_key(c) -> Column:
    """``YYYY-MM`` text key of a month."""
    return F.date_format(month_start(c), "yyyy-MM")


def quarter_start(c) -> Column:
    """``2006Q1`` -> 2006-01-01 (first month of the quarter)."""
    c = F.upper(F.trim(_c(c)))
    y = F.regexp_extract(c, r"^(\d{4})Q([1-4])$", 1)
    q = F.regexp_extract(c, r"^(\d{4})Q([1-4])$", 2)
    ok = c.rlike(r"^\d{4}Q[1-4]$")
    return F.when(ok, F.make_date(y.cast("int"), q.cast("int") * 3 - 2, F.lit(1)))


def is_ym(c) -> Column:
    return F.trim(_c(c)).rlike(r"^\d{4}M\d{2}$")


def ym_to_date(c) -> Column:
    """``2018M01`` -> 2018-01-01; NULL for other text."""
    c = F.trim(_c(c))
    return F.when(is_ym(c), F.try_to_date(F.regexp_replace(c, "M", "-"), "yyyy-MM"))


def parse_ym(df: DataFrame, col: str, out: str = "period") -> DataFrame:
    """Keep rows whose text is ``YYYYMmm`` and convert them to a month."""
    return df.filter(is_ym(col)).withColumn(out, ym_to_date(col))


def year_of(c) -> Column:
    """Year from text or number; NULL unless it is a 4-digit year."""
    s = F.trim(_c(c).cast("string"))
    s = F.regexp_replace(s, r"\.0+$", "")
    return F.when(s.rlike(r"^\d{4}$"), s.cast("int"))


def parse_year(df: DataFrame, col: str, strict: bool = True) -> DataFrame:
    """Strict keeps only 4-digit-year text; otherwise coerce and drop failures."""
    if strict:
        return df.filter(F.trim(F.col(col).cast("string")).rlike(r"^\d{4}$")).withColumn(
            col, F.trim(F.col(col).cast("string")).cast("int"))
    y = F.col(col).cast("string").try_cast("double").try_cast("int")
    return df.withColumn(col, y).filter(F.col(col).isNotNull())


def _shape(fmt: str) -> str:
    """A loose regular expression that every string the datetime pattern
    ``fmt`` can parse also matches. Used to skip hopeless parse attempts,
    which are costly (a failed parse raises inside the JVM)."""
    out, i = "^", 0
    while i < len(fmt):
        ch = fmt[i]
        j = i
        while j < len(fmt) and fmt[j] == ch:
            j += 1
        run = j - i
        if ch == "y":
            out += r"\d{4,}" if run >= 4 else r"\d{1,}"
        elif ch == "M" and run == 1:
            out += r"0*([1-9]|1[0-2])"
        elif ch == "M" and run == 2:
            out += r"(0[1-9]|1[0-2])"
        elif ch == "d" and run == 1:
            out += r"0*([1-9]|[12][0-9]|3[01])"
        elif ch == "d" and run == 2:
            out += r"(0[1-9]|[12][0-9]|3[01])"
        elif ch in "ML":
            out += r"[A-Za-z\.]+"
        elif ch.isalpha():
            out += r".+"
        else:
            out += re.escape(ch * run)
        i = j
    return out + "$"


def try_date(s: Column, fmt: str) -> Column:
    """``try_to_date`` behind a shape test: same result, no failed parses."""
    return F.when(s.rlike(_shape(fmt)), F.try_to_date(s, fmt))


# Formats tried by the tolerant month parser, day-first.
_ANY_FORMATS = ("yyyy-MM-dd", "yyyy/MM/dd", "d/M/yyyy", "d-M-yyyy", "d.M.yyyy",
                "yyyy-MM", "yyyy/MM", "d MMM yyyy", "MMM yyyy", "MMMM yyyy")


def parse_month_any(c) -> Column:
    """Month of free text: ISO year-month anywhere in the text first, then
    day-first date formats. NULL when nothing parses."""
    s = F.trim(_c(c).cast("string"))
    iso = F.regexp_extract(s, r"(20\d{2})[-/](0[1-9]|1[0-2])", 0)
    from_iso = F.when(iso != "", F.try_to_date(F.regexp_replace(iso, "/", "-"), "yyyy-MM"))
    parsed = F.coalesce(*[try_date(s, f) for f in _ANY_FORMATS])
    return F.coalesce(from_iso, F.trunc(parsed, "month"))


def norm_month(c) -> Column:
    """P06 text form: ``YYYY-MM`` when parsable, else the first 7 characters."""
    s = F.trim(_c(c).cast("string"))
    m = parse_month_any(s)
    return F.when(s.isNull() | (s == ""), F.lit("")).otherwise(
        F.coalesce(F.date_format(m, "yyyy-MM"), F.substring(s, 1, 7)))


# The four candidate rules of the date-format vote, in order.
DATE_FORMATS = {
    "dayfirst": ("d/M/yyyy", "d-M-yyyy", "yyyy-MM-dd", "yyyy/M/d", "yyyy-MM"),
    "monthfirst": ("M/d/yyyy", "M-d-yyyy", "yyyy-MM-dd", "yyyy/M/d", "yyyy-MM"),
    "strict_dmy": ("dd/MM/yyyy", "d/MM/yyyy", "d/M/yyyy"),
    "strict_mdy": ("MM/dd/yyyy", "M/dd/yyyy", "M/d/yyyy"),
}


def _parse_rule(s: Column, fmts) -> Column:
    return F.coalesce(*[try_date(s, f) for f in fmts])


def best_date_format(df: DataFrame, col: str, rules: dict | None = None) -> DataFrame:
    """Score each rule by (rows parsed, distinct months).

    Date texts repeat, so each distinct text is parsed once and votes with its
    number of rows. Returns a one-row DataFrame: the winning rule name and its
    two scores. Ties go to the earlier rule, as in a strict ``>`` scan.
    """
    rules = rules or DATE_FORMATS
    df = df.groupBy(F.trim(F.col(col).cast("string")).alias("_t")).agg(F.count("*").alias("_n"))
    s = F.col("_t")
    aggs = []
    for i, (name, fmts) in enumerate(rules.items()):
        p = _parse_rule(s, fmts)
        # distinct months via a set: bounded by the calendar, one pass, no Expand
        aggs.append(F.struct(F.coalesce(F.sum(F.when(p.isNotNull(), F.col("_n"))), F.lit(0)).alias("parsed"),
                             F.size(F.collect_set(F.trunc(p, "month"))).cast("bigint").alias("months"),
                             F.lit(-i).alias("neg_order"), F.lit(name).alias("rule")))
    scores = df.agg(F.array(*aggs).alias("s")).select(F.explode("s").alias("s")).select("s.*")
    return scores.agg(F.max_by(F.struct("rule", "parsed", "months"),
                               F.struct("parsed", "months", "neg_order")).alias("b")).select("b.*")


def standardize_month(df: DataFrame, col: str, rules: dict | None = None) -> DataFrame:
    """P07 applied: parse ``col`` with the winning rule (scalar subquery, no
    collect) and add ``date_rule``."""
    rules = rules or DATE_FORMATS
    best = best_date_format(df, col, rules).select("rule").scalar()
    s = F.trim(F.col(col).cast("string"))
    expr = None
    for name, fmts in rules.items():
        p = _parse_rule(s, fmts)
        expr = F.when(best == name, p) if expr is None else expr.when(best == name, p)
    return df.withColumn(col, F.trunc(expr, "month")).withColumn("date_rule", best)


def parse_with_fallback(c) -> Column:
    """Default (ISO / month-first) parse, then day-first for the failures."""
    s = F.trim(_c(c).cast("string"))
    first = _parse_rule(s, ("yyyy-MM-dd", "yyyy/MM/dd", "yyyy-MM", "M/d/yyyy"))
    second = _parse_rule(s, ("d/M/yyyy", "d-M-yyyy", "d.M.yyyy"))
    return F.trunc(F.coalesce(first, second), "month")
