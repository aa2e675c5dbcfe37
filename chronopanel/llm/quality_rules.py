"""Quality rules as a short-circuit cascade of native column expressions.

Each rule has a metric and a bound. ``measure`` runs every rule on a sample of
rows and takes its seconds a row (cost) and the share it rejects
(selectivity); ``ordered`` puts the rules with the most rejections per second
first; ``cascade`` evaluates them in that order inside one nested
conditional, so a row that a cheap rule rejects never pays for the others.
The order changes the cost only: a row is kept if it passes every rule.

Defined cases: a null or empty text has no words and fails ``few_words``; a
ratio with a zero denominator is not above any bound; repeated rows are judged
alike; an empty table gives an empty result (the sample then says nothing and
the rules keep their given order); other columns pass through, and names that
clash with this module's own are not touched (everything is computed inside
expressions).
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
SAMPLE_ROWS = 2000


def words(text: Column) -> Column:
    """Words of the text; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def word_chars(ws: Column) -> Column:
    return F.length(F.array_join(ws, "")).cast("long")


def n_symbols(text: Column) -> Column:
    t = F.coalesce(text, F.lit(""))
    return (F.length(t) - F.length(F.regexp_replace(t, SYMBOLS, ""))).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def windows(ws: Column, n: int = 5) -> Column:
    """A 64-bit hash of each n-word window, in order. The words' hashes are
    chained, so a window costs n steps whatever its length in characters."""
    h = F.transform(ws, lambda w: F.xxhash64(w))
    at = F.when(F.size(ws) >= n, F.sequence(F.lit(0), F.size(ws) - n)).otherwise(F.array().cast("array<int>"))
    return _with(h, lambda hs: F.transform(at, lambda i: F.xxhash64(*[F.get(hs, i + k) for k in range(n)])))


def _with(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def n_repeat_words(ws: Column, n: int = 5) -> Column:
    """Words inside n-word windows that occur twice or more, the first
    occurrence included. Windows without any repeat end after one distinct
    pass; others are sorted with their places, so the cost is n log n even
    where a text repeats throughout."""
    def covered(hs: Column) -> Column:
        pairs = F.sort_array(F.transform(hs, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            again = F.transform(s, lambda x, k: F.when((x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]), x["i"]))
            return F.sort_array(F.filter(again, lambda x: x.isNotNull()))

        start = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-n).alias("last"))
        return F.aggregate(_with(pairs, places), start,
                           lambda acc, x: F.struct((acc["sum"] + F.least(x - acc["last"], F.lit(n))).alias("sum"), x.alias("last")),
                           lambda acc: acc["sum"])

    return _with(windows(ws, n), lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0).cast("long")).otherwise(covered(hs)))


@dataclass(frozen=True)
class Rule:
    """``fails(text, words)`` is true where the rule rejects the row."""

    name: str
    fails: object


def rules(min_words: int = 10, max_repeat: int = 20, max_symbols: int = 10, max_dup_lines: int = 30, least_dup_lines: int = 3,
          short_word: int = 2, long_word: int = 15) -> list[Rule]:
    """The rules in percent and counts: too few words; words inside repeated
    windows; symbol characters a word character; repeated lines (a single one
    in a short text is no fault); mean word length out of range."""
    n_lines = lambda t: F.size(F.split(F.coalesce(t, F.lit("")), "\n"))
    return [
        Rule("few_words", lambda t, w: F.size(w) < min_words),
        Rule("mean_word", lambda t, w: (word_chars(w) < short_word * F.size(w)) | (word_chars(w) > long_word * F.size(w))),
        Rule("symbols", lambda t, w: 100 * n_symbols(t) > max_symbols * word_chars(w)),
        Rule("dup_lines", lambda t, w: _with(n_dup_lines(t), lambda d: (d >= least_dup_lines) & (100 * d > max_dup_lines * n_lines(t)))),
        Rule("repeats", lambda t, w: 100 * n_repeat_words(w) > max_repeat * F.size(w)),
    ]


def sample(df: DataFrame, text_col: str, n: int = SAMPLE_ROWS) -> DataFrame:
    """About ``n`` rows chosen by their text's hash: the same rows each time."""
    total = df.count()
    if total <= n:
        return df
    return df.where(F.pmod(F.xxhash64(F.col(text_col), F.lit("quality-sample")), F.lit(1 << 20)) < int((1 << 20) * n / total) + 1).limit(2 * n)


def measure(rows: DataFrame, text_col: str, given: list[Rule]) -> list[dict]:
    """Seconds a row and rejected share of each rule over ``rows``."""
    out, t = [], F.col(text_col)
    n = max(1, rows.count())
    for r in given:
        began = time.perf_counter()
        bad = rows.agg(F.count_if(F.coalesce(r.fails(t, words(t)), F.lit(False)))).first()[0]
        out.append({"rule": r.name, "cost": (time.perf_counter() - began) / n, "rejects": bad / n})
    return out


def ordered(given: list[Rule], measured: list[dict]) -> list[Rule]:
    """Most rejections per second first; rules that reject nothing go by cost."""
    by = {m["rule"]: m for m in measured}
    rank = lambda r: (-by[r.name]["rejects"] / max(by[r.name]["cost"], 1e-12), by[r.name]["cost"])
    return sorted(given, key=rank)


def passes(text: Column, ws: Column, order: list[Rule]) -> Column:
    """True where no rule rejects; a rule after the first rejection is not
    evaluated."""
    out = F.lit(True)
    for r in reversed(order):
        out = F.when(F.coalesce(r.fails(text, ws), F.lit(False)), F.lit(False)).otherwise(out)
    return out


def cascade(df: DataFrame, text_col: str = "text", given: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> Column:
    """Boolean column for ``df``: the rows that every rule accepts."""
    given = rules() if given is None else given
    # the sample is materialised once; each rule is then timed on the same rows
    probe = sample(df.select(text_col), text_col, sample_rows).cache()
    try:
        order = ordered(given, measure(probe, text_col, given))
    finally:
        probe.unpersist()
    t = F.col(text_col)
    return _with(words(t), lambda w: passes(t, w, order))


def quality_table(documents: DataFrame) -> DataFrame:
    """The base figures of each document and the cascade's verdict. The rules
    whose figures the table shows anyway read them from it."""
    t = F.col("text")
    probe = sample(documents.select("text"), "text").cache()
    try:
        order = ordered(rules(), measure(probe, "text", rules()))
    finally:
        probe.unpersist()
    base = documents.select("doc_id", _with(words(t), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), word_chars(w).alias("word_chars"), n_symbols(t).alias("n_symbols"),
        n_dup_lines(t).alias("n_dup_lines"), n_repeat_words(w).alias("n_repeat_words"),
        passes(t, w, [r for r in order if r.name not in ("few_words", "repeats")]).alias("verdict"))).alias("m"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (base.select("doc_id", "m.*").withColumn("base_failed", failed)
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    F.when(F.col("base_failed"), F.lit(False)).otherwise(F.col("verdict")).alias("kept")))


SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
w AS (SELECT doc_id, x, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS ws,
      list_filter(string_split(x, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls,
      len(string_split(x, chr(10))) AS n_lines FROM t),
win AS (SELECT doc_id, i, array_to_string(ws[i:i+4], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM rep) GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
      CAST(length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
      CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words, n_lines
      FROM w LEFT JOIN cov ON cov.doc_id = w.doc_id),
f AS (SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (word_chars < 2 * n_words OR word_chars > 15 * n_words) AND NOT 100 * n_symbols > 10 * word_chars
  AND NOT (n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines) AS kept
FROM f
"""
