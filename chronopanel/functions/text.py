"""Text column functions: keys, labels, narratives and question parsing
(P23, P24, P30-P33, P36)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "norm_key", "norm_scenario", "SCENARIO_ALIASES", "narrate", "find_month",
    "find_scenario", "find_entities", "classify_intent", "INTENT_RULES",
    "pretty_feature", "bullet_metric", "cents",
]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_key(c) -> Column:
    """Loose match key, lower case letters and digits only."""
    return F.regexp_replace(F.lower(F.trim(_c(c).cast("string"))), r"[^\p{L}\p{N}]", "")


# Scenario labels and their aliases.
SCENARIO_ALIASES = {
    "base": ("base",),
    "low": ("low", "lower"),
    "high": ("high", "higher"),
}


def norm_scenario(c, aliases: dict | None = None, on_unknown: str = "null") -> Column:
    """``lower(trim(x))`` mapped through the alias table.

    ``on_unknown``: "null" (caller raises / filters), "base" (default to base),
    or "keep" (keep the cleaned text)."""
    aliases = aliases or SCENARIO_ALIASES
    s = F.lower(F.trim(_c(c).cast("string")))
    expr = None
    for canon, names in aliases.items():
        cond = s.isin(*names)
        expr = F.when(cond, F.lit(canon)) if expr is None else expr.when(cond, F.lit(canon))
    if on_unknown == "base":
        return expr.otherwise(F.lit("base"))
    if on_unknown == "keep":
        return expr.otherwise(s)
    return expr


def narrate(template: str, *cols) -> Column:
    """Templated text from metric columns (``printf`` syntax)."""
    return F.format_string(template, *[_c(c) for c in cols])


def cents(c) -> Column:
    """Round half away from zero to 2 decimals before ``%.2f`` formatting,
    so the printed digits do not depend on the formatter's tie rule."""
    return F.round(_c(c) * 100.0) / 100.0


def find_month(c) -> Column:
    """P31 month slot: ``YYYY-MM`` or ``YYYY/MM`` (optionally with a day)."""
    m = F.regexp_extract(_c(c), r"\b(20\d{2})[-/](\d{2})(?:[-/]\d{2})?\b", 0)
    return F.when(m != "", F.concat_ws("-", F.substring(m, 1, 4), F.substring(m, 6, 2)))


def find_scenario(c, default: str = "base") -> Column:
    """P31 scenario slot: first of low / high / base found as a word."""
    t = F.lower(_c(c))
    return (F.when(t.rlike(r"\blow\b"), "low").when(t.rlike(r"\bhigh\b"), "high")
            .when(t.rlike(r"\bbase\b"), "base").otherwise(F.lit(default)))


def find_entities(c, entities) -> Column:
    """P31 entity slot: entities named in the text, exact (case-free) match
    first; if none, a loose match on normalised keys. Order of the list kept.
    ``entities`` is a parameter list; names of a table are found by
    ``operators.mentions``."""
    t = F.lower(_c(c))
    exact = F.array_compact(F.array(*[F.when(t.contains(e.lower()), F.lit(e)) for e in entities]))
    tk = norm_key(t)
    loose = F.array_compact(F.array(*[F.when(tk.contains(_key(e)), F.lit(e)) for e in entities]))
    return F.when(F.size(exact) > 0, exact).otherwise(loose)


def _key(s: str) -> str:
    return "".join(ch for ch in s.strip().lower() if ch.isalnum())


# Keyword rules of the intent classifier.
INTENT_RULES = {
    "investment_triggers": ("invest", "investment", "investing", "risk", "return", "risk-return",
                            "drawdown", "volatility", "stable", "stability", "safe", "safer",
                            "district", "ranking", "rank", "recommend", "recommendation",
                            "portfolio"),
    "investment_choice": ("which", "choose", "compare", "ranking", "rank", "recommend", "best",
                          "safer", "stable", "stability"),
    "compare": ("compare", "vs", "versus", "difference", "differences", "between",
                "which is higher", "which is lower"),
    "explain": ("explain", "driver", "drivers", "shap", "why", "contribution", "impact", "feature"),
}


def _any_substr(t: Column, words) -> Column:
    out = None
    for w in words:
        out = t.contains(w) if out is None else (out | t.contains(w))
    return out


def classify_intent(c, rules: dict | None = None) -> Column:
    """Investment (trigger and choice cue), compare, explain, else forecast."""
    r = rules or INTENT_RULES
    t = F.lower(F.trim(_c(c)))
    inv = _any_substr(t, r["investment_triggers"]) & _any_substr(t, r["investment_choice"])
    return (F.when(t.isNull() | (t == ""), "empty").when(inv, "investment")
            .when(_any_substr(t, r["compare"]), "compare")
            .when(_any_substr(t, r["explain"]), "explain").otherwise("forecast"))


def pretty_feature(c) -> Column:
    """Drop pipeline prefixes (``num__``, ``cat__``, ``remainder__``)."""
    return F.regexp_replace(_c(c), r"^(num|cat|remainder)__", "")


def bullet_metric(line, name_pattern: str = r"^\s*[-*•]\s*([^:]+):\s*([-+]?[0-9][0-9,]*\.?[0-9]*)\s*(%?)") -> Column:
    """P33 element: (name, value, is_percent) parsed from one bullet line."""
    n = F.trim(F.regexp_extract(_c(line), name_pattern, 1))
    v = F.regexp_replace(F.regexp_extract(_c(line), name_pattern, 2), ",", "").try_cast("double")
    p = F.regexp_extract(_c(line), name_pattern, 3) == "%"
    return F.when(n != "", F.struct(n.alias("name"), v.alias("value"), p.alias("is_percent")))
