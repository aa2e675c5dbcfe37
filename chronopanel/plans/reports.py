"""Composite queries (Q01-Q10): the questions asked of the fact tables.

Each report is evaluated for every slice at once ((entity, scenario) or
(entity, scenario, period)) so a single distributed job answers all the
questions a service would otherwise answer one request at a time. Filter
the inputs first to answer one question.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import aggs as A
from ..operators import columns as C
from ..operators import joins as J
from ..operators import reshape as R
from ..operators import windows as W
from ..operators._util import as_list

__all__ = ["predict_slice", "auto_summary", "forecast_report", "report_cards", "compare_entities", "investment_insight",
           "dataset_summary", "spatial_table", "route_questions", "model_report", "driver_bars"]


# Q01 -----------------------------------------------------------------------
def predict_slice(fc: DataFrame, scenario: str, entities=None, n: int = 20, entity: str = "entity",
                  on_unknown: str = "error") -> DataFrame:
    """Forecast rows of one scenario (aliases allowed) and optional entities
    (loose keys), the first ``n`` by (entity, period), with the slice count."""
    raw = str(scenario).strip().lower()
    sc = next((k for k, names in fn.SCENARIO_ALIASES.items() if raw in names),
              "base" if on_unknown == "base" else None)
    if sc is None:
        raise ValueError(f"unknown scenario {scenario!r}")
    x = fc.filter(F.col("scenario") == sc)
    if entities:
        keys = [k for k in dict.fromkeys(e for e in entities if e and e.strip() and e != "string")]
        x = C.filter_in(x, entity, [_py_key(k) for k in keys], key=fn.norm_key)
    return R.preview(x, n, order=[entity, "period"])


def _py_key(s: str) -> str:
    return "".join(ch for ch in s.strip().lower() if ch.isalnum())


# Q02 -----------------------------------------------------------------------
def auto_summary(shap: DataFrame, k: int = 3, keys=("entity", "scenario", "period")) -> DataFrame:
    """Top ``k`` drivers of each slice with a one-line narrative each."""
    d = A.top_drivers(shap, k=k, keys=keys)
    text = fn.narrate("%s pushes the forecast %s (mean attribution %.4f)", "feature",
                      F.coalesce(F.col("direction"), F.lit("nowhere")), "shap_mean")
    return d.withColumn("text", text)


# Q03 -----------------------------------------------------------------------
def forecast_report(fc: DataFrame, hist: DataFrame, shap: DataFrame, value: str = "avg_price",
                    k: int = 3, strong: float = 0.08, moderate: float = 0.03,
                    percent_thresholds: bool = False, month=None) -> DataFrame:
    """For every (entity, scenario): anchor level (last history month before
    the forecast start), forecast level at the horizon end (or the mean over
    ``month``, a date or a column), change, trend band, top upward / downward
    drivers, driver-card count by importance, risk codes and a one-line text. The change is a fraction compared with fractional
    thresholds; ``percent_thresholds=True`` reproduces the reference's unit
    mix-up (a percent compared with fractional thresholds, SURVEY X13)."""
    keys = ["entity", "scenario"]
    if month is None:
        end, level = F.max("period"), F.max_by("pred", "period")
    else:
        fc = fc.withColumn("_at", F.col("period") == F.lit(month).cast("date"))
        end, level = F.max(F.when(F.col("_at"), F.col("period"))), F.avg(F.when(F.col("_at"), F.col("pred")))
    path = fc.groupBy(*keys).agg(F.min("period").alias("start_period"), end.alias("end_period"), level.alias("future_price"))
    starts = path.groupBy("entity").agg(F.min("start_period").alias("start"))
    anchor = J.asof_anchor(hist, starts, value=value)
    rep = path.join(anchor.select("entity", "anchor_period", F.col("anchor_value").alias("current_price")),
                    "entity", "left")
    change = fn.pct_change_of("future_price", "current_price")
    banded = F.col("change") * 100 if percent_thresholds else F.col("change")
    rep = rep.withColumn("change", change).withColumn("band", fn.trend_band(banded, strong, moderate))
    cards = report_cards(shap, keys, k)
    named = lambda side: F.array_join(F.transform(F.array_sort(F.collect_list(
        F.when(F.col("direction") == side, F.struct("side_rank", "feature")))), lambda x: x["feature"]), ", ")
    told = cards.groupBy(*keys).agg(named("up").alias("drivers_up"), named("down").alias("drivers_down"),
                                    F.count_if(F.col("importance") == "high").alias("n_high"),
                                    F.count_if(F.col("importance") == "medium").alias("n_medium"))
    rep = rep.join(told, keys, "left")
    high, medium = F.coalesce("n_high", F.lit(0)), F.coalesce("n_medium", F.lit(0))
    risks = F.array_join(F.array_compact(F.array(
        F.lit("model_based"),
        F.when(F.lower(F.trim("scenario")).isin("low", "high"), "scenario_conditional"),
        F.when((F.col("band.direction") == "stable") & (high + medium > 0), "offsetting_drivers"),
        F.when((F.col("band.strength") == "strong") & (high == 0), "no_dominant_driver"),
        F.when(F.col("n_high").isNull(), "no_attribution"))), ",")
    text = fn.narrate("%s (%s): %s %s move to %.2f by %s", "entity", "scenario", F.col("band.strength"),
                      F.col("band.direction"), fn.cents("future_price"), F.date_format("end_period", "yyyy-MM"))
    return rep.select(*keys, "start_period", "end_period", "anchor_period", "current_price", "future_price", "change",
                      F.col("band.direction").alias("direction"), F.col("band.strength").alias("strength"),
                      "drivers_up", "drivers_down", high.alias("n_high"), medium.alias("n_medium"), risks.alias("risks"),
                      F.when(F.col("future_price").isNotNull(), text).alias("text"))


def report_cards(shap: DataFrame, keys, k: int = 3) -> DataFrame:
    """The top upward and downward drivers of each slice as cards, by
    magnitude: rank, direction, importance, share of the slice's total, label."""
    hd = A.horizon_drivers(shap, keys, k=k).select(*keys, "feature", F.col("side").alias("direction"), F.col("rank").alias("side_rank"),
                                                   F.col("mean_abs_shap").alias("magnitude"))
    cards = W.driver_cards(hd, keys)
    return cards.withColumn("label", F.format_string("%s (%s, %s)", "feature", "importance", "direction"))


# Q04 -----------------------------------------------------------------------
def compare_entities(reports: DataFrame, a: str, b: str) -> DataFrame:
    """Side by side change of two entities per scenario and the winner."""
    x = reports.filter(F.col("entity").isin(a, b))
    g = x.groupBy("scenario").agg(
        F.max(F.when(F.col("entity") == a, F.col("change"))).alias("change_a"),
        F.max(F.when(F.col("entity") == b, F.col("change"))).alias("change_b"))
    win = (F.when(F.col("change_a").isNull() | F.col("change_b").isNull(), F.lit(None))
           .when(F.col("change_a") > F.col("change_b"), F.lit(a))
           .when(F.col("change_b") > F.col("change_a"), F.lit(b)).otherwise(F.lit("tie")))
    return g.select("scenario", F.lit(a).alias("entity_a"), F.lit(b).alias("entity_b"), "change_a", "change_b",
                    win.alias("winner"))


# Q05 -----------------------------------------------------------------------
def investment_insight(metrics: DataFrame, k: int = 3) -> DataFrame:
    """Ranks on stability, return, volatility, drawdown and spread, the
    defensive rank sum, the leader boards each entity is on, and a profile
    text per entity (the first board that it leads)."""
    ranked = R.investment_ranks(metrics)
    lb = R.leaders(ranked, k=k)
    order = F.array(*[F.lit(b) for b in ("stable", "return", "defensive", "risk")])
    texts = F.array(*[F.lit(t) for t in ("most stable", "highest return", "most defensive", "highest risk")])
    boards = lb.groupBy("entity").agg(F.array_join(F.array_sort(F.collect_list("board")), ",").alias("boards"),
                                      F.min(F.when(F.col("position") == 1, F.array_position(order, F.col("board")))).alias("_first"))
    out = ranked.join(boards, "entity", "left")
    profile = F.coalesce(F.get(texts, (F.col("_first") - 1).cast("int")), F.lit("balanced"))
    return out.select("entity", "rank_stability", "rank_return", "rank_vol", "rank_downside", "rank_spread", "defensive_rank_sum",
                      F.coalesce("boards", F.lit("")).alias("boards"), profile.alias("profile"))


# Q06 -----------------------------------------------------------------------
def dataset_summary(df: DataFrame, period: str = "period", top: int = 1) -> DataFrame:
    """rows, columns, period range, missing months, frequency, largest lag
    in the column names and the column with most missing values."""
    ov = A.overview(df, period)
    miss = J.missing_periods(df.select(period), period).select(F.count("*")).scalar()
    freq = A.infer_frequency(df, period).select("frequency").scalar()
    ms = A.missing_summary(df).orderBy(F.desc("missing_count"), "column").limit(1)
    top_col = ms.select("column").scalar()
    top_cnt = ms.select("missing_count").scalar()
    lag = C.max_lag(df.columns)
    return ov.select("rows", "cols", "period_min", "period_max", "duplicate_rows",
                     miss.alias("missing_months"), freq.alias("frequency"), F.lit(lag).cast("bigint").alias("max_lag"),
                     F.add_months("period_min", -lag).alias("raw_start"),
                     top_col.alias("most_missing_column"), top_cnt.alias("most_missing_count"))


# Q07 -----------------------------------------------------------------------
def spatial_table(fc: DataFrame, hist: DataFrame, entities: DataFrame, scenario: str, month=None,
                  value: str = "avg_price") -> DataFrame:
    """One row per entity of the entity list (left join): anchor level,
    forecast level at ``month`` (a date or a column; default: horizon end),
    change, percent,
    and the reason when something is missing."""
    f = fc.filter(F.col("scenario") == scenario)
    if month is not None:
        f = f.filter(F.col("period") == F.lit(month).cast("date"))
    fut = f.groupBy("entity").agg(F.max_by("pred", "period").alias("future_price"), F.min("period").alias("_fs"))
    starts = fc.filter(F.col("scenario") == scenario).groupBy("entity").agg(F.min("period").alias("start"))
    anc = J.asof_anchor(hist, starts, value=value)
    t = entities.join(anc.select("entity", F.col("anchor_value").alias("current_price")), "entity", "left") \
        .join(fut.select("entity", "future_price"), "entity", "left")
    reason = (F.when(F.col("current_price").isNull() & F.col("future_price").isNull(), "no history and no forecast")
              .when(F.col("current_price").isNull(), "no history").when(F.col("future_price").isNull(), "no forecast"))
    return t.select("entity", "current_price", "future_price",
                    (F.col("future_price") - F.col("current_price")).alias("change"),
                    (fn.pct_change_of("future_price", "current_price") * 100).alias("change_pct"),
                    reason.alias("reason"))


# Q08 -----------------------------------------------------------------------
def route_questions(messages: DataFrame, entities, text: str = "text", default_month=None,
                    default_entity=None) -> DataFrame:
    """Intent and slots of each question, with context defaults, and the
    query that answers it. ``entities`` is a list of names or an array column
    of those in the text (``operators.mentions``)."""
    ents = entities if isinstance(entities, Column) else fn.find_entities(F.col(text), entities)
    month = fn.find_month(F.col(text))
    if default_month is not None:
        month = F.coalesce(month, F.lit(default_month))
    if default_entity is not None:
        ents = F.when(F.size(ents) > 0, ents).otherwise(F.array(F.lit(default_entity)))
    intent = fn.classify_intent(F.col(text))
    x = messages.withColumns({"intent": intent, "month": month, "scenario": fn.find_scenario(F.col(text)),
                              "entities": ents})
    route = (F.when(F.col("intent") == "investment", "investment_insight")
             .when((F.col("intent") == "compare") & (F.size("entities") >= 2), "compare_entities")
             .when(F.col("intent") == "explain", "auto_summary")
             .when(F.size("entities") >= 1, "forecast_report").otherwise("predict_slice"))
    return x.withColumn("route", route).withColumn("n_entities", F.size("entities").cast("bigint")) \
            .withColumn("entity_1", F.try_element_at("entities", F.lit(1))) \
            .withColumn("entity_2", F.try_element_at("entities", F.lit(2))).drop("entities")


# Q09 -----------------------------------------------------------------------
def model_report(test: DataFrame, train: DataFrame, baseline: str, info: float = 30.0, warn: float = 80.0) -> DataFrame:
    """Evaluation, selection and generalisation blocks (tone + text) per model."""
    sel = A.model_selection(test, train, baseline, metric="rmse")
    tone = fn.gap_band("gap_pct", info, warn)
    def r(c, d):  # round half away from zero before printf, so formatters agree
        return F.round(F.col(c) * float(10 ** d)) / float(10 ** d)
    ev = fn.narrate("%s: test RMSE %.4f (%s)", "model", r("test_metric", 4),
                    F.when(F.col("is_best"), "best").when(F.col("is_worst"), "worst").otherwise("middle"))
    se = fn.narrate("%s improves on %s by %.1f%%", "model", F.lit(baseline), r("improvement_pct", 1))
    ge = fn.narrate("%s: train to test RMSE difference %.1f%%", "model", r("gap_pct", 1))
    arr = F.array(F.struct(F.lit("evaluation").alias("block"), F.lit("info").alias("tone"), ev.alias("text")),
                  F.struct(F.lit("selection").alias("block"),
                           F.when(F.col("improvement_pct") > 0, "success").otherwise("info").alias("tone"),
                           se.alias("text")),
                  F.struct(F.lit("generalisation").alias("block"), tone.alias("tone"), ge.alias("text")))
    return sel.select("model", F.explode(arr).alias("b")).select("model", "b.*")


# Q10 -----------------------------------------------------------------------
def driver_bars(shap: DataFrame, group_of: DataFrame, k: int = 5, keys=("entity", "scenario", "period"),
                dummy_prefix: str = "cat__Region_", group: str = "region") -> DataFrame:
    """Mean attribution per feature of each slice, dummies of other groups
    removed (the entity's own group dummy kept), top ``k`` upward (largest
    positive) and top ``k`` downward (most negative)."""
    keys = as_list(keys)
    g = shap.groupBy(*keys, "feature").agg(F.avg("shap_value").alias("shap_value"))
    g = g.join(group_of.select("entity", group), "entity", "left")
    is_dummy = F.col("feature").startswith(dummy_prefix)
    own = F.col("feature") == F.concat(F.lit(dummy_prefix), F.col(group))
    g = g.filter(~is_dummy | own)
    side = F.when(F.col("shap_value") > 0, "up").when(F.col("shap_value") < 0, "down")
    g = g.withColumn("side", side).filter(F.col("side").isNotNull())
    o = F.when(F.col("side") == "up", -F.col("shap_value")).otherwise(F.col("shap_value"))
    w = Window.partitionBy(*keys, "side").orderBy(o, "feature")
    return (g.withColumn("bar_rank", F.row_number().over(w).cast("bigint")).filter(F.col("bar_rank") <= k)
             .withColumn("label", fn.pretty_feature("feature")).drop(group))
