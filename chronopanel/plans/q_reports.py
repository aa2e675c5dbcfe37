"""Registered composite queries (Q01-Q10) and the text-rule queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as fn
from ..functions.text import INTENT_RULES
from ..operators import aggs as A
from ..operators import windows as W
from ..operators.mentions import with_mentions
from . import panels as P
from . import reports as Rp
from .registry import register
from .q_aggs import _PRED_SQL, model_metrics
from .q_reshape import _INV_SQL, _leaders_sql

D6 = 6


def messages(t):
    """Every given text: (src, id, turn, text, entities), with the nations that
    it names."""
    c = t("conversations").select(F.lit("conversations").alias("src"), F.col("conv_id").alias("id"), "turn", "text")
    d = t("documents").select(F.lit("documents").alias("src"), F.col("doc_id").alias("id"), F.lit(0).cast("bigint").alias("turn"), "text")
    return with_mentions(c.unionByName(d), "text", t("nation"), "n_name", "n_nationkey")


_Q_SQL = """messages AS (
  SELECT 'conversations' AS src, conv_id AS id, turn, text, lower(text) AS low FROM conversations
  UNION ALL SELECT 'documents', doc_id, CAST(0 AS BIGINT), text, lower(text) FROM documents),
names AS (SELECT list(n_name ORDER BY n_nationkey) AS names FROM nation)"""


def _lst(words):
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def _any_sql(t, words):
    return f"len(list_filter({_lst(words)}, lambda w: instr({t}, w) > 0)) > 0"


def _intent_sql(col):
    t = f"lower(trim({col}))"
    r = INTENT_RULES
    return (f"CASE WHEN {t} IS NULL OR {t} = '' THEN 'empty' "
            f"WHEN {_any_sql(t, r['investment_triggers'])} AND {_any_sql(t, r['investment_choice'])} THEN 'investment' "
            f"WHEN {_any_sql(t, r['compare'])} THEN 'compare' WHEN {_any_sql(t, r['explain'])} THEN 'explain' "
            f"ELSE 'forecast' END")


def _entities_sql():
    exact = "list_filter(names, lambda e: instr(low, lower(e)) > 0)"
    tk = "regexp_replace(trim(low), '[^\\pL\\pN]', '', 'g')"
    loose = f"list_filter(names, lambda e: instr({tk}, regexp_replace(lower(e), '[^\\pL\\pN]', '', 'g')) > 0)"
    return f"CASE WHEN len({exact}) > 0 THEN {exact} ELSE {loose} END"


_MONTH_SQL = r"""CASE WHEN regexp_extract({c}, '\b(20\d{{2}})[-/](\d{{2}})(?:[-/]\d{{2}})?\b', 0) <> ''
  THEN substr(regexp_extract({c}, '\b(20\d{{2}})[-/](\d{{2}})(?:[-/]\d{{2}})?\b', 0), 1, 4) || '-' ||
       substr(regexp_extract({c}, '\b(20\d{{2}})[-/](\d{{2}})(?:[-/]\d{{2}})?\b', 0), 6, 2) END"""
_SCEN_SQL = r"""CASE WHEN regexp_matches(lower({c}), '\blow\b') THEN 'low' WHEN regexp_matches(lower({c}), '\bhigh\b') THEN 'high'
  WHEN regexp_matches(lower({c}), '\bbase\b') THEN 'base' ELSE 'base' END"""


@register("classify_intent", "P32", sql=f"""
SELECT 'conversations' AS src, conv_id AS id, turn, {_intent_sql('text')} AS intent FROM conversations
UNION ALL SELECT 'documents', doc_id, CAST(0 AS BIGINT), {_intent_sql('text')} FROM documents""")
def classify_intent(t):
    c = t("conversations").select(F.lit("conversations").alias("src"), F.col("conv_id").alias("id"), "turn",
                                  fn.classify_intent("text").alias("intent"))
    d = t("documents").select(F.lit("documents").alias("src"), F.col("doc_id").alias("id"),
                              F.lit(0).cast("bigint").alias("turn"), fn.classify_intent("text").alias("intent"))
    return c.unionByName(d)


@register("extract_slots", "P31", sql=_Q_SQL + f""",
s AS (SELECT src, id, turn, {_MONTH_SQL.format(c='text')} AS month, {_SCEN_SQL.format(c='text')} AS scenario,
             {_entities_sql()} AS ents FROM messages, names)
SELECT src, id, turn, month, scenario, CAST(len(ents) AS BIGINT) AS n_entities, ents[1] AS entity_1, ents[2] AS entity_2 FROM s""")
def extract_slots(t):
    x = messages(t).select("src", "id", "turn", fn.find_month("text").alias("month"), fn.find_scenario("text").alias("scenario"),
                           F.col("entities").alias("e"))
    return x.select("src", "id", "turn", "month", "scenario", F.size("e").cast("bigint").alias("n_entities"),
                    F.try_element_at("e", F.lit(1)).alias("entity_1"), F.try_element_at("e", F.lit(2)).alias("entity_2"))


@register("route_questions", "Q08 P31 P32", sql=_Q_SQL + f""",
s AS (SELECT src, id, turn, {_intent_sql('text')} AS intent,
             coalesce({_MONTH_SQL.format(c='text')}, '2001-01') AS month, {_SCEN_SQL.format(c='text')} AS scenario,
             {_entities_sql()} AS ents FROM messages, names)
SELECT src, id, turn, intent, month, scenario,
       CASE WHEN intent = 'investment' THEN 'investment_insight'
            WHEN intent = 'compare' AND len(ents) >= 2 THEN 'compare_entities'
            WHEN intent = 'explain' THEN 'auto_summary'
            WHEN len(ents) >= 1 THEN 'forecast_report' ELSE 'predict_slice' END AS route,
       CAST(len(ents) AS BIGINT) AS n_entities, ents[1] AS entity_1, ents[2] AS entity_2
FROM s""")
def route_questions(t):
    return Rp.route_questions(messages(t), F.col("entities"), default_month="2001-01").drop("text")


@register("parse_bullets", "P33 P30", ctes=["nation_month"], digits={"value": 2}, sql=r"""
b AS (SELECT entity, printf('- Mean price: %.2f', round(avg(avg_price) * 100.0) / 100.0) || chr(10) || printf('- Months: %d', count(*)) || chr(10) ||
             printf('- Orders: %d', sum(sales_count)) || chr(10) || 'no bullet here' AS text
      FROM nation_month GROUP BY entity),
l AS (SELECT entity, unnest(string_split(text, chr(10))) AS line FROM b)
SELECT entity, trim(regexp_extract(line, '^\s*[-*•]\s*([^:]+):\s*([-+]?[0-9][0-9,]*\.?[0-9]*)\s*(%?)', 1)) AS name,
       TRY_CAST(replace(regexp_extract(line, '^\s*[-*•]\s*([^:]+):\s*([-+]?[0-9][0-9,]*\.?[0-9]*)\s*(%?)', 2), ',', '') AS DOUBLE) AS value,
       regexp_extract(line, '^\s*[-*•]\s*([^:]+):\s*([-+]?[0-9][0-9,]*\.?[0-9]*)\s*(%?)', 3) = '%' AS is_percent
FROM l WHERE trim(regexp_extract(line, '^\s*[-*•]\s*([^:]+):\s*([-+]?[0-9][0-9,]*\.?[0-9]*)\s*(%?)', 1)) <> ''""")
def parse_bullets(t):
    g = P.nation_month(t).groupBy("entity").agg(F.avg("avg_price").alias("m"), F.count("*").alias("n"),
                                                F.sum("sales_count").alias("s"))
    text = F.concat_ws("\n", fn.narrate("- Mean price: %.2f", fn.cents("m")), fn.narrate("- Months: %d", "n"),
                       fn.narrate("- Orders: %d", "s"), F.lit("no bullet here"))
    lines = g.select("entity", F.explode(F.split(text, "\n")).alias("line"))
    b = lines.select("entity", fn.bullet_metric("line").alias("b")).filter(F.col("b").isNotNull())
    return b.select("entity", "b.name", "b.value", "b.is_percent")


@register("predict_slice", "Q01 P23 P24 P25 L04", materialize=["nation_month"], ctes=["scenario_fc"], digits={"pred": 4, "pred_log": 9}, sql=r"""
s AS (SELECT * FROM scenario_fc WHERE scenario = 'low'
      AND regexp_replace(lower(trim(entity)), '[^\pL\pN]', '', 'g') IN ('nation1', 'nation2', 'nation13'))
SELECT period, entity, scenario, pred, pred_log, (SELECT count(*) FROM s) AS total_rows
FROM s ORDER BY entity, period LIMIT 20""")
def predict_slice(t):
    return Rp.predict_slice(P.scenario_fc(t), " Lower ", ["nation 1", "NATION_2", "nation_13", "", "string"], n=20)


@register("auto_summary", "Q02 A15 P30", materialize=["nation_month"], ctes=["attrib_long"], digits={"magnitude": 9, "shap_mean": 9}, sql="""
g AS (SELECT entity, scenario, period, trim(feature) AS feature, avg(abs_shap) AS magnitude, avg(shap_value) AS shap_mean
      FROM attrib_long WHERE abs_shap IS NOT NULL GROUP BY 1, 2, 3, 4),
r AS (SELECT *, row_number() OVER (PARTITION BY entity, scenario, period ORDER BY magnitude DESC, feature) AS rank FROM g)
SELECT entity, scenario, period, feature, magnitude, shap_mean, CAST(rank AS BIGINT) AS rank,
       CASE WHEN shap_mean > 0 THEN 'up' WHEN shap_mean < 0 THEN 'down' END AS direction,
       printf('%s pushes the forecast %s (mean attribution %.4f)', feature,
              coalesce(CASE WHEN shap_mean > 0 THEN 'up' WHEN shap_mean < 0 THEN 'down' END, 'nowhere'), shap_mean) AS text
FROM r WHERE rank <= 3""")
def auto_summary(t):
    return Rp.auto_summary(P.attrib_long(t), k=3)


_PATH_SQL = """
path AS (SELECT entity, scenario, min(period) AS start_period, max(period) AS end_period, arg_max(pred, period) AS future_price
         FROM scenario_fc GROUP BY 1, 2),"""
_MONTH_PATH_SQL = """
path AS (SELECT entity, scenario, min(period) AS start_period, max(period) FILTER (WHERE period = m) AS end_period,
                avg(pred) FILTER (WHERE period = m) AS future_price
         FROM scenario_fc, (SELECT CAST(min(period) + INTERVAL 5 MONTH AS DATE) AS m FROM scenario_fc) GROUP BY 1, 2),"""
_DRIVERS_SQL = """
hg AS (SELECT entity, scenario, feature, avg(shap_value) AS mean_shap, avg(abs(shap_value)) AS mean_abs_shap FROM attrib_long GROUP BY 1, 2, 3),
hs AS (SELECT *, CASE WHEN mean_shap > 0 THEN 'up' WHEN mean_shap < 0 THEN 'down' END AS side FROM hg),
hd AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity, scenario, side ORDER BY CASE WHEN side = 'up' THEN -mean_abs_shap ELSE mean_shap END, feature) AS rank
                      FROM hs WHERE side IS NOT NULL) WHERE rank <= 3),"""
_REPORT_SQL = """
st AS (SELECT entity, min(start_period) AS start FROM path GROUP BY 1),
hj AS (SELECT h.entity, h.period, h.avg_price, st.start FROM nation_month h JOIN st ON h.entity = st.entity),
anc AS (SELECT entity, CASE WHEN max(period) FILTER (WHERE period < start) IS NOT NULL THEN max(period) FILTER (WHERE period < start) ELSE max(period) END AS anchor_period,
               CASE WHEN max(period) FILTER (WHERE period < start) IS NOT NULL THEN arg_max(avg_price, period) FILTER (WHERE period < start)
                    ELSE arg_max(avg_price, period) END AS current_price FROM hj GROUP BY 1),
rep0 AS (SELECT p.*, a.anchor_period, a.current_price,
                CASE WHEN a.current_price IS NOT NULL AND a.current_price <> 0 THEN p.future_price / a.current_price - 1 END AS change
         FROM path p LEFT JOIN anc a ON p.entity = a.entity),""" + _DRIVERS_SQL + """
lists AS (SELECT entity, scenario,
                 array_to_string(list(feature ORDER BY rank) FILTER (WHERE side = 'up'), ', ') AS drivers_up,
                 array_to_string(list(feature ORDER BY rank) FILTER (WHERE side = 'down'), ', ') AS drivers_down
          FROM hd GROUP BY 1, 2),
ct AS (SELECT entity, scenario, sum(abs(mean_abs_shap)) AS tot FROM hd GROUP BY 1, 2),
cards AS (SELECT hd.entity, hd.scenario,
                 count_if(CASE WHEN tot > 0 THEN abs(mean_abs_shap) / tot END >= 0.25) AS n_high,
                 count_if(CASE WHEN tot > 0 THEN abs(mean_abs_shap) / tot END < 0.25 AND CASE WHEN tot > 0 THEN abs(mean_abs_shap) / tot END >= 0.10) AS n_medium
          FROM hd JOIN ct ON hd.entity = ct.entity AND hd.scenario = ct.scenario GROUP BY 1, 2),
rep AS (SELECT r.*,
               CASE WHEN change IS NULL THEN 'unknown' WHEN change >= 0.03 THEN 'increase' WHEN change <= -0.03 THEN 'decrease' ELSE 'stable' END AS direction,
               CASE WHEN change IS NULL THEN 'unknown' WHEN change >= 0.08 OR change <= -0.08 THEN 'strong'
                    WHEN change >= 0.03 OR change <= -0.03 THEN 'moderate' ELSE 'weak' END AS strength,
               l.drivers_up, l.drivers_down, coalesce(c.n_high, 0) AS n_high, coalesce(c.n_medium, 0) AS n_medium
        FROM rep0 r LEFT JOIN lists l ON r.entity = l.entity AND r.scenario = l.scenario
             LEFT JOIN cards c ON r.entity = c.entity AND r.scenario = c.scenario)"""


_REPORT_SELECT = """
SELECT entity, scenario, start_period, end_period, anchor_period, current_price, future_price, change, direction, strength,
       drivers_up, drivers_down, CAST(n_high AS BIGINT) AS n_high, CAST(n_medium AS BIGINT) AS n_medium,
       array_to_string(list_filter(['model_based', CASE WHEN scenario IN ('low', 'high') THEN 'scenario_conditional' END,
         CASE WHEN direction = 'stable' AND n_high + n_medium > 0 THEN 'offsetting_drivers' END,
         CASE WHEN strength = 'strong' AND n_high = 0 THEN 'no_dominant_driver' END,
         CASE WHEN drivers_up IS NULL AND drivers_down IS NULL THEN 'no_attribution' END], lambda r: r IS NOT NULL), ',') AS risks,
       printf('%s (%s): %s %s move to %.2f by %s', entity, scenario, strength, direction, round(future_price * 100.0) / 100.0,
              strftime(end_period, '%Y-%m')) AS text
FROM rep"""
# panels that the report uses more than once
_REPORT_PANELS = ["nation_month", "scenario_fc", "attrib_long"]


@register("forecast_report", "Q03 J07 A16 P27 P28 W10 P30", materialize=_REPORT_PANELS, ctes=["nation_month", "scenario_fc", "attrib_long"],
          digits={"current_price": 4, "future_price": 4, "change": 9}, sql=_PATH_SQL + _REPORT_SQL + _REPORT_SELECT)
def forecast_report(t):
    return Rp.forecast_report(P.scenario_fc(t), P.nation_month(t).select("entity", "period", "avg_price"),
                              P.attrib_long(t))


@register("forecast_report_month", "Q03", materialize=_REPORT_PANELS, ctes=["nation_month", "scenario_fc", "attrib_long"],
          digits={"current_price": 4, "future_price": 4, "change": 9}, sql=_MONTH_PATH_SQL + _REPORT_SQL + _REPORT_SELECT)
def forecast_report_month(t):
    """The sixth forecast month instead of the horizon's end."""
    fc = P.scenario_fc(t)
    month = fc.select(F.add_months(F.min("period"), 5)).scalar()
    return Rp.forecast_report(fc, P.nation_month(t).select("entity", "period", "avg_price"), P.attrib_long(t), month=month)


@register("forecast_cards", "Q03 W10 A16", materialize=["nation_month"], ctes=["scenario_fc", "attrib_long"], digits={"share": 9}, sql=_DRIVERS_SQL + """
c AS (SELECT *, sum(mean_abs_shap) OVER (PARTITION BY entity, scenario) AS tot,
             row_number() OVER (PARTITION BY entity, scenario ORDER BY mean_abs_shap DESC, feature) AS card_rank FROM hd),
d AS (SELECT *, CASE WHEN tot > 0 THEN mean_abs_shap / tot END AS share FROM c),
e AS (SELECT *, CASE WHEN share >= 0.25 THEN 'high' WHEN share >= 0.10 THEN 'medium' ELSE 'low' END AS importance FROM d)
SELECT entity, scenario, CAST(card_rank AS BIGINT) AS card_rank, feature, side AS direction, importance, share,
       printf('%s (%s, %s)', feature, importance, side) AS label FROM e""")
def forecast_cards(t):
    return Rp.report_cards(P.attrib_long(t), ["entity", "scenario"]).select(
        "entity", "scenario", "card_rank", "feature", "direction", "importance", "share", "label")


@register("compare_entities", "Q04 Q03", materialize=_REPORT_PANELS, ctes=["nation_month", "scenario_fc", "attrib_long"],
          digits={"change_a": 9, "change_b": 9}, sql=_PATH_SQL + _REPORT_SQL + """,
g AS (SELECT scenario, max(CASE WHEN entity = 'NATION_1' THEN change END) AS change_a,
             max(CASE WHEN entity = 'NATION_2' THEN change END) AS change_b
      FROM rep WHERE entity IN ('NATION_1', 'NATION_2') GROUP BY scenario)
SELECT scenario, 'NATION_1' AS entity_a, 'NATION_2' AS entity_b, change_a, change_b,
       CASE WHEN change_a IS NULL OR change_b IS NULL THEN NULL WHEN change_a > change_b THEN 'NATION_1'
            WHEN change_b > change_a THEN 'NATION_2' ELSE 'tie' END AS winner
FROM g""")
def compare_entities(t):
    rep = Rp.forecast_report(P.scenario_fc(t), P.nation_month(t).select("entity", "period", "avg_price"),
                             P.attrib_long(t))
    return Rp.compare_entities(rep, "NATION_1", "NATION_2")


@register("investment_insight", "Q05 W09 L03 A14", materialize=["nation_month"], ctes=["scenario_fc"],
          sql=_INV_SQL + _leaders_sql(3, """,
lb AS (SELECT entity, array_to_string(list_sort(list(board)), ',') AS boards,
              min(CASE WHEN position = 1 THEN CASE board WHEN 'stable' THEN 0 WHEN 'return' THEN 1 WHEN 'defensive' THEN 2 ELSE 3 END END) AS first_board
       FROM b WHERE keep GROUP BY entity)
SELECT rk.entity, rank_stability, rank_return, rank_vol, rank_downside, rank_spread, defensive_rank_sum, coalesce(lb.boards, '') AS boards,
       CASE first_board WHEN 0 THEN 'most stable' WHEN 1 THEN 'highest return' WHEN 2 THEN 'most defensive' WHEN 3 THEN 'highest risk' ELSE 'balanced' END AS profile
FROM rk LEFT JOIN lb ON rk.entity = lb.entity"""))
def investment_insight(t):
    return Rp.investment_insight(A.investment_metrics(P.scenario_fc(t)), k=3)


@register("dataset_summary", "Q06 A10 A11 A19 J11 P37", materialize=["nation_month"], ctes=["nation_lags"], sql="""
x AS (SELECT * FROM nation_lags),
cal AS (SELECT CAST(unnest(generate_series(min(period), max(period), INTERVAL 1 MONTH)) AS DATE) AS period FROM x),
mm AS (SELECT count(*) AS n FROM cal WHERE period NOT IN (SELECT period FROM x)),
gaps AS (SELECT datediff('day', lag(period) OVER (ORDER BY period), period) AS gap FROM (SELECT DISTINCT period FROM x)),
fr AS (SELECT CASE WHEN (SELECT count(DISTINCT period) FROM x) < 3 THEN 'Unknown'
                   WHEN quantile_cont(gap, 0.5) BETWEEN 25 AND 35 THEN 'Monthly' ELSE 'Irregular' END AS f FROM gaps),
ms0 AS (SELECT 'period' AS c, CAST(count_if(period IS NULL) AS BIGINT) AS n FROM x
  UNION ALL SELECT 'entity' AS c, CAST(count_if(entity IS NULL) AS BIGINT) AS n FROM x
  UNION ALL SELECT 'region' AS c, CAST(count_if(region IS NULL) AS BIGINT) AS n FROM x
  UNION ALL SELECT 'avg_price' AS c, CAST(count_if(avg_price IS NULL OR isnan(avg_price)) AS BIGINT) AS n FROM x
  UNION ALL SELECT 'sales_count' AS c, CAST(count_if(sales_count IS NULL) AS BIGINT) AS n FROM x
  UNION ALL SELECT 'total_price' AS c, CAST(count_if(total_price IS NULL OR isnan(total_price)) AS BIGINT) AS n FROM x
  UNION ALL SELECT 'avg_price_high' AS c, CAST(count_if(avg_price_high IS NULL OR isnan(avg_price_high)) AS BIGINT) AS n FROM x
  UNION ALL SELECT 'avg_price_low' AS c, CAST(count_if(avg_price_low IS NULL OR isnan(avg_price_low)) AS BIGINT) AS n FROM x
  UNION ALL SELECT 'avg_price_lag1' AS c, CAST(count_if(avg_price_lag1 IS NULL OR isnan(avg_price_lag1)) AS BIGINT) AS n FROM x
  UNION ALL SELECT 'avg_price_lag12' AS c, CAST(count_if(avg_price_lag12 IS NULL OR isnan(avg_price_lag12)) AS BIGINT) AS n FROM x),
ms AS (SELECT c, n FROM ms0 ORDER BY n DESC, c LIMIT 1)
SELECT count(*) AS rows, CAST(10 AS BIGINT) AS cols, min(period) AS period_min, max(period) AS period_max,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM x)) AS duplicate_rows,
       (SELECT n FROM mm) AS missing_months, (SELECT f FROM fr) AS frequency, CAST(12 AS BIGINT) AS max_lag,
       CAST(min(period) - INTERVAL 12 MONTH AS DATE) AS raw_start,
       (SELECT c FROM ms) AS most_missing_column, (SELECT n FROM ms) AS most_missing_count
FROM x""")
def dataset_summary(t):
    return Rp.dataset_summary(P.nation_lags(t))


@register("spatial_table", "Q07 J07 P27", materialize=["nation_month"], ctes=["nation_month", "scenario_fc"], digits={
    "current_price": 4, "future_price": 4, "change": 4, "change_pct": 6}, sql="""
f AS (SELECT entity, arg_max(pred, period) AS future_price FROM scenario_fc
      WHERE scenario = 'high' AND period = (SELECT max(period) FROM scenario_fc) GROUP BY 1),
st AS (SELECT entity, min(period) AS start FROM scenario_fc WHERE scenario = 'high' GROUP BY 1),
hj AS (SELECT h.entity, h.period, h.avg_price, st.start FROM nation_month h JOIN st ON h.entity = st.entity),
anc AS (SELECT entity, CASE WHEN max(period) FILTER (WHERE period < start) IS NOT NULL
                            THEN arg_max(avg_price, period) FILTER (WHERE period < start) ELSE arg_max(avg_price, period) END AS current_price
        FROM hj GROUP BY 1)
SELECT n.n_name AS entity, a.current_price, f.future_price, f.future_price - a.current_price AS change,
       CASE WHEN a.current_price IS NOT NULL AND a.current_price <> 0 THEN f.future_price / a.current_price - 1 END * 100 AS change_pct,
       CASE WHEN a.current_price IS NULL AND f.future_price IS NULL THEN 'no history and no forecast'
            WHEN a.current_price IS NULL THEN 'no history' WHEN f.future_price IS NULL THEN 'no forecast' END AS reason
FROM nation n LEFT JOIN anc a ON n.n_name = a.entity LEFT JOIN f ON n.n_name = f.entity""")
def spatial_table(t):
    fc = P.scenario_fc(t)
    last = fc.select(F.max("period")).scalar()
    ents = t("nation").select(F.col("n_name").alias("entity"))
    return Rp.spatial_table(fc, P.nation_month(t).select("entity", "period", "avg_price"), ents, "high", month=last)


@register("model_report", "Q09 A24 P29 P30", materialize=["nation_month"], ctes=["nation_month"], sql=_PRED_SQL + """,
te AS (SELECT model, rmse FROM met WHERE split = 'test'), tr AS (SELECT model, rmse FROM met WHERE split = 'train'),
base AS (SELECT rmse AS b FROM te WHERE model = 'naive'),
sel AS (SELECT te.model, te.rmse AS test_metric,
               CASE WHEN (SELECT b FROM base) <> 0 THEN ((SELECT b FROM base) - te.rmse) / (SELECT b FROM base) * 100 END AS improvement_pct,
               CASE WHEN tr.rmse <> 0 THEN (te.rmse - tr.rmse) / tr.rmse * 100 END AS gap_pct,
               te.rmse = (SELECT min(rmse) FROM te) AS is_best, te.rmse = (SELECT max(rmse) FROM te) AS is_worst
        FROM te LEFT JOIN tr ON te.model = tr.model)
SELECT model, 'evaluation' AS block, 'info' AS tone,
       printf('%s: test RMSE %.4f (%s)', model, round(test_metric * 10000.0) / 10000.0,
              CASE WHEN is_best THEN 'best' WHEN is_worst THEN 'worst' ELSE 'middle' END) AS text FROM sel
UNION ALL SELECT model, 'selection', CASE WHEN improvement_pct > 0 THEN 'success' ELSE 'info' END,
       printf('%s improves on %s by %.1f%%', model, 'naive', round(improvement_pct * 10.0) / 10.0) FROM sel
UNION ALL SELECT model, 'generalisation',
       CASE WHEN gap_pct IS NULL THEN 'unknown' WHEN gap_pct <= 30 THEN 'success' WHEN gap_pct <= 80 THEN 'info' ELSE 'warning' END,
       printf('%s: train to test RMSE difference %.1f%%', model, round(gap_pct * 10.0) / 10.0) FROM sel""")
def model_report(t):
    m = model_metrics(t)
    return Rp.model_report(m.filter("split = 'test'"), m.filter("split = 'train'"), "naive")


@register("driver_bars", "Q10 A15 P36", materialize=["nation_month"], ctes=["attrib_long", "nation_month"], digits={"shap_value": 9}, sql="""
g AS (SELECT entity, scenario, period, feature, avg(shap_value) AS shap_value FROM attrib_long GROUP BY 1, 2, 3, 4),
rg AS (SELECT DISTINCT entity, region FROM nation_month),
k AS (SELECT g.*, CASE WHEN shap_value > 0 THEN 'up' WHEN shap_value < 0 THEN 'down' END AS side
      FROM g LEFT JOIN rg ON g.entity = rg.entity
      WHERE NOT starts_with(feature, 'cat__Region_') OR feature = 'cat__Region_' || rg.region),
r AS (SELECT *, row_number() OVER (PARTITION BY entity, scenario, period, side
                                   ORDER BY CASE WHEN side = 'up' THEN -shap_value ELSE shap_value END, feature) AS bar_rank
      FROM k WHERE side IS NOT NULL)
SELECT entity, scenario, period, feature, shap_value, side, CAST(bar_rank AS BIGINT) AS bar_rank,
       regexp_replace(feature, '^(num|cat|remainder)__', '') AS label
FROM r WHERE bar_rank <= 5""")
def driver_bars(t):
    regions = P.nation_month(t).select("entity", "region").distinct()
    return Rp.driver_bars(P.attrib_long(t), regions, k=5)
