"""Edge fixtures for the column functions and table operators."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from chronopanel import functions as fn
from chronopanel.operators import aggs as A
from chronopanel.operators import columns as C
from chronopanel.operators import joins as J
from chronopanel.operators import reshape as R
from chronopanel.operators import windows as W

D = dt.date


def test_dates_mixed(spark):
    rows = [("2025-07",), ("2025/07/01",), ("1/07/2025",), ("2006Q1",), ("2018M01",), ("",), ("Total",), (None,)]
    df = spark.createDataFrame(rows, "s string")
    out = df.select("s", fn.parse_month_any("s").alias("m"), fn.norm_month("s").alias("k"),
                    fn.quarter_start("s").alias("q"), fn.ym_to_date("s").alias("ym")).collect()
    got = {r["s"]: r for r in out}
    assert got["2025-07"]["m"] == D(2025, 7, 1)
    assert got["2025/07/01"]["m"] == D(2025, 7, 1)
    assert got["1/07/2025"]["m"] == D(2025, 7, 1)        # day first
    assert got["2006Q1"]["q"] == D(2006, 1, 1)
    assert got["2018M01"]["ym"] == D(2018, 1, 1)
    assert got["Total"]["m"] is None and got["Total"]["k"] == "Total"
    assert got[""]["k"] == ""


def test_parse_year_and_numbers(spark):
    df = spark.createDataFrame([("2001",), ("2002.0",), ("Total",), (" 1,234.5 ",)], "s string")
    assert [r.s for r in fn.parse_year(df, "s", strict=True).collect()] == [2001]
    assert sorted(r.s for r in fn.parse_year(df, "s", strict=False).collect()) == [2001, 2002]
    v = df.select(fn.parse_grouped_number("s").alias("v")).collect()
    assert v[3].v == 1234.5 and v[2].v is None


def test_best_date_format_prefers_dayfirst(spark):
    df = spark.createDataFrame([("13/01/2020",), ("1/02/2020",), ("25/12/2020",)], "s string")
    r = fn.best_date_format(df, "s").first()
    assert r.rule == "dayfirst" and r.parsed == 3
    out = fn.standardize_month(df, "s").collect()
    assert {x.s for x in out} == {D(2020, 1, 1), D(2020, 2, 1), D(2020, 12, 1)}


def test_null_wide_row_ops(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (None, None, None)], "a double, b double, c double")
    r = df.select(fn.row_sum(["a", "b", "c"]).alias("s"), fn.row_mean(["a", "b", "c"]).alias("m")).collect()
    assert r[0].s == 4.0 and r[0].m == 2.0
    assert r[1].s == 0.0 and r[1].m is None


def test_nonpositive_log_guard(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (-2.0,)], "x double")
    with pytest.raises(ValueError):
        C.log_columns(df, ["x"], check=True)
    out = C.log_columns(df, ["x"]).collect()
    assert out[0].log_x == 0.0 and out[1].log_x is None and out[2].log_x is None


def test_dup_keys_checked_join(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    b = spark.createDataFrame([(1, "z"), (1, "w")], "k int, u string")
    with pytest.raises(ValueError):
        J.checked_join(a, b, ["k"], validate="many_to_one")
    assert J.duplicate_keys(a, ["k"]).first().n == 2


def test_scenario_cross_and_aliases(spark):
    fc = spark.createDataFrame([(D(2025, 1, 1), "e", "base", 10.0), (D(2025, 1, 1), "e", "low", 12.0),
                                (D(2025, 1, 1), "e", "high", 11.0)], "period date, entity string, scenario string, pred double")
    fan = A.scenario_fan(fc, cols=["pred"]).first()
    assert fan.pred_low == 11.0 and fan.pred_high == 12.0 and fan.swapped
    s = spark.createDataFrame([("Lower",), (" HIGH ",), ("mid",), ("sideways",)], "s string")
    got = [r.x for r in s.select(fn.norm_scenario("s").alias("x")).collect()]
    assert got == ["low", "high", None, None]
    got = [r.x for r in s.select(fn.norm_scenario("s", on_unknown="base").alias("x")).collect()]
    assert got[-2:] == ["base", "base"]


def test_ties_rank_min(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 2.0), ("d", None)], "e string, v double")
    r = {x.e: x.rank_v for x in W.rank_columns(df, {"v": True}).collect()}
    assert r == {"c": 1, "a": 2, "b": 2, "d": None}


def test_zero_base(spark):
    fc = spark.createDataFrame([(D(2025, m, 1), "e", s, 0.0 if m == 1 else 5.0)
                                for m in range(1, 5) for s in ("base", "low", "high")],
                               "period date, entity string, scenario string, pred double")
    r = A.investment_metrics(fc).first()
    assert r.expected_return_base is None and r.stability_score is None
    x = spark.createDataFrame([("e", D(2025, 1, 1), 0.0), ("e", D(2025, 2, 1), 3.0)], "entity string, period date, v double")
    assert [r.v_index for r in W.rebase(x, "entity", "period", "v").collect()] == [None, None]


def test_gap_panel_lags_and_calendar(spark):
    rows = [("a", D(2020, m, 1), float(m)) for m in (1, 2, 4, 5, 7)] + [("b", D(2020, 3, 1), 9.0)]
    df = spark.createDataFrame(rows, "entity string, period date, v double")
    rl = {(r.entity, r.period): r.v_lag1 for r in W.add_lags(df, "entity", "period", ["v"], [1]).collect()}
    assert rl[("a", D(2020, 4, 1))] == 2.0         # row lag reaches across the gap
    cl = {(r.entity, r.period): r.v_lag1 for r in
          W.add_lags(df, "entity", "period", ["v"], [1], mode="calendar").collect()}
    assert cl[("a", D(2020, 4, 1))] is None
    miss = {(r.entity, r.period) for r in J.missing_periods(df, "period", by=["entity"]).collect()}
    assert miss == {("a", D(2020, 3, 1)), ("a", D(2020, 6, 1))}
    cov = {r.entity: r.n_periods for r in A.coverage(df, "entity", "period").collect()}
    assert cov == {"a": 5, "b": 1}


def test_upsample_linear(spark):
    df = spark.createDataFrame([("e", D(2020, 1, 1), 1.0), ("e", D(2020, 4, 1), 4.0), ("e", D(2020, 10, 1), 10.0)],
                               "entity string, period date, v double")
    out = sorted((r.period, r.v) for r in W.upsample_linear(df, "entity", "period", ["v"]).collect())
    assert [v for _, v in out] == [float(i) for i in range(1, 11)]


def test_month_and_row_folds(spark):
    df = spark.createDataFrame([("e", D(2000 + m // 12, m % 12 + 1, 1)) for m in range(40)], "entity string, period date")
    f = W.month_folds(df, "period", n_splits=3, min_train=20, val=5)
    for r in f.groupBy("fold").agg(F.max(F.when(F.col("role") == "train", F.col("period"))).alias("tr"),
                                   F.min(F.when(F.col("role") == "validation", F.col("period"))).alias("va")).collect():
        assert r.tr < r.va           # never train on a later month
    rf = W.row_folds(df, ["period"], n_splits=5)
    c = {(r.fold, r.role): r.n for r in rf.groupBy("fold", "role").agg(F.count("*").alias("n")).collect()}
    assert c[(0, "train")] == 40 - 5 * 6 and c[(0, "validation")] == 6 and c[(4, "train")] == 34


def test_shares_and_disaggregation(spark):
    df = spark.createDataFrame([("a", D(2020, m, 1), 1.0) for m in range(1, 13)] +
                               [("b", D(2020, m, 1), 3.0) for m in range(1, 13)], "entity string, period date, v double")
    sh = A.trailing_shares(df, "period", "entity", "v", 12)
    assert abs(sum(r.share for r in sh.collect()) - 1) < 1e-12
    tot = spark.createDataFrame([(D(2021, 1, 1), 100.0)], "period date, v double")
    d = J.disaggregate(tot, sh, ["v"], ["share"]).collect()
    assert abs(sum(r.v for r in d) - 100.0) < 1e-9


def test_questions_routing(spark):
    from chronopanel.plans.reports import route_questions
    q = spark.createDataFrame([("Compare Alpha vs Beta in 2025-07 low",), ("why does alpha rise",),
                               ("Which area is the safest to invest for stable return?",), ("",)], "text string")
    r = route_questions(q, ["Alpha", "Beta"]).collect()
    assert r[0].route == "compare_entities" and r[0].month == "2025-07" and r[0].scenario == "low"
    assert r[1].route == "auto_summary" and r[1].entity_1 == "Alpha"
    assert r[2].intent == "investment"
    assert r[3].intent == "empty"


def test_capped_sample_deterministic(spark):
    df = spark.range(1000).withColumn("g", F.col("id") % 3)
    a = {r.id for r in R.capped_sample(df, 5, ["id"], by=["g"]).collect()}
    b = {r.id for r in R.capped_sample(df.repartition(7), 5, ["id"], by=["g"]).collect()}
    assert a == b and len(a) == 15


def test_sort_based_quantiles_match_map_based_with_hot_group(spark):
    # one key holds a third of the rows
    df = spark.range(3000).select(F.when(F.col("id") < 1000, "hot").otherwise(
        F.concat(F.lit("k"), (F.col("id") % 7).cast("string"))).alias("g"),
        (F.sin(F.col("id")) * 100).alias("v")).repartition(6)
    # and repeated values, missing values and a missing group key
    df = df.union(df.select("g", F.round("v", -1).alias("v"))).union(
        spark.createDataFrame([("hot", None), (None, 1.0), (None, 2.0), ("hot", float("nan"))], "g string, v double"))
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    d = df.where("v is not null and not isnan(v)")
    a = {r.g: r.q for r in d.groupBy("g").agg(F.percentile("v", probs).alias("q")).collect()}
    b = {(r.g, r.p): r.q for r in A.quantile_table(df, "v", probs, ["g"]).collect()}
    assert {(g, p) for g in a for p in probs} == set(b)
    assert all(abs(a[g][probs.index(p)] - q) < 1e-9 for (g, p), q in b.items())
    lo, hi = d.agg(F.percentile("v", [0.05, 0.95])).first()[0]
    w1 = d.agg(F.avg(F.greatest(F.lit(lo), F.least(F.lit(hi), "v")))).first()[0]
    assert abs(w1 - A.winsorized_mean(df, "v", 0.05).first()[0]) < 1e-9
    m = {r.g: r.v for r in A.series_by(df, "g", "v", "median").collect()}
    assert m[None] == 1.5 and abs(m["hot"] - a["hot"][3]) < 1e-9


def test_describe_keeps_a_column_without_values(spark):
    df = spark.range(10).select(F.col("id").cast("double").alias("a"), F.lit(None).cast("double").alias("b"))
    r = {x.column: x for x in A.describe_numeric(df, ["a", "b"]).collect()}
    assert r["a"].p50 == 4.5 and r["b"]["count"] == 0 and r["b"].p50 is None


def test_global_rank_matches_window_rank(spark):
    df = spark.range(500).select((F.col("id") % 37).cast("double").alias("v"), "id").union(
        spark.createDataFrame([(None, 999)], "v double, id long")).repartition(5)
    from pyspark.sql import Window
    w = Window.partitionBy(F.col("v").isNull()).orderBy(F.desc("v"))
    a = {r.id: r.r for r in df.withColumn("r", F.when(F.col("v").isNotNull(), F.rank().over(w))).collect()}
    b = {r.id: r.rank_v for r in W.rank_columns(df, {"v": True}, total=None).collect()}
    assert a == b and a[999] is None


def test_calendar_lags_dense_path_matches_joins(spark):
    rows = [("a", D(2020, m, 1), float(m)) for m in (1, 2, 4, 5, 7, 8, 9)] + [("b", D(2020, m, 1), 10.0 + m) for m in (2, 3, 6)]
    df = spark.createDataFrame(rows, "entity string, period date, v double")
    many = W.add_lags(df, "entity", "period", ["v"], [1, 2, 3], mode="calendar")
    few = {k: {(r.entity, r.period): r[f"v_lag{k}"] for r in
               W.add_lags(df, "entity", "period", ["v"], [k], mode="calendar").collect()} for k in (1, 2, 3)}
    got = many.collect()
    assert len(got) == len(rows)
    for r in got:
        for k in (1, 2, 3):
            assert r[f"v_lag{k}"] == few[k][(r.entity, r.period)]


def test_calendar_lags_keep_rows_off_the_month_grid(spark):
    rows = [("a", D(2020, 1, 31), 1.0), ("a", D(2020, 2, 29), 2.0), ("a", D(2020, 3, 15), 3.0), ("a", D(2020, 4, 15), 4.0),
            (None, D(2020, 1, 1), 5.0), (None, D(2020, 2, 1), 6.0)]
    df = spark.createDataFrame(rows, "entity string, period date, v double")
    for lags in ([1], [1, 2, 3, 12, 24]):
        got = {(r.entity, r.period): r.v_lag1 for r in W.add_lags(df, "entity", "period", ["v"], lags, mode="calendar").collect()}
        assert got == {("a", D(2020, 1, 31)): None, ("a", D(2020, 2, 29)): 1.0, ("a", D(2020, 3, 15)): None,
                       ("a", D(2020, 4, 15)): 3.0, (None, D(2020, 1, 1)): None, (None, D(2020, 2, 1)): 5.0}


def test_calendar_lags_of_a_daily_panel(spark):
    """Every day of four months: the value of add_months(d, -k), whatever the
    month's length, with repeated and missing dates."""
    import datetime
    days = [D(2020, 1, 1) + datetime.timedelta(i) for i in range(121)]
    rows = [("a", d, float(i), str(i)) for i, d in enumerate(days)] + [("b", d, -float(i), None) for i, d in enumerate(days) if i % 3]
    rows += [("a", D(2020, 2, 3), 33.0, "33"), ("a", D(2020, 2, 4), None, "34"), ("a", None, 1.0, "x")]
    df = spark.createDataFrame(rows, "entity string, period date, v double, s string")
    got = W.add_lags(df, "entity", "period", ["v", "s"], [1, 2], mode="calendar")
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert got.count() == len(rows) and got.columns == ["entity", "period", "v", "s", "v_lag1", "s_lag1", "v_lag2", "s_lag2"]
    at = {}
    for e, d, v, s in rows:
        at.setdefault((e, d), []).append((v, s))

    def agreed(found):
        return found.pop() if len(found) == 1 else None

    ends = lambda d: (d + datetime.timedelta(1)).day == 1
    for r in got.collect():
        for k in (1, 2):
            want = [None, None]
            if r.period is not None:
                back = (pd.Timestamp(r.period) - pd.DateOffset(months=k)).date()
                last = (pd.Timestamp(back) + pd.offsets.MonthEnd(0)).date()
                src = at.get((r.entity, back)) or (at.get((r.entity, last)) if ends(r.period) else None) or []
                want = [agreed({x[i] for x in src if x[i] is not None}) for i in (0, 1)]
            assert [r[f"v_lag{k}"], r[f"s_lag{k}"]] == want, (r, k)


def test_quantiles_by_bracketing(spark, monkeypatch):
    """One group holds most rows, one value a third of them; small groups,
    missing keys and values besides."""
    monkeypatch.setattr(A, "DIRECT_ROWS", 500)
    df = spark.range(60000).select(F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 97)).alias("g"),
                                   F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.round(F.sin(F.col("id")) * 1000, 3)).alias("v"))
    df = df.union(spark.createDataFrame([("hot", None), (None, 1.0), (None, 2.0), ("hot", float("nan"))], "g string, v double")).repartition(6)
    probs = [0.0, 0.001, 0.05, 0.25, 0.5, 0.77, 0.999, 1.0]
    d = df.where("v is not null and not isnan(v)")
    want = {r.g: r.q for r in d.groupBy("g").agg(F.percentile("v", probs).alias("q")).collect()}
    got = {(r.g, r.p): r.q for r in A.quantile_table(df, "v", probs, ["g"]).collect()}
    assert {(g, p) for g in want for p in probs} == set(got)
    assert all(abs(want[g][probs.index(p)] - q) < 1e-9 for (g, p), q in got.items())
    every = d.agg(F.percentile("v", probs)).first()[0]
    assert all(abs(every[probs.index(r.p)] - r.q) < 1e-9 for r in A.quantile_table(df, "v", probs).collect())
    assert A.quantile_table(df.limit(0), "v", probs, ["g"]).collect() == []


def test_ranks_of_many_columns_at_once(spark):
    import datetime
    from decimal import Decimal
    kinds = "id long, a double, b long, c string, d date, e decimal(10,2), f boolean, g timestamp"
    rows = [(i, None if i % 7 == 0 else float(i % 5), i % 4, "xyz"[i % 3], D(2020, 1, 1 + i % 6), Decimal(i % 8) / 4, i % 2 == 0,
             datetime.datetime(2020, 1, 1, i % 9)) for i in range(60)] + [(99, float("nan"), None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, kinds).repartition(5)
    specs = {"a": True, "b": False, "c": True, "d": False, "e": True, "f": False, "g": True}
    from pyspark.sql import Window
    want = df
    for c, desc in specs.items():
        w = Window.partitionBy(F.col(c).isNull()).orderBy(F.desc(c) if desc else F.asc(c))
        want = want.withColumn(f"rank_{c}", F.when(F.col(c).isNotNull(), F.rank().over(w)).cast("bigint"))
    key = lambda r: r.id
    got = W.rank_columns(df, specs, total=None)
    assert got.columns == want.columns
    assert [[r[f"rank_{c}"] for c in specs] for r in sorted(got.collect(), key=key)] == [[r[f"rank_{c}"] for c in specs] for r in sorted(want.collect(), key=key)]


def test_overview_counts_duplicates_by_fingerprint(spark):
    rows = [(1, None, 2, [None, 1], "p"), (1, 2, None, [None, 1], "p"), (1, None, 2, [1, None], "p"), (1, None, 2, [None, 1], "p"), (1, None, 2, None, "p")]
    df = spark.createDataFrame(rows, "a long, b long, c long, d array<long>, period string")
    r = A.overview(df, "period").first()
    assert (r["rows"], r["cols"], r["duplicate_rows"]) == (5, 5, 1)


def test_collapse_first_needs_an_order(spark):
    df = spark.createDataFrame([("p", 3, None), ("p", 2, 5.0), ("p", 1, None), ("p", 2, 4.0), ("q", 1, None)], "period string, o long, v double")
    with pytest.raises(ValueError):
        A.collapse(df, "period", ["v"], "first")
    assert {r.period: r.v for r in A.collapse(df, "period", ["v"], "first", order="o").collect()} == {"p": 4.0, "q": None}
    assert {r.period: r.v for r in A.collapse(df, "period", ["v"], "median").collect()} == {"p": 4.5, "q": None}


def test_too_few_months_for_the_folds(spark):
    df = spark.createDataFrame([(D(2020, m, 1),) for m in range(1, 8)], "period date")
    with pytest.raises(Exception, match="too few"):
        W.month_folds(df, "period", n_splits=3, min_train=5, val=4).collect()


def test_folds_need_no_join_over_rows(spark):
    df = spark.range(50).select(F.col("id"), F.add_months(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("period"))
    for out in (W.row_folds(df, ["id"], 5), W.month_folds(df, "period", 3, 20, 5)):
        assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()


def test_repeat_for_each_has_no_size_limit(spark):
    from chronopanel.operators.joins import repeat_for_each
    a, b = spark.range(7).withColumnRenamed("id", "a"), spark.range(3000).withColumnRenamed("id", "b")
    for small in (b, b.repartition(5)):
        out = repeat_for_each(a, small)
        assert out.count() == 21000 and out.distinct().count() == 21000 and out.columns == ["a", "b"]


def test_best_order_of_simulated_seasonal_series():
    import numpy as np
    from chronopanel.operators import forecast as FC
    g, wins = np.random.default_rng(3), 0
    for _ in range(10):
        y = np.zeros(109)
        e = g.standard_normal(109)
        for t in range(13, 109):
            y[t] = e[t] + y[t - 1] + y[t - 12] - y[t - 13]
        fits = [(FC.css_fit(y, *o, FC.max_lag_of(FC.DEFAULT_ORDERS)), o) for o in FC.DEFAULT_ORDERS]
        assert len({f["nobs"] for f, _ in fits}) == 1
        wins += min(fits, key=lambda x: x[0]["bic"])[1] == ((0, 1, 0), (0, 1, 0, 12))
    assert wins >= 7


def _mentioned(texts, names):
    import re
    norm = lambda t: "".join(re.findall(r"[^\W_]", t.strip().lower()))
    out = {}
    for t in texts:
        if t is None:
            out[t] = []
            continue
        exact = [n for n in names if n and n.lower() in t.lower()]
        out[t] = exact or [n for n in names if n and norm(n) and norm(n) in norm(t.lower())]
    return out


def test_names_in_texts_against_all_pairs(spark, monkeypatch):
    import random
    from chronopanel.operators import mentions as T
    monkeypatch.setattr(T, "BLOCK", 64)      # windows over block borders
    g = random.Random(2)
    names = ["UK", "a", "Auckland City", "North Shore City", "Île-de-France", "ÎLE", "Kāpiti Coast", "Côte d'Ivoire", "U.S.", "--", "", None, "東京", "Ab",
             "North", "north shore", "x" * 300]
    words = ["uk", "north", "shore", "city", "auckland", "NORTH SHORE", "île", "de", "france", "Kāpiti", "coast", "u s", "côte d ivoire", "-", "--", "東", "京", "b", "zz", "."]
    texts = [" ".join(g.choices(words, k=g.randint(0, 30))) for _ in range(300)] + [None, "", "x" * 400, "x" * 299, "y" * 5000 + "Auckland City", "au"]
    texts += ["north shore city"] * 200      # many equal texts
    df = spark.createDataFrame([(i, t, i, "s") for i, t in enumerate(texts)], "id long, text string, entities2 long, key string").repartition(6)
    dim = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, pos long")
    want = _mentioned(texts, names)
    got = T.with_mentions(df, "text", dim, "name", "pos")
    assert got.columns == ["id", "text", "entities2", "key", "entities"]
    rows = got.collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r["entities"] == want[r["text"]], r
    assert {tuple(r["entities"]) for r in T.with_mentions(df, "text", dim.limit(0), "name", "pos").collect()} == {()}


def test_many_names(spark):
    """A hundred thousand names; what a task holds is the bit table."""
    from chronopanel.operators import mentions as T
    dim = spark.range(100000).select(F.concat(F.lit("Place "), F.conv(F.col("id") * 7919 + 100000, 10, 36)).alias("name"), "id")
    rows = dim.where("id % 25000 = 3").orderBy("id").collect()
    df = spark.createDataFrame([(i, f"we went to {r['name']}, then home") for i, r in enumerate(rows)] + [(99, "no such place at all")], "i long, text string")
    got = {r["i"]: r["entities"] for r in T.with_mentions(df, "text", dim, "name", "id").collect()}
    assert all(rows[i]["name"] in got[i] for i in range(len(rows))) and got[99] == []
