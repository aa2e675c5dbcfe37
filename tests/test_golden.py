"""Golden tests: operators on committed input tables against committed
results (relative tolerance 1e-9)."""

import math
import os

import pandas as pd
from pyspark.sql import functions as F

from chronopanel.operators import aggs as A
from chronopanel.sources.files import read_table

from .conftest import FIXTURES


def _forecast(spark):
    df = read_table(spark, os.path.join(FIXTURES, "forecast_long.csv"))
    return df.select(F.to_date("Month").alias("period"), F.col("District").alias("entity"),
                     F.col("Scenario").alias("scenario"), F.col("pred_log_Median_Price").alias("pred_log"),
                     F.col("pred_Median_Price").alias("pred"))


def test_bom_header_stripped(spark):
    df = read_table(spark, os.path.join(FIXTURES, "forecast_long.csv"))
    assert df.columns[0] == "Month"


def test_investment_metrics_golden(spark):
    got = A.investment_metrics(_forecast(spark)).toPandas().set_index("entity")
    exp = pd.read_csv(os.path.join(FIXTURES, "investment_expected.csv")).set_index("district")
    assert set(got.index) == set(exp.index)
    for c in ["current_price_base", "forecast_price_base_h", "expected_return_base", "volatility_base",
              "downside_max_drawdown_low", "scenario_spread_high_minus_low", "stability_score"]:
        for d in exp.index:
            assert math.isclose(got.loc[d, c], exp.loc[d, c], rel_tol=1e-9, abs_tol=1e-12), (c, d)
    assert (got["anchor_month"] == "2025-07").all()


def test_scenario_fan_golden(spark):
    got = A.scenario_fan(_forecast(spark)).toPandas()
    exp = pd.read_csv(os.path.join(FIXTURES, "fan_expected.csv"), encoding="utf-8-sig")
    exp["Month"] = pd.to_datetime(exp["Month"]).dt.date
    m = got.merge(exp, left_on=["period", "entity"], right_on=["Month", "District"])
    assert len(m) == len(exp) == 84
    for s in ("base", "low", "high"):
        assert ((m[f"pred_{s}"] - m[f"pred_Median_Price_{s}"]).abs() <= 1e-9 * m[f"pred_{s}"].abs()).all()


def test_trailing_shares_golden(spark):
    df = read_table(spark, os.path.join(FIXTURES, "sales_panel.csv"))
    df = df.select(F.to_date("Month", "yyyy-MM").alias("period"), F.col("District").alias("entity"), "sales_count")
    df = df.filter(F.col("period") < F.lit("2025-07-01").cast("date"))
    got = {r.entity: r.share for r in A.trailing_shares(df, "period", "entity", "sales_count", 12).collect()}
    exp = pd.read_csv(os.path.join(FIXTURES, "shares_expected.csv")).set_index("District")["sales_share"]
    for d, v in exp.items():
        assert math.isclose(got[d], v, rel_tol=1e-9), d


def test_bvar_and_level_recovery_golden(spark):
    from chronopanel.operators import forecast as FC
    from chronopanel.operators import windows as W
    lv = read_table(spark, os.path.join(FIXTURES, "macro_levels.csv"),
                    schema="Month date, CPI double, CGPI double, OCR double, R2 double, U double")
    lv = lv.withColumn("g", F.lit("all"))
    x = W.log_return(lv, "g", "Month", "CPI", out="dCPI")
    x = W.log_return(x, "g", "Month", "CGPI", out="dCGPI")
    cols = ["dCPI", "dCGPI", "OCR", "R2", "U"]
    fc = FC.bvar_forecast(x, "g", "Month", cols, p=1, horizon=12, lambda1=0.18, lambda2=0.5, lambda3=1.0)
    got = fc.orderBy("step").toPandas()
    exp = pd.read_csv(os.path.join(FIXTURES, "bvar_expected.csv"))
    assert len(got) == 12
    for mine, theirs in zip(cols, ["dlog_CPI", "dlog_CGPI_Dwelling", "OCR", "2YearFixedRate", "unemployment_rate"]):
        assert ((got[mine] - exp[theirs]).abs() <= 1e-9 * exp[theirs].abs().clip(lower=1e-3)).all(), mine
    assert [str(d) for d in got["Month"]] == list(exp["Month"])
    # levels from the cumulated log differences, anchored at the last observed level
    last = lv.agg(F.max_by("CPI", "Month").alias("a")).first().a
    lev = W.levels_from_dlog(fc.withColumn("anchor", F.lit(last)), "g", "Month", "dCPI", "anchor", out="CPI")
    lp = lev.orderBy("step").toPandas()
    el = pd.read_csv(os.path.join(FIXTURES, "bvar_levels_expected.csv"))
    assert ((lp["CPI"] - el["CPI"]).abs() <= 1e-9 * el["CPI"].abs()).all()


def test_winsorized_scenarios_golden(spark):
    from chronopanel.operators import columns as C
    from chronopanel.operators import reshape as R
    m = read_table(spark, os.path.join(FIXTURES, "migration_monthly.csv"),
                   schema="Month string, District string, v double")
    m = m.select(F.to_date("Month", "yyyy-MM").alias("period"), "v")
    # the panel calendar: 2018-08 .. 2025-06 without the two months absent from the price panel
    m = C.period_filter(m, "period", "2018-08-01", "2025-06-01", exclude=["2018-11-01", "2020-07-01"])
    assert m.count() == 567
    base = A.winsorized_mean(m, "v", 0.10, out="value").first().value
    assert math.isclose(base, 174.22183421516755, rel_tol=1e-12)
    sc = R.make_scenarios(A.winsorized_mean(m, "v", 0.10, out="value"), {"Base": 1.0, "High": 1.1, "Low": 0.9},
                          12, value="value", start=F.lit("2025-07-01").cast("date"))
    got = {r.scenario: r.value for r in sc.filter("period = '2026-06-01'").collect()}
    assert math.isclose(got["High"], 174.22183421516755 * 1.1, rel_tol=1e-12) and sc.count() == 36


def test_benchmark_profile_golden(spark):
    import json
    from chronopanel.operators import columns as C
    from chronopanel.operators import joins as J
    reg = read_table(spark, os.path.join(FIXTURES, "region_price.csv"),
                     schema="Month string, Area string, Median_Price double")
    dis = read_table(spark, os.path.join(FIXTURES, "price_panel.csv"),
                     schema="Month string, District string, Median_Price double")
    reg = reg.select(F.to_date("Month", "yyyy-MM").alias("period"), F.col("Median_Price").alias("b"))
    dis = dis.select(F.to_date("Month", "yyyy-MM").alias("period"), F.col("District").alias("entity"),
                     F.col("Median_Price").alias("v"))
    reg = C.period_filter(reg, "period", "2018-08-01", "2025-06-01")
    dis = C.period_filter(dis, "period", "2018-08-01", "2025-06-01")
    reg, dis = J.align_periods(reg, dis)
    got = {r.entity: r for r in A.benchmark_profile(dis, reg, "period", "entity", "v", "b").collect()}
    exp = json.load(open(os.path.join(FIXTURES, "benchmark_summary.json")))["district_metrics"]
    assert len(exp) == 7 and set(got) == {e["district"] for e in exp}
    for e in exp:
        g = got[e["district"]]
        assert math.isclose(g.avg_ratio, e["avg_ratio_to_region"], rel_tol=1e-12)
        assert math.isclose(g.median_ratio, e["median_ratio_to_region"], rel_tol=1e-12)
        assert math.isclose(g.volatility, e["volatility_log_return_std"], rel_tol=1e-10)
        assert math.isclose(g.corr_log_return, e["corr_with_region_log_return"], rel_tol=1e-10)


def test_upsample_golden(spark):
    from chronopanel.operators import windows as W
    m = read_table(spark, os.path.join(FIXTURES, "unemployment_monthly.csv"),
                   schema="Month string, District string, u double")
    m = m.select(F.to_date("Month", "yyyy-MM").alias("period"), F.col("District").alias("entity"), "u")
    # quarterly observations sit on the third month of each quarter (the series starts 2016-03);
    # the monthly series is their linear interpolation
    q = m.filter(F.month("period").isin(3, 6, 9, 12))
    up = W.upsample_linear(q, "entity", "period", ["u"], digits=2)
    j = up.join(m.withColumnRenamed("u", "expected"), ["entity", "period"])
    assert j.count() == up.count() > 700
    bad = j.filter(F.abs(F.col("u") - F.col("expected")) > 1e-9).count()
    assert bad == 0


def test_yearly_repeat_and_trimmed_mean_golden(spark):
    from chronopanel.operators import columns as C
    from chronopanel.operators import reshape as R
    y = read_table(spark, os.path.join(FIXTURES, "rent_yearly.csv"), schema="Year int, District string, rent double")
    m = R.yearly_to_monthly(y, "Year", "rent", how="repeat")
    m = C.period_filter(m, "period", "2018-08-01", "2025-06-01", exclude=["2018-11-01", "2020-07-01"])
    assert m.count() == 567
    v = A.trimmed_mean(m, "rent", 0.10).first()[0]
    assert math.isclose(v, 580.6789587852495, rel_tol=1e-12)


def test_weighted_mean_golden(spark):
    df = read_table(spark, os.path.join(FIXTURES, "income_weighted.csv"))
    areas = [c[:-len("_income")] for c in df.columns if c.endswith("_income") and not c.endswith("weighted")]
    pairs = [(f"{a}_income", f"{a}_pop") for a in areas]
    assert len(pairs) == 6
    got = {r.Year: r.weighted_mean for r in A.weighted_mean(df, pairs, by=["Year"]).collect()}
    exp = {r.Year: r[df.columns[-1]] for r in df.collect()}
    assert len(exp) == 20
    for y, v in exp.items():
        if v is None or (isinstance(v, float) and math.isnan(v)):
            assert got[y] is None, y          # years without incomes stay missing
        else:
            assert math.isclose(got[y], v, rel_tol=1e-12), y


def test_row_lags_golden(spark):
    """Row lags over the panel calendar (two months absent) equal the
    committed lag columns, including lags that reach across the gaps."""
    from chronopanel.operators import columns as C
    from chronopanel.operators import windows as W
    s = read_table(spark, os.path.join(FIXTURES, "sales_panel.csv"), schema="Month string, District string, sales_count long")
    s = s.select(F.to_date("Month", "yyyy-MM").alias("period"), F.col("District").alias("entity"), "sales_count")
    s = C.trim_before(s, "period", "2025-07-01")
    lags = [1, 3, 6, 9, 12]
    got = W.add_lags(s, "entity", "period", ["sales_count"], lags)
    exp = read_table(spark, os.path.join(FIXTURES, "split_test.csv"))
    exp = exp.select(F.to_date("Month").alias("period"), F.col("District").alias("entity"),
                     *[F.col(f"sales_count_lag{k}").cast("double").alias(f"e{k}") for k in lags])
    j = exp.join(got, ["period", "entity"])
    assert j.count() == exp.count() == 126
    for k in lags:
        assert j.filter(~F.col(f"sales_count_lag{k}").cast("double").eqNullSafe(F.col(f"e{k}"))).count() == 0, k


def test_time_split_golden(spark):
    from chronopanel.operators import reshape as R
    s = read_table(spark, os.path.join(FIXTURES, "sales_panel.csv"), schema="Month string, District string, sales_count long")
    s = s.select(F.to_date("Month", "yyyy-MM").alias("period"), F.col("District").alias("entity"))
    sp = R.time_split(s, "period", {"train": ("2018-08-01", "2023-12-01"), "test": ("2024-01-01", "2025-06-01")})
    summ = {r.split: (r.rows, str(r.start), str(r.end)) for r in A.split_summary(sp, "split", "period").collect()}
    assert summ == {"train": (441, "2018-08-01", "2023-12-01"), "test": (126, "2024-01-01", "2025-06-01")}


def test_disaggregate_golden(spark):
    from chronopanel.operators import joins as J
    tot = read_table(spark, os.path.join(FIXTURES, "total_forecast.csv"),
                     schema="Month date, Consents_forecast double, sales_count_forecast double")
    sh = read_table(spark, os.path.join(FIXTURES, "shares_expected.csv"),
                    schema="District string, consents_share double, sales_share double")
    got = J.disaggregate(tot, sh.withColumnRenamed("District", "entity"),
                         ["Consents_forecast", "sales_count_forecast"], ["consents_share", "sales_share"])
    exp = pd.read_csv(os.path.join(FIXTURES, "forecast_by_entity_expected.csv"))
    g = got.toPandas()
    g["Month"] = g["Month"].astype(str)
    m = g.merge(exp, left_on=["Month", "entity"], right_on=["Month", "District"], suffixes=("", "_e"))
    assert len(m) == len(exp) == 84
    for c in ("Consents_forecast", "sales_count_forecast"):
        assert ((m[c] - m[c + "_e"]).abs() <= 1e-9 * m[c + "_e"].abs()).all(), c


def test_collapse_golden(spark):
    from chronopanel.operators import columns as C
    s = read_table(spark, os.path.join(FIXTURES, "sales_panel.csv"), schema="Month string, District string, sales_count long")
    s = C.trim_before(s.select(F.to_date("Month", "yyyy-MM").alias("period"), "District", "sales_count"),
                      "period", "2025-07-01")
    got = {str(r.period): r.sales_count for r in A.collapse(s, "period", ["sales_count"], "sum").collect()}
    exp = pd.read_csv(os.path.join(FIXTURES, "series_expected.csv"))
    assert len(got) == len(exp) == 81
    assert all(got[m] == v for m, v in zip(exp["Month"], exp["sales_count"]))


def _train(df):
    from chronopanel.operators import columns as C
    return C.period_filter(df, "period", "2018-08-01", "2023-12-01")


def _panel(spark, name, value, vtype="double"):
    d = read_table(spark, os.path.join(FIXTURES, name), schema=f"Month string, District string, {value} {vtype}")
    return d.select(F.to_date("Month", "yyyy-MM").alias("period"), F.col("District").alias("entity"), value)


def test_group_stats_golden(spark):
    prices = _train(_panel(spark, "price_panel.csv", "Median_Price"))
    got = {r.entity: r for r in A.group_stats(prices, "entity", "Median_Price").collect()}
    exp = pd.read_csv(os.path.join(FIXTURES, "group_stats_expected.csv"), encoding="utf-8-sig")
    assert len(exp) == len(got) == 7
    for _, e in exp.iterrows():
        g = got[e["District"]]
        assert g.n == e["n"]
        for c in ("mean", "median", "std", "min", "max", "q25", "q75", "iqr", "cv"):
            assert math.isclose(g[c], e[c], rel_tol=1e-12), (e["District"], c)


def test_skewness_golden(spark):
    from chronopanel.operators import reshape as R
    exp = pd.read_csv(os.path.join(FIXTURES, "skewness_expected.csv"), encoding="utf-8-sig", index_col=0)["skewness"]
    price = _train(_panel(spark, "price_panel.csv", "Median_Price"))
    sales = _train(_panel(spark, "sales_panel.csv", "sales_count", "long"))
    mig = _train(_panel(spark, "migration_monthly.csv", "Net_migration_monthly"))
    rent = R.yearly_to_monthly(read_table(spark, os.path.join(FIXTURES, "rent_yearly.csv"),
                                          schema="Year int, District string, weeklyrent double"), "Year", "weeklyrent",
                               digits=2)
    rent = _train(rent.select("period", F.col("District").alias("entity"), "weeklyrent"))
    # the training rows are the months of the price panel (two months absent)
    keys = price.select("period", "entity")
    for df, col in ((price, "Median_Price"), (sales, "sales_count"), (mig, "Net_migration_monthly"),
                    (rent, "weeklyrent")):
        d = df.join(keys, ["period", "entity"], "left_semi")
        assert d.count() == 441
        got = A.skewness_g1(d, [col]).first().skewness
        assert math.isclose(got, exp[col], rel_tol=1e-9), col


def test_yearly_apportion_golden(spark):
    from chronopanel.operators import reshape as R
    y = read_table(spark, os.path.join(FIXTURES, "migration_yearly.csv"), schema="Year int, District string, m double")
    got = R.yearly_to_monthly(y, "Year", "m", how="apportion", digits=2).select(
        "period", F.col("District").alias("entity"), "m")
    exp = _panel(spark, "migration_monthly.csv", "Net_migration_monthly")
    j = got.join(exp, ["period", "entity"])
    assert j.count() == exp.count() == 672
    assert j.filter(F.abs(F.col("m") - F.col("Net_migration_monthly")) > 1e-9).count() == 0


def test_leader_boards_and_ranks(spark):
    """Ranks and boards of the committed metrics by the stated rules, in pandas."""
    import pandas as pd
    from chronopanel.operators import reshape as R
    from chronopanel.plans import reports as Rp
    m = pd.read_csv(os.path.join(FIXTURES, "investment_expected.csv")).rename(columns={"district": "entity"})
    df = spark.createDataFrame(m)
    m["down"] = m.downside_max_drawdown_low.abs()
    rank = lambda c, up: m[c].rank(ascending=up, method="min").astype(int)
    want = pd.DataFrame({"rank_stability": rank("stability_score", False), "rank_return": rank("expected_return_base", False),
                         "rank_vol": rank("volatility_base", True), "rank_downside": rank("down", True),
                         "rank_spread": rank("scenario_spread_high_minus_low", True)})
    want["defensive_rank_sum"] = want.rank_vol + want.rank_downside + want.rank_spread
    got = {r["entity"]: r for r in Rp.investment_insight(df).collect()}
    for i, e in enumerate(m.entity):
        assert {c: got[e][c] for c in want} == want.loc[i].to_dict()
    m["sum"] = want.defensive_rank_sum
    boards = {"stable": m.sort_values(["stability_score", "expected_return_base"], ascending=False).entity[:3].tolist(),
              "return": m.sort_values(["expected_return_base", "stability_score"], ascending=False).entity[:3].tolist(),
              "defensive": m.sort_values(["sum", "stability_score"], ascending=[True, False]).entity[:3].tolist(),
              "risk": m.sort_values(["down", "scenario_spread_high_minus_low", "volatility_base"], ascending=False).entity[:1].tolist()}
    rows = R.leaders(df, 3).orderBy("board", "position").collect()
    assert {b: [r.entity for r in rows if r.board == b] for b in boards} == boards
    assert got[boards["stable"][0]].profile == "most stable"
