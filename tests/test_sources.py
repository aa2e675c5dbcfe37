"""Sources, sinks and schema guards."""

import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from chronopanel.operators.columns import column_catalog, max_lag, order_lags, select_families
from chronopanel.sources import (clean_header, detect_column, expect_columns, latest_snapshot, read_summary,
                                 read_table, schema_diff, write_csv, write_parquet, write_summary)

from .conftest import SMALL


def _tmp():
    return tempfile.mkdtemp(prefix="chronopanel-io-")


def test_read_dispatch_and_errors(spark):
    df = read_table(spark, f"{SMALL}/nation.parquet")
    assert df.count() == 25
    with pytest.raises(ValueError):
        read_table(spark, "/no/such/file.xlsx")


def test_csv_roundtrip_month_key(spark):
    d = _tmp()
    df = spark.createDataFrame([("2020-01-15", "a", 1.5)], "d string, e string, v double") \
        .withColumn("d", F.to_date("d"))
    write_csv(df, os.path.join(d, "out"), month_col="d")
    back = read_table(spark, os.path.join(d, "out"), schema="d string, e string, v double", fmt="csv")
    assert back.first().d == "2020-01"


def test_parquet_partitioned_and_pruned(spark):
    d = _tmp()
    df = spark.createDataFrame([("base", 1.0), ("low", 2.0)], "scenario string, v double")
    write_parquet(df, os.path.join(d, "p"), partition_by=["scenario"])
    back = spark.read.parquet(os.path.join(d, "p")).filter("scenario = 'low'")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(scenario" in plan and back.first().v == 2.0


def test_summary_json_roundtrip(spark):
    d = _tmp()
    df = spark.createDataFrame([("2018-08 to 2025-09", [("a", 1.0), ("b", 2.0)])],
                               "time_span string, top array<struct<entity:string, value:double>>")
    write_summary(df, os.path.join(d, "s"))
    back = read_summary(spark, os.path.join(d, "s"))
    assert back.first().top[1].entity == "b"


def test_latest_snapshot(spark):
    d = _tmp()
    for name in ("old.csv", "new.csv", "pref.csv"):
        with open(os.path.join(d, name), "w") as f:
            f.write("a\n1\n")
        time.sleep(0.05)
    os.utime(os.path.join(d, "pref.csv"), (1, 1))
    for name, at in (("old_forecast.csv", 50), ("scenario_b.csv", 60)):
        with open(os.path.join(d, name), "w") as f:
            f.write("a\n1\n")
        os.utime(os.path.join(d, name), (at, at))

    def latest(**how):
        rows = [x.file for x in latest_snapshot(spark, d, **how).collect() if x.is_latest]
        assert len(rows) == 1
        return rows[0]

    assert latest(prefer=["pref", "old"]) == "old.csv"      # the newest of the preferred ones
    assert latest(prefer=["pref", "absent"]) == "pref.csv"
    assert latest() == "scenario_b.csv"                      # the newest whose name marks a forecast
    assert latest(words=()) == "new.csv"                     # the newest


def test_schema_guards(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(1, 3)], "x int, z int")
    with pytest.raises(KeyError):
        expect_columns(a, ["x", "w"])
    d = {(r.column, r.kind) for r in schema_diff(a, b).collect()}
    assert d == {("y", "missing"), ("z", "extra")}
    c = spark.createDataFrame([(1,)], "`Median Price` int")
    assert detect_column(c, ["median_price", "price"]) == "Median Price"
    assert detect_column(c, ["nothing"], required=False) is None
    h = spark.createDataFrame([(1, 2)], "`_c0` int, ` v ` int")
    assert clean_header(h, first_col="feature").columns == ["feature", "v"]


def test_column_roles_and_lag_names(spark):
    df = spark.createDataFrame([(1, "a", 1.0, 1.0, 2.0, 3.0, 1)],
                               "period int, entity string, y double, x_lag2 double, x double, x_lag1 double, is_a int")
    roles = {r.column: r.role for r in column_catalog(df, "y").collect()}
    assert roles == {"period": "id", "entity": "id", "y": "target", "x_lag2": "lagged", "x": "base",
                     "x_lag1": "lagged", "is_a": "dummy"}
    assert order_lags(df).columns == ["period", "entity", "y", "x", "x_lag1", "x_lag2", "is_a"]
    assert select_families(df.columns, {"x"}, lag_only=True) == ["x_lag2", "x_lag1"]
    assert max_lag(df.columns) == 2


def test_model_save_load(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    from chronopanel.sources import load_model, save_model
    df = spark.createDataFrame([(float(i), 2.0 * i) for i in range(10)], "x double, y double")
    m = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"),
                         LinearRegression(labelCol="y")]).fit(df)
    d = _tmp()
    save_model(m, os.path.join(d, "m"), features=["x"])
    back = load_model(os.path.join(d, "m"))
    assert abs(back.transform(df).first().prediction - 0.0) < 1e-6
    assert spark.read.parquet(os.path.join(d, "m_features")).first().feature == "x"
