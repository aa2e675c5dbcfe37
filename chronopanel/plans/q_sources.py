"""Registered source, sink and schema queries (S02, S03, S05, S06, S08-S10,
P18). Each writes or reads whole given tables; files go to a new folder of the
shared one and are read back from it."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import columns as C
from ..session import checkpoint_dir
from ..sources import files as S
from ..sources import schema as H
from . import panels as P
from .registry import register

_MONEY = "round(o_totalprice * 100) / 100"


def _folder(t, name: str) -> str:
    return f"{checkpoint_dir(t.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _orders(t):
    return t("orders").select("o_orderkey", F.to_date("o_orderdate").alias("month"), "o_orderpriority",
                              (F.round(F.col("o_totalprice") * 100) / 100).alias("price"))


@register("csv_round_trip", "S02", sql=f"""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority, {_MONEY} AS price FROM orders""")
def csv_round_trip(t):
    path = _folder(t, "orders") + ".csv"
    S.write_csv(_orders(t), path, month_col="month")
    return S.read_table(t.spark, path, schema="o_orderkey bigint, month string, o_orderpriority string, price double")


@register("parquet_round_trip", "S03", sql=f"""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS month, o_orderpriority, {_MONEY} AS price FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def parquet_round_trip(t):
    """Partitioned by priority; the filter reads two of the folders."""
    path = _folder(t, "orders") + ".parquet"
    S.write_parquet(_orders(t), path, partition_by=["o_orderpriority"])
    back = S.read_table(t.spark, path).filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    return back.select("o_orderkey", "month", "o_orderpriority", "price")


@register("json_summary", "S05", sql="""
SELECT o_orderpriority AS priority, count(*) AS orders, count(DISTINCT o_custkey) AS customers, strftime(min(o_orderdate), '%Y-%m') AS first_month
FROM orders GROUP BY 1""")
def json_summary(t):
    path = _folder(t, "summary") + ".json"
    g = t("orders").groupBy(F.col("o_orderpriority").alias("priority")).agg(F.struct(
        F.count("*").alias("orders"), F.count_distinct("o_custkey").alias("customers"),
        F.date_format(F.min("o_orderdate"), "yyyy-MM").alias("first_month")).alias("s"))
    S.write_summary(g, path)
    back = S.read_summary(t.spark, path, schema="priority string, s struct<orders: bigint, customers: bigint, first_month: string>")
    return back.select("priority", "s.*")


@register("latest_snapshot", "S06", sql=f"""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority, {_MONEY} AS price FROM orders
WHERE o_orderpriority = '5-LOW'""")
def latest_snapshot(t):
    """Two versions of the orders in one folder: the one whose name marks a
    forecast is read, although the other one is newer."""
    folder, x = _folder(t, "snapshots"), _orders(t)
    low = x.filter(F.col("o_orderpriority") == "5-LOW")
    for stem, rows in (("orders_forecast", low), ("orders_raw", x)):
        S.write_parquet(rows.withColumn("month", F.date_format("month", "yyyy-MM")), f"{folder}/{stem}.parquet")
    found = S.latest_snapshot(t.spark, folder + "/*", pattern="part-*", of_folder=True).filter("is_latest").first()
    return S.read_table(t.spark, found["path"].rsplit("/", 1)[0], fmt="parquet")


@register("schema_diff", "S08", sql="""
WITH a AS (SELECT column_name AS c FROM (DESCRIBE orders)), b AS (SELECT replace(column_name, 'l_', 'o_') AS c FROM (DESCRIBE lineitem))
SELECT c AS "column", 'missing' AS kind, (SELECT count(*) FROM orders) AS n_orders FROM a WHERE c NOT IN (SELECT c FROM b)
UNION ALL SELECT c, 'extra', (SELECT count(*) FROM orders) FROM b WHERE c NOT IN (SELECT c FROM a)""")
def schema_diff(t):
    lines = t("lineitem")
    lines = lines.toDF(*[c.replace("l_", "o_") for c in lines.columns])
    return H.schema_diff(t("orders"), lines).withColumn("n_orders", t("orders").select(F.count("*")).scalar())


@register("header_guard", "S07 S09 S10", sql="""
SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY 1""")
def header_guard(t):
    """Orders under untidy headers: cleaned, then the date and customer
    columns found by their candidates' names."""
    raw = t("orders").withColumnsRenamed({"o_orderkey": "﻿o_orderkey", "o_orderdate": " O_Order Date ", "o_custkey": "o_CustKey "})
    x = H.clean_header(raw)
    when, who = H.detect_column(x, ["month", "o_orderdate"]), H.detect_column(x, ["customer", "o_custkey"])
    x = H.expect_columns(x, [when, who, "o_orderkey"], "orders")
    return x.groupBy(F.date_format(F.col(f"`{when}`"), "yyyy-MM").alias("month")).agg(
        F.count("o_orderkey").alias("n"), F.count_distinct(F.col(f"`{who}`")).alias("customers"))


@register("column_catalog", "P18", materialize=["nation_month"], ctes=["nation_lags"], sql="""
d AS (SELECT CAST(row_number() OVER () - 1 AS BIGINT) AS position, column_name AS "column" FROM (DESCRIBE SELECT period, entity, region, avg_price, sales_count,
      avg_price_lag1, avg_price_lag12 FROM nation_lags))
SELECT position, "column", CASE WHEN "column" = 'sales_count' THEN 'target' WHEN "column" IN ('period', 'entity') THEN 'id'
  WHEN "column" LIKE '%_lag%' THEN 'lagged' WHEN "column" = 'avg_price' THEN 'base' ELSE 'other' END AS role,
  (SELECT count(*) FROM nation_lags) AS n_rows FROM d""")
def column_catalog(t):
    x = P.nation_lags(t).select("period", "entity", "region", "avg_price", "sales_count", "avg_price_lag1", "avg_price_lag12")
    return C.column_catalog(x, "sales_count").select("position", "column", "role").withColumn("n_rows", x.select(F.count("*")).scalar())
