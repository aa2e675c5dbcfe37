"""Plan-shape tests: the physical plans we rely on at scale."""

from pyspark.sql import functions as F

from chronopanel.plans.registry import load_all, runner

from .conftest import SMALL


def _plan(spark, name):
    df = runner(load_all()[name])(spark, SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


def test_lags_share_one_exchange(spark):
    p = _plan(spark, "lag_features")
    # eight lag columns, one window spec: a single Window node over one hash exchange on the entity
    assert p.count("Window [") == 1


def test_no_single_partition_exchange_on_fact_windows(spark):
    for name in ("lag_features", "drawdown", "investment_metrics"):
        p = _plan(spark, name)
        body = p.split("Subquery")[0]
        assert "SinglePartition" not in body, name


def test_filters_and_pruning_reach_scan(spark):
    p = _plan(spark, "parse_ym")
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz,o_orderpriority:string>" in p


def test_panel_aggregates_before_dimension_joins(spark):
    from chronopanel.plans.panels import Tables, nation_month
    p = nation_month(Tables(spark, SMALL))._jdf.queryExecution().executedPlan().toString()
    # the orders scan reads only the four columns it needs
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz,o_orderpriority:string>" in p
    # the final aggregate by (month, nation key) sits below the joins with nation and region
    lines = p.split("\n")
    agg = max(i for i, l in enumerate(lines) if "HashAggregate(keys=[_groupingexpression" in l)
    nation_join = min(i for i, l in enumerate(lines) if "n_nationkey" in l and "Join" in l)
    assert nation_join < agg       # printed above = executed later


def test_hot_group_quantiles_use_many_partitions(spark):
    from pyspark.sql import functions as F
    from chronopanel.operators import aggs as A
    df = spark.range(20000).select(F.lit("hot").alias("g"), F.rand(1).alias("v")).repartition(8)
    p = A.exact_quantiles(df, "v", [0.5], ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in p or "percentile" not in p   # no per-group value map
    r = A.exact_quantiles(df, "v", [0.5], ["g"]).first()
    e = df.agg(F.percentile("v", 0.5)).first()[0]
    assert abs(r.q - e) < 1e-12


def test_union_splits_keeps_every_month(spark, tmp_path):
    """Orders of other years: as many rows as before they were moved."""
    q = load_all()["union_splits"]
    rows = sorted((r["period"].month, r["entity"], r["avg_price"]) for r in runner(q)(spark, SMALL).collect())
    for years in (-10, 10):
        for name in ("customer", "nation", "region", "orders"):
            df = spark.read.parquet(f"{SMALL}/{name}.parquet")
            if name == "orders":
                df = df.withColumn("o_orderdate", F.col("o_orderdate") + F.expr(f"INTERVAL '{years}' YEAR"))
            df.write.parquet(f"{tmp_path}/{years}/{name}.parquet")
        moved = runner(q)(spark, f"{tmp_path}/{years}").collect()
        assert rows and sorted((r["period"].month, r["entity"], r["avg_price"]) for r in moved) == rows
