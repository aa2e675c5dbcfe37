"""Session helpers: building a session for local runs and tests, loading the
input tables and finding the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def build_session(master: str | None = None, app: str = "chronopanel",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session for local runs. On a cluster the caller's session is used as is."""
    master = master or os.environ.get("CHRONOPANEL_MASTER", "local[*]")
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", os.environ.get("CHRONOPANEL_DRIVER_MEM", "16g")))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local-mode session (tests, single machine) without the setting gets
    a fresh scratch folder; a cluster session must name a shared folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        # naming the folder again would make one more empty folder in it
        if d.rstrip("/") not in (spark.sparkContext.getCheckpointDir() or ""):
            spark.sparkContext.setCheckpointDir(d)
        return d
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for the cluster")
    d = tempfile.mkdtemp(prefix="chronopanel-ckpt-")
    spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table of the data folder (``<sf_dir>/<name>.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {n: table(spark, sf_dir, n) for n in TABLES}
