"""File sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

__all__ = ["read_table", "write_csv", "write_parquet", "write_summary", "read_summary",
           "latest_snapshot", "save_model", "load_model", "load_features"]

BOM = "﻿"


def read_table(spark: SparkSession, path: str, schema=None, fmt: str | None = None) -> DataFrame:
    """Dispatch on the suffix (csv / parquet / json); other suffixes
    raise. CSV headers lose a UTF-8 byte-order mark and surrounding blanks."""
    kind = fmt or path.rstrip("/").rsplit(".", 1)[-1].lower()
    if kind == "parquet":
        df = spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)
    elif kind == "csv":
        r = spark.read.option("header", True).option("encoding", "UTF-8")
        r = r.schema(schema) if schema else r.option("inferSchema", True)
        df = r.csv(path)
    elif kind == "json":
        df = spark.read.schema(schema).json(path) if schema else spark.read.json(path)
    else:
        raise ValueError(f"unsupported file type: {path}")
    names = [c.replace(BOM, "").strip() for c in df.columns]
    return df.toDF(*names) if names != df.columns else df


def write_csv(df: DataFrame, path: str, month_col: str | None = None, mode: str = "overwrite") -> None:
    """CSV with header; the month column written as ``YYYY-MM``."""
    if month_col:
        df = df.withColumn(month_col, F.date_format(month_col, "yyyy-MM"))
    df.write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by=(), mode: str = "overwrite") -> None:
    """Parquet, optionally partitioned (e.g. by scenario for pruning)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_summary(df: DataFrame, path: str) -> None:
    """JSON documents (nested structs and arrays kept)."""
    df.write.mode("overwrite").json(path)


def read_summary(spark: SparkSession, path: str, schema=None, multi_line: bool = False) -> DataFrame:
    """JSON documents, one a line as ``write_summary`` writes them, or
    with ``multi_line`` one document a file."""
    r = spark.read.option("multiLine", multi_line)
    return (r.schema(schema) if schema else r).json(path)


# Words of a file name that mark a forecast file.
SNAPSHOT_WORDS = ("scenario", "merged", "forecast", "pred")


def latest_snapshot(spark: SparkSession, folder: str, prefer=(), pattern: str = "*.{parquet,csv,xlsx,xls}",
                    words=SNAPSHOT_WORDS, of_folder: bool = False) -> DataFrame:
    """The files of a folder with their ``preference`` and ``is_latest``
    for the one to load: the newest of the files with a preferred stem; else
    the newest whose name holds one of ``words``; else the newest. With
    ``of_folder`` the name is that of the folder around a file, so a table of
    several files counts as one. Reads only file metadata (``binaryFile``
    source, content column pruned)."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
             .load(folder).select("path", "modificationTime", "length"))
    name = F.element_at(F.split("path", "/"), -2 if of_folder else -1)
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    known = stem.isin(list(prefer)) if prefer else F.lit(False)
    marked = F.lower(stem).rlike("|".join(words)) if words else F.lit(False)
    rows = files.select(name.alias("file"), "path", "modificationTime", "length",
                        F.when(known, 1).when(marked, 2).otherwise(3).alias("preference"))
    first = rows.agg(F.min(F.struct("preference", -F.unix_micros("modificationTime"), "file")).alias("m")).select("m.file").scalar()
    return rows.withColumn("is_latest", F.col("file") == first)


def save_model(model, path: str, features=None) -> None:
    """Spark ML model plus its feature list (a one-column Parquet)."""
    model.write().overwrite().save(path)
    if features is not None:
        from pyspark.sql import SparkSession as _S
        s = _S.getActiveSession()
        s.createDataFrame([(i, f) for i, f in enumerate(features)], "position int, feature string") \
            .coalesce(1).write.mode("overwrite").parquet(path.rstrip("/") + "_features")


def load_features(spark: SparkSession, path: str) -> list[str]:
    """The feature list that ``save_model`` wrote next to the model."""
    return [r["feature"] for r in spark.read.parquet(path.rstrip("/") + "_features").orderBy("position").collect()]


def load_model(path: str, cls=None):
    from pyspark.ml import PipelineModel
    cls = cls or PipelineModel
    return cls.load(path)
