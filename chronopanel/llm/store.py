"""Tables and files in the shared folder (``spark.checkpoint.dir``)."""

from __future__ import annotations

import contextlib
import ctypes
import sys
import types
import uuid

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronopanel.session import checkpoint_dir


_OPEN: list[list[str]] = []   # folders made in each open ``helper_tables``


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new, not yet existing folder below the shared one."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    for made in _OPEN:
        made.append(path)
    return path


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Cut the lineage of ``df`` with a table in the shared folder. A lost
    executor loses none of it, and the plan above starts from exact sizes."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_parts(df: DataFrame, column: str, values: list[str], name: str, codec: str = "zstd") -> tuple[str, dict[str, DataFrame]]:
    """As ``written``, but one table for each value of a text column, so that
    each can be removed by itself. Also gives the folder of all; every value
    must occur."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.option("compression", codec).partitionBy(column).parquet(path)
    rest = df.drop(column).schema
    return path, {v: spark.read.schema(rest).parquet(f"{path}/{column}={v}").withColumn(column, F.lit(v)) for v in values}


@contextlib.contextmanager
def helper_tables(spark: SparkSession, keep: str):
    """Removes the folders that were made below the shared one inside the
    block, at its end, other than those named ``keep-...``. What is computed
    from them must have been written by then."""
    made: list[str] = []
    _OPEN.append(made)
    try:
        yield
    finally:
        _OPEN.remove(made)
    for path in made:
        if not path.rsplit("/", 1)[1].startswith(keep + "-"):
            remove_folder(spark, path)


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession):
    """Queries inside the block remove their shuffle files when they end, not
    when the driver's garbage collector finds them: for steps that write what
    they computed."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, was)


def remove_folder(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def remove_table(df: DataFrame) -> None:
    """Remove the folder of a table that ``written`` gave. Nothing that still
    reads it may be left."""
    files = df.inputFiles()
    if files:
        remove_folder(df.sparkSession, files[0].rsplit("/", 1)[0])


def sized(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """Hint a broadcast for a narrow table that was counted to have at most
    ``rows`` rows. A larger one is joined by a shuffle."""
    return F.broadcast(df) if df.count() <= rows else df


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and inner path of a folder URI or a plain path."""
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def commit_file(folder: str, name: str, write) -> str:
    """Write ``folder/name`` under a temporary name and rename it when it is
    complete: a task that is repeated or lost leaves no half-written file.
    ``write`` gets the open stream."""
    fs, base = filesystem(folder)
    fs.create_dir(base, recursive=True)
    tmp = f"{base}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(tmp) as out:
        write(out)
    fs.move(tmp, f"{base}/{name}")
    return f"{folder.rstrip('/')}/{name}"


def tidy(run):
    """``run`` over the batches of a task; at its end the Python worker, which
    lives on, gives memory that it no longer uses back to the system."""
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
            if trim:
                trim(0)

    return wrapped


def worker_cache(name: str, make):
    """A value that stays in a Python worker from task to task. Functions are
    shipped by value, so module globals would start anew with each task."""
    home = sys.modules.setdefault("_chronopanel_worker", types.ModuleType("_chronopanel_worker"))
    if not hasattr(home, name):
        setattr(home, name, make())
    return getattr(home, name)
