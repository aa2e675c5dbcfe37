"""Event panel maintained incrementally from a folder of Parquet files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators._util import as_list


def panel_stream(spark: SparkSession, source: str, schema, ts: str, keys, measures: dict,
                 period: str = "1 day", watermark: str = "2 days", max_files: int = 100) -> DataFrame:
    """Streaming (period, keys..., measures...) aggregate of a file source.

    ``measures`` maps output names to aggregate Columns. Periods are
    tumbling event-time windows; a period is emitted (append mode) once the
    watermark passes its end, so late rows within ``watermark`` are still
    counted and the state of closed periods is dropped.
    """
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(source)
    # watermarks need TIMESTAMP; wall-clock (NTZ) times are read in the session zone
    s = s.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    g = s.groupBy(F.window(ts, period).alias("w"), *as_list(keys)).agg(
        *[c.alias(n) for n, c in measures.items()])
    return g.select(F.to_date(F.col("w.start")).alias("period"), *as_list(keys), *measures.keys())


def start_panel_stream(panel: DataFrame, sink: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Write the panel to Parquet (append; exactly once via the checkpoint in
    the shared folder). ``available_now`` processes what is there and stops."""
    w = panel.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint) \
        .outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
