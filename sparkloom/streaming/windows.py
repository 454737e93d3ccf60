"""Event-time windows, over finished tables and as streams with watermarks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def windowed(df: DataFrame, time: str, size: str, slide: str | None, aggs: list[Column], by: tuple[str, ...] = (), watermark: str | None = None) -> DataFrame:
    """(window_start, window_end, by..., aggregates) of tumbling or, with ``slide``, sliding windows."""
    d = df.withColumn("_t", F.col(time).cast("timestamp"))
    d = d.withWatermark("_t", watermark) if watermark else d
    w = F.window("_t", size, slide) if slide else F.window("_t", size)
    out = d.groupBy(w.alias("w"), *by).agg(*aggs)
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *[c for c in out.columns if c != "w"])


def sessions(df: DataFrame, time: str, gap: str, aggs: list[Column], by: tuple[str, ...], watermark: str | None = None) -> DataFrame:
    """Windows that end when a key has no row for ``gap``."""
    d = df.withColumn("_t", F.col(time).cast("timestamp"))
    d = d.withWatermark("_t", watermark) if watermark else d
    out = d.groupBy(F.session_window("_t", gap).alias("w"), *by).agg(*aggs)
    return out.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *[c for c in out.columns if c != "w"])


def read(spark, folder: str, schema: StructType, kind: str = "parquet", files: int = 1, pattern: str | None = None) -> DataFrame:  # noqa: ANN001
    """Files of a folder as a stream, so many for each batch."""
    r = spark.readStream.schema(schema).format(kind).option("maxFilesPerTrigger", files)
    return (r.option("pathGlobFilter", pattern) if pattern else r).load(folder)


def run(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Writes all that is there now to Parquet, exactly once by the checkpoint, and returns what was written."""
    q = stream.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def distinct(stream: DataFrame, keys: list[str], time: str, watermark: str) -> DataFrame:
    """First row of each key, with state for keys within the watermark only."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, watermark).dropDuplicatesWithinWatermark(keys)
