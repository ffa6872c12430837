"""Position fixes as a stream: trips by silence, late fixes bounded by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def fixes(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Parquet files as they come into a folder."""
    return spark.readStream.schema(schema).parquet(folder)


def sessions(rows: DataFrame, key: str, time: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """``key, started, ended, fixes`` of trips, which end after a silence of ``gap``.

    Works on streams and tables alike. On a stream the state holds a row a trip that is still open, and
    rows later than ``late`` are dropped by the watermark.
    """
    held = rows.withWatermark(time, late) if rows.isStreaming else rows
    found = held.groupBy(F.session_window(time, gap).alias("w"), key).agg(F.min(time).alias("started"), F.max(time).alias("ended"), F.count("*").alias("fixes"))
    return found.select(key, "started", "ended", "fixes")


def rates(rows: DataFrame, key: str, time: str, window: str = "10 minutes", slide: str = "5 minutes", late: str = "1 hour") -> DataFrame:
    """Fixes of each key in sliding windows."""
    held = rows.withWatermark(time, late) if rows.isStreaming else rows
    found = held.groupBy(F.window(time, window, slide).alias("w"), key).agg(F.count("*").alias("fixes"))
    return found.select(key, F.col("w.start").alias("started"), "fixes")


def once(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Take what has come since the last run, append it to a Parquet table, and stop."""
    return rows.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
