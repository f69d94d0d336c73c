"""Rain series as streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rain_windows(stream: DataFrame, width: str = "1 hour", late: str = "2 hours", slide: str | None = None) -> DataFrame:
    """start, face, total, peak, n of rain (t, face, v) by event time; rows later than ``late`` are dropped by the stream.

    The same plan serves a batch, where nothing is late.
    """
    at: Column = F.window("t", width, slide) if slide else F.window("t", width)
    rain = stream.withWatermark("t", late) if stream.isStreaming else stream
    return rain.groupBy(at.alias("w"), "face").agg(F.sum("v").alias("total"), F.max("v").alias("peak"), F.count("*").alias("n")).select(F.col("w.start").alias("start"), "face", "total", "peak", "n")


def rain_stream(spark, path: str) -> DataFrame:
    """Rain of Parquet files as they arrive: t, face, v from ts, user_id, value."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).parquet(path).select(F.col("ts").cast("timestamp").alias("t"), F.col("user_id").alias("face"), F.col("value").alias("v"))
