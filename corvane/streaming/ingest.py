"""Incremental forms of the batch operators (an extension): files of predictions or sources that keep arriving."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_tables(spark: SparkSession, path: str, schema, files_per_trigger: int = 64) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def first_of_content(sources: DataFrame, time: str, within: str = "1 hour") -> DataFrame:
    """Sources whose content hash has not been seen within the watermark."""
    return sources.withWatermark(time, within).dropDuplicatesWithinWatermark(["content_hash"])


def alarms(detections: DataFrame, time: str, confidence: float = 0.25, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Detections at or above a confidence per group and window of time."""
    d = detections.withWatermark(time, late).filter(F.col("score") >= confidence)
    return d.groupBy(F.window(time, width).alias("w"), "grp").agg(F.count(F.lit(1)).alias("n")).select("w.start", "w.end", "grp", "n")
