"""Alerts on streams: hot windows as they arrive, and when alerts fire and clear."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from millrace.operators.windows import ALERT_HOURS, HOT_CELSIUS, WINDOW
from millrace.sources.tables import path_exists

KEYS = ("device_id", "location", "window_start")


def hot_windows(readings: DataFrame, threshold: float = HOT_CELSIUS, window: str = WINDOW) -> DataFrame:
    """Maximum per device, location and window, of the windows that reach ``threshold``.

    A window reaches it only through a reading that does, so all others are left out
    before the aggregate.
    """
    hot = readings.where(F.col("temperature_celsius") >= threshold)
    grouped = hot.groupBy("device_id", "location", F.window("event_timestamp", window).alias("window"))
    maxima = grouped.agg(F.max("temperature_celsius").alias("max_temp"))
    return maxima.select("device_id", "location", F.col("window.start").alias("window_start"), "max_temp")


def start_hot_windows(
    readings: DataFrame, path: str, checkpoint: str, threshold: float = HOT_CELSIUS, window: str = WINDOW
) -> StreamingQuery:
    """Append the hot windows of every batch's own readings, without waiting.

    No state is kept: a window that is hot in several batches has a row in each, and
    ``read_hot_windows`` takes the greatest. A repeated batch replaces its own folder.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        hot_windows(batch, threshold, window).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = readings.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def read_hot_windows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Every hot window so far, once; ``schema`` is that of ``hot_windows``."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(path)
    return rows.groupBy(*KEYS).agg(F.max("max_temp").alias("max_temp"))


def alert_intervals(hot: DataFrame, hours: int = ALERT_HOURS) -> DataFrame:
    """When the alert of a device and location fired and when it cleared.

    A hot window keeps the alert up for ``hours`` after its start. Windows that start
    before the alert of the one before has cleared belong to the same interval.
    """
    per_device = "OVER (PARTITION BY device_id, location ORDER BY window_start)"
    length = f"INTERVAL {int(hours)} HOURS"
    apart = hot.withColumn("previous", F.expr(f"lag(window_start) {per_device}"))
    fires = f"coalesce(window_start > previous + {length}, true)"
    numbered = apart.withColumn("number", F.expr(f"count_if({fires}) {per_device}"))
    return numbered.groupBy("device_id", "location", "number").agg(
        F.min("window_start").alias("fired_at"),
        (F.max("window_start") + F.expr(length)).alias("cleared_at"),
        F.max("max_temp").alias("max_temp"),
        F.count(F.lit(1)).alias("hot_windows"),
    ).drop("number")


def alerts_at(intervals: DataFrame, as_of: str | datetime) -> DataFrame:
    """The alerts that are up at ``as_of``."""
    now = F.lit(as_of).cast(intervals.schema["fired_at"].dataType)
    return intervals.where((F.col("fired_at") <= now) & (now <= F.col("cleared_at")))
