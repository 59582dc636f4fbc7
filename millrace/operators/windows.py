"""Device summaries over tumbling windows, and the queries on top of them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from millrace.functions.times import since

# Window length, alert threshold and alert range.
WINDOW = "30 seconds"
HOT_CELSIUS = 40.0
ALERT_HOURS = 3


def device_summary(readings: DataFrame, window: str = WINDOW) -> DataFrame:
    """Mean and maximum temperature, mean vibration and row count per device,
    location and tumbling window.

    Every aggregate combines map-side, so a device with most of the rows sends
    one row per window and task through the shuffle.
    """
    return readings.groupBy("device_id", "location", F.window("event_timestamp", window)).agg(
        F.avg("temperature_celsius").alias("avg_temp"),
        F.max("temperature_celsius").alias("max_temp"),
        F.avg("vibration_hz").alias("avg_vibration"),
        F.count(F.lit(1)).alias("reading_count"),
    )


def flatten_window(summary: DataFrame) -> DataFrame:
    """``window`` struct to ``window_start`` and ``window_end``."""
    return summary.withColumns(
        {"window_start": F.col("window.start"), "window_end": F.col("window.end")}
    ).drop("window")


def location_mean(summary: DataFrame) -> DataFrame:
    """Mean of the window means per location; every window counts the same."""
    return summary.groupBy("location").agg(F.avg("avg_temp").alias("avg_temp"))


def location_mean_weighted(summary: DataFrame) -> DataFrame:
    """Mean of the window means per location, weighted by readings."""
    weighted = F.sum(F.col("avg_temp") * F.col("reading_count")) / F.sum(
        F.when(F.col("avg_temp").isNotNull(), F.col("reading_count"))
    )
    return summary.groupBy("location").agg(weighted.alias("avg_temp"))


def hot_devices(
    summary: DataFrame,
    threshold: float = HOT_CELSIUS,
    hours: int = ALERT_HOURS,
    as_of: str | datetime | None = None,
    extra: Sequence[str] = (),
) -> DataFrame:
    """Devices and windows of the last ``hours`` hours that reached ``threshold``."""
    return summary.where(
        (F.col("max_temp") >= threshold) & since(F.col("window.start"), hours, as_of)
    ).select("device_id", *extra, F.col("window.start").alias("window_start"), "max_temp")


def hot_devices_from_readings(
    readings: DataFrame,
    threshold: float = HOT_CELSIUS,
    hours: int = ALERT_HOURS,
    as_of: str | datetime | None = None,
    window: str = WINDOW,
) -> DataFrame:
    """The result of ``hot_devices`` without a stored summary.

    A window that starts in the range holds only readings of the range, and its
    maximum reaches the threshold only through a reading that does. Both
    conditions therefore also hold for the readings, where they reach the scan.
    """
    relevant = readings.where(
        (F.col("temperature_celsius") >= threshold)
        & since(F.col("event_timestamp"), hours, as_of)
    )
    summary = relevant.groupBy(
        "device_id", "location", F.window("event_timestamp", window)
    ).agg(F.max("temperature_celsius").alias("max_temp"))
    return hot_devices(summary, threshold, hours, as_of)


def alert_state(hot: DataFrame) -> DataFrame:
    """One row: does the alert fire, and for how many device windows."""
    return hot.agg(
        (F.count(F.lit(1)) > 0).alias("alert"), F.count(F.lit(1)).alias("hot_windows")
    )
