"""Fixed-schema projections of the sensor feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from millrace.functions.times import parse_event_time

# Fields of a reading as it lands.
READING_SCHEMA = StructType(
    [
        StructField("device_id", StringType()),
        StructField("timestamp", StringType()),
        StructField("temperature_celsius", DoubleType()),
        StructField("vibration_hz", DoubleType()),
        StructField("humidity_percent", DoubleType()),
        StructField("location", StringType()),
    ]
)


def to_silver(bronze: DataFrame) -> DataFrame:
    """The columns later stages use; a new source column stops here."""
    return bronze.select(
        "device_id",
        parse_event_time("timestamp").alias("event_timestamp"),
        "temperature_celsius",
        "vibration_hz",
        "location",
        "ingestion_timestamp",
        "source_file",
    )
