"""Audit columns of the ingest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: zone of the ingestion wall clock.
INGEST_ZONE = "America/New_York"


def ingest_clock(tz: str = INGEST_ZONE) -> Column:
    """Wall clock of ``tz``. It repeats an hour when daylight saving ends, so it
    is for audit only and orders nothing."""
    return F.from_utc_timestamp(F.current_timestamp(), tz)


def with_ingest_meta(df: DataFrame, tz: str = INGEST_ZONE) -> DataFrame:
    """Adds ``ingestion_timestamp`` and ``source_file`` to a frame read from files."""
    return df.select(
        "*",
        ingest_clock(tz).alias("ingestion_timestamp"),
        F.col("_metadata.file_path").alias("source_file"),
    )
