"""Timestamps: parsing, text form, relative ranges."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType, TimestampNTZType, TimestampType


def parse_event_time(text: Column | str) -> Column:
    """Text to TIMESTAMP; naive text is read in the session zone.

    Text with an offset keeps its instant. Malformed text gives NULL rather than
    an error, so that a quality rule can quarantine the row.
    """
    column = F.col(text) if isinstance(text, str) else text
    return column.try_cast("timestamp")


def is_timestamp(dtype: DataType) -> bool:
    return isinstance(dtype, (TimestampType, TimestampNTZType))


def iso_text(column: Column, dtype: DataType) -> Column:
    """ISO-8601 text with all six fraction digits, or none when they are zero.

    A TIMESTAMP carries its offset (``Z`` in a UTC session), a TIMESTAMP_NTZ none.
    """
    zone = "" if isinstance(dtype, TimestampNTZType) else "XXX"
    text = F.date_format(column, f"yyyy-MM-dd'T'HH:mm:ss.SSSSSS{zone}")
    return F.replace(text, F.lit(".000000"), F.lit(""))


def since(column: Column, hours: int, as_of: str | datetime | None = None) -> Column:
    """True for times at or after ``hours`` hours before ``as_of`` (default: now)."""
    now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp_ntz")
    return column >= now - F.expr(f"INTERVAL {int(hours)} HOURS")
