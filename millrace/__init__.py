"""Sensor pipelines, change data capture and data pages on Spark."""

from millrace.session import session

__all__ = ["session"]
