"""Run metrics: rows in and out, rule failures, and state, per batch and table."""

from __future__ import annotations

import threading
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import (
    QueryIdleEvent,
    QueryProgressEvent,
    QueryStartedEvent,
    QueryTerminatedEvent,
    StreamingQueryListener,
)

METRICS_SCHEMA = (
    "run_id string, batch_id long, batch_time string, table_name string, metric string, value long"
)


class MetricsRecorder(StreamingQueryListener):
    """Collects the observed metrics of every batch until ``flush`` appends them
    to a metrics table. It holds a few numbers per batch, never rows."""

    def __init__(self) -> None:
        self._lock = threading.Lock()
        self._rows: list[tuple] = []
        self._ended: dict[str, threading.Event] = {}

    def _end_of(self, run_id: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        pass

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        progress = event.progress
        rows = [
            (str(progress.runId), progress.batchId, progress.timestamp, table, metric, value)
            for table, metrics in progress.observedMetrics.items()
            for metric, value in metrics.asDict().items()
            if isinstance(value, int)
        ]
        for number, state in enumerate(progress.stateOperators):
            table = f"{progress.name or progress.id}_state_{number}"
            rows.extend(
                (str(progress.runId), progress.batchId, progress.timestamp, table, metric, value)
                for metric, value in (("rows", state.numRowsTotal), ("late_rows", state.numRowsDroppedByWatermark))
            )
        with self._lock:
            self._rows.extend(rows)

    def onQueryIdle(self, event: QueryIdleEvent) -> None:
        pass

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        self._end_of(str(event.runId)).set()

    def add(self, table: str, metrics: Mapping[str, int], run_id: str = "batch") -> None:
        """Metrics of a batch step, from its ``Observation``."""
        now = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
        with self._lock:
            self._rows.extend((run_id, 0, now, table, metric, value) for metric, value in metrics.items())

    def flush(self, spark: SparkSession, path: str, *queries: StreamingQuery) -> None:
        """Append what was recorded. Events come later than the batches they
        report, so wait for the end event of the given queries first. Where it does not
        come, the run is marked, and a later flush appends what comes after all."""
        for query in queries:
            if not self._end_of(str(query.runId)).wait(timeout=60):
                self.add(query.name or str(query.id), {"end_event_missing": 1}, str(query.runId))
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            table = spark.createDataFrame(rows, METRICS_SCHEMA)
            table.coalesce(1).write.mode("append").parquet(path)


@contextmanager
def recorded(spark: SparkSession, recorder: MetricsRecorder | None) -> Iterator[MetricsRecorder]:
    """The given recorder, which its owner has registered, or one for the block alone."""
    if recorder is not None:
        yield recorder
        return
    own = MetricsRecorder()
    spark.streams.addListener(own)
    try:
        yield own
    finally:
        spark.streams.removeListener(own)


def metrics_table(spark: SparkSession, path: str) -> DataFrame:
    """One row per run, batch, table and metric. A batch that ran again after a
    crash is listed once per run."""
    return spark.read.schema(METRICS_SCHEMA).parquet(path)
