"""Incremental ingest of a JSON landing folder into a bronze table."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import (
    QueryIdleEvent,
    QueryProgressEvent,
    QueryStartedEvent,
    QueryTerminatedEvent,
    StreamingQueryListener,
    StreamingQueryProgress,
)
from pyspark.sql.types import StringType, StructType, TimestampType

from millrace.sources.audit import with_ingest_meta
from millrace.sources.schemas import RECORD, field, journal_schemas, record_schema
from millrace.sources.tables import write_stream_table

# Text of a line that is no JSON.
UNPARSED = "unparsed"

INGEST_COLUMNS = (
    StructType()
    .add("ingestion_timestamp", TimestampType())
    .add("source_file", StringType())
    .add(UNPARSED, StringType())
)


def read_landing(spark: SparkSession, path: str, hints: StructType, **options: str) -> DataFrame:
    """New landing files as a stream: record, columns of ``hints``, audit columns.

    A line of a file is a JSON object, or a JSON array of objects that gives one
    row per object. A line that cannot be read gives a row with its text. Options
    go to the file source, for example ``maxFilesPerTrigger`` to bound a batch.
    """
    reader = spark.readStream.schema(f"{RECORD} variant, {UNPARSED} string").options(
        recursiveFileLookup="true", singleVariantColumn=RECORD, columnNameOfCorruptRecord=UNPARSED
    )
    lines = with_ingest_meta(reader.options(**options).json(path))
    objects = F.coalesce(
        F.try_variant_get(RECORD, "$", "array<variant>"), F.array(RECORD)
    )
    rows = lines.withColumn(RECORD, F.explode(objects))
    return rows.select(
        RECORD, *[field(f.name, f.dataType) for f in hints.fields], *INGEST_COLUMNS.names
    )


def ingest_json(
    spark: SparkSession,
    path: str,
    target: str,
    checkpoint: str,
    schema_log: str,
    hints: StructType,
    name: str = "bronze",
    **options: str,
) -> StreamingQuery:
    """Append every landing file not seen before to the bronze table, then stop.

    ``hints`` are the columns with fixed types. The schema of the records is
    collected while they are read, so the files are parsed once.
    """
    rows = read_landing(spark, path, hints, **options).observe(
        name,
        F.count(F.lit(1)).alias("rows_in"),
        record_schema().alias("record_schema"),
        # As text: it is no counter of rows, which metrics tables add up.
        F.unix_micros(F.max("ingestion_timestamp")).cast("string").alias("ingested"),
    )
    with batch_schemas(spark, name) as seen:
        query = write_stream_table(rows, target, checkpoint, name=name)
        found = seen.of(query)
    if found:
        journal_schemas(spark, target, schema_log, found)
    return query


class BatchSchemas(StreamingQueryListener):
    """The schema text and the ingestion time of every batch that ends. A query itself
    remembers its last hundred batches only."""

    def __init__(self, name: str):
        self.name = name
        self._changed = threading.Condition()
        self._found: dict[str, dict[int, tuple[str | None, int]]] = {}
        self._ended: set[str] = set()

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        pass

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        progress = event.progress
        with self._changed:
            self._note(str(progress.runId), progress)

    def onQueryIdle(self, event: QueryIdleEvent) -> None:
        pass

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def _note(self, run: str, progress: StreamingQueryProgress) -> None:
        if progress.numInputRows > 0 and self.name in progress.observedMetrics:
            metrics = progress.observedMetrics[self.name]
            batches = self._found.setdefault(run, {})
            batches[progress.batchId] = (metrics["record_schema"], int(metrics["ingested"]))

    def of(self, query: StreamingQuery, wait: float = 60) -> dict[int, tuple[str | None, int]]:
        """What was found of a query that ended. If its last event does not come, batches may
        be missing, but for those that the query remembers."""
        run = str(query.runId)
        with self._changed:
            self._changed.wait_for(lambda: run in self._ended, wait)
            for progress in query.recentProgress:
                self._note(run, progress)
            return self._found.get(run, {})


@contextmanager
def batch_schemas(spark: SparkSession, name: str) -> Iterator[BatchSchemas]:
    listener = BatchSchemas(name)
    spark.streams.addListener(listener)
    try:
        yield listener
    finally:
        spark.streams.removeListener(listener)
