"""Summaries with a watermark of their own: closed windows, open windows, late rows.

A batch is held against the watermark of the batches before it. Readings of windows that
this watermark has closed, and readings without a time, go to a table of late rows; all
others go to partial summaries. No row is lost, and no executor keeps state.

Below ``path``: ``summary`` (a versioned table of partial summaries), ``late`` and ``marks``
(one folder per batch; a repeated batch replaces its own).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from millrace.operators.windows import WINDOW
from millrace.sources.tables import path_exists, read_if_exists
from millrace.streaming.summary import WATERMARK, add_partials, partial_summary, read_summary_partials

# Times as microseconds, which no time zone of a Python process can shift.
MARK = "greatest long"


def closed_before(
    spark: SparkSession, path: str, delay: str = WATERMARK, window: str = WINDOW, batch_id: int | None = None
) -> int | None:
    """The start of the oldest open window, in microseconds: all windows before it are closed.

    With ``batch_id`` as the batches before that one left it. None if nothing is closed.
    """
    marks = read_if_exists(spark, f"{path}/marks", f"{MARK}, batch_id long")
    if marks is None:
        return None
    if batch_id is not None:
        marks = marks.where(F.col("batch_id") < batch_id)
    watermark = marks.agg(F.max("greatest").alias("greatest")).select(
        (F.timestamp_micros("greatest") - F.expr(f"INTERVAL {delay}")).alias("watermark")
    )
    # A missing watermark has no window, and so no row.
    starts = watermark.select(F.window("watermark", window).alias("window"))
    row = starts.select(F.unix_micros("window.start").alias("start")).first()
    return row and row["start"]


def _is_late(closed: int | None) -> Column:
    """A plain comparison, which a scan can skip files by."""
    time = F.col("event_timestamp")
    return time.isNull() if closed is None else time.isNull() | (time < F.timestamp_micros(F.lit(closed)))


def write_closing_summary(
    readings: DataFrame, path: str, checkpoint: str, delay: str = WATERMARK, window: str = WINDOW
) -> StreamingQuery:
    """Process what is new, then stop; see the module's text."""
    schema = partial_summary(readings, window).schema

    def add(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        late = _is_late(closed_before(spark, path, delay, window, batch_id))
        batch.where(late).write.mode("overwrite").parquet(f"{path}/late/batch_id={batch_id}")
        add_partials(partial_summary(batch.where(~late), window), f"{path}/summary", batch_id, schema)
        # Not observed on the way: a batch without files is optimised away, its metrics too.
        mark = batch.agg(F.unix_micros(F.max("event_timestamp").cast("timestamp"))).first()[0]
        row = spark.createDataFrame([(mark,)], MARK)
        row.coalesce(1).write.mode("overwrite").parquet(f"{path}/marks/batch_id={batch_id}")

    query = (
        readings.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def read_closing_summary(
    spark: SparkSession, path: str, schema: StructType, delay: str = WATERMARK, window: str = WINDOW
) -> DataFrame:
    """Every window so far with ``closed``; a closed window never changes.

    ``schema`` is that of ``partial_summary``.
    """
    closed = closed_before(spark, path, delay, window)
    is_closed = F.lit(False) if closed is None else F.col("window.start") < F.timestamp_micros(F.lit(closed))
    return read_summary_partials(spark, f"{path}/summary", schema).withColumn("closed", is_closed)


def read_late(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The late rows with the ``batch_id`` in which they came; ``schema`` is that of the readings."""
    folder, stored = f"{path}/late", StructType([*schema.fields]).add("batch_id", "long")
    return spark.read.schema(stored).parquet(folder) if path_exists(spark, folder) else spark.createDataFrame([], stored)
