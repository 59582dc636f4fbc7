"""The sensor pipeline: landing files, bronze, silver and quarantine, summary."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from millrace.operators.projections import READING_SCHEMA, to_silver
from millrace.operators.quality import expect, expect_or_drop, split_quarantine
from millrace.sources.json_files import INGEST_COLUMNS, ingest_json
from millrace.sources.schemas import read_evolving
from millrace.sources.tables import read_if_exists, read_stream_table, start_stream_table
from millrace.streaming.alerts import hot_windows, read_hot_windows, start_hot_windows
from millrace.streaming.metrics import MetricsRecorder, recorded
from millrace.streaming.summary import (
    partial_summary,
    read_summary_partials,
    write_summary_partials,
)

# Names and conditions of the rules.
DROP_RULES = {
    "valid_device_id": "device_id IS NOT NULL",
    # A reading without a time would vanish in the windows; it is quarantined instead.
    "valid_event_time": "event_timestamp IS NOT NULL",
}
WARN_RULES = {"warn_on_high_temp": "temperature_celsius < 40"}

# What silver reads of bronze. The types are fixed, so a wider bronze schema does
# not reach the streams behind it.
BRONZE_SCHEMA = StructType(READING_SCHEMA.fields + INGEST_COLUMNS.fields)


@dataclass(frozen=True)
class SensorTables:
    """Where one generation of the pipeline keeps its tables."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def schema_log(self) -> str:
        return f"{self.root}/schema_log"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def summary(self) -> str:
        return f"{self.root}/summary"

    @property
    def alerts(self) -> str:
        return f"{self.root}/alerts"

    @property
    def metrics(self) -> str:
        return f"{self.root}/metrics"

    def checkpoint(self, table: str) -> str:
        return f"{self.root}/checkpoints/{table}"


def silver_rows(bronze: DataFrame) -> DataFrame:
    """Silver with its counters: ``silver_drop`` on all rows, ``silver`` on the kept."""
    kept = expect_or_drop(to_silver(bronze), DROP_RULES, "silver_drop")
    return expect(kept, WARN_RULES, "silver")


def quarantine_rows(bronze: DataFrame) -> DataFrame:
    _, failed = split_quarantine(to_silver(bronze), DROP_RULES)
    return failed.observe("quarantine", F.count(F.lit(1)).alias("rows_in"))


def silver_schema(spark: SparkSession) -> StructType:
    return to_silver(spark.createDataFrame([], BRONZE_SCHEMA)).schema


def current_tables(spark: SparkSession, root: str) -> SensorTables:
    """The tables of the newest finished full refresh (generation 0 at first)."""
    return SensorTables(f"{root}/generation-{_generation(spark, root)}")


def _generation(spark: SparkSession, root: str) -> int:
    done = read_if_exists(spark, f"{root}/generations", "generation int")
    newest = done.agg(F.max("generation")).first()[0] if done is not None else None
    return newest or 0


def run_pipeline(
    spark: SparkSession,
    landing: str,
    root: str,
    full_refresh: bool = False,
    recorder: MetricsRecorder | None = None,
    **batch_options: str,
) -> SensorTables:
    """One triggered run: process the files that are new, then stop.

    A full refresh fills new tables with new checkpoints from every landing file;
    readers keep the old tables until it is finished. ``batch_options`` such as
    ``maxBytesPerTrigger`` bound the batches of every stream of the run, so that a
    large backlog does not become one batch.

    The run's metrics are appended to its metrics table; a ``recorder`` that the caller
    has registered is used for them if given.
    """
    generation = _generation(spark, root) + (1 if full_refresh else 0)
    tables = SensorTables(f"{root}/generation-{generation}")
    with recorded(spark, recorder) as metrics:
        queries = _fill(spark, landing, tables, batch_options)
        if full_refresh:
            pointer = spark.createDataFrame([(generation,)], "generation int")
            pointer.coalesce(1).write.mode("append").parquet(f"{root}/generations")
        metrics.flush(spark, tables.metrics, *queries)
    return tables


def _fill(spark: SparkSession, landing: str, tables: SensorTables, batch_options: dict[str, str]) -> list[StreamingQuery]:
    ingest = ingest_json(
        spark, landing, tables.bronze, tables.checkpoint("bronze"), tables.schema_log,
        hints=READING_SCHEMA, **batch_options,
    )
    bronze = read_stream_table(spark, tables.bronze, BRONZE_SCHEMA, **batch_options)
    silver = start_stream_table(
        silver_rows(bronze), tables.silver, tables.checkpoint("silver"), name="silver"
    )
    quarantine = start_stream_table(
        quarantine_rows(bronze), tables.quarantine, tables.checkpoint("quarantine"), name="quarantine"
    )
    _await(silver, quarantine)

    readings = read_stream_table(spark, tables.silver, silver_schema(spark), **batch_options)
    alerts = start_hot_windows(readings, tables.alerts, tables.checkpoint("alerts"))
    counted = readings.observe("summary", F.count(F.lit(1)).alias("rows_in"))
    try:
        summary = write_summary_partials(counted, tables.summary, tables.checkpoint("summary"))
    finally:
        _await(alerts)
    return [ingest, silver, quarantine, alerts, summary]


def _await(*queries: StreamingQuery) -> None:
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            query.stop()


def read_bronze(spark: SparkSession, tables: SensorTables) -> DataFrame:
    return read_evolving(spark, tables.bronze, tables.schema_log, READING_SCHEMA, INGEST_COLUMNS)


def read_silver(spark: SparkSession, tables: SensorTables) -> DataFrame:
    return spark.read.schema(silver_schema(spark)).parquet(tables.silver)


def read_quarantine(spark: SparkSession, tables: SensorTables) -> DataFrame:
    schema = quarantine_rows(spark.createDataFrame([], BRONZE_SCHEMA)).schema
    return spark.read.schema(schema).parquet(tables.quarantine)


def read_device_summary(spark: SparkSession, tables: SensorTables) -> DataFrame:
    empty = spark.createDataFrame([], silver_schema(spark))
    return read_summary_partials(spark, tables.summary, partial_summary(empty).schema)


def read_hot(spark: SparkSession, tables: SensorTables) -> DataFrame:
    """Every hot device window so far."""
    schema = hot_windows(spark.createDataFrame([], silver_schema(spark))).schema
    return read_hot_windows(spark, tables.alerts, schema)
