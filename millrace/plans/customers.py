"""The customer tables: raw details, history, current rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from millrace.operators.cdc import current_rows, scd2
from millrace.operators.quality import expect, expect_all_or_drop, expect_or_fail
from millrace.sources.audit import ingest_clock
from millrace.plans.data_pages import write_served
from millrace.sources.customers import synthetic_customers
from millrace.sources.tables import read_stream_table, write_stream_table
from millrace.streaming.history import read_history, scd2_stream
from millrace.streaming.metrics import MetricsRecorder, recorded

# Names and conditions of the rules, key and sequence column.
FAIL_RULES = {"null_id": "customer_id IS NOT NULL"}
DROP_RULES = {"valid_customer": "customer_id IS NOT NULL"}
WARN_RULES = {"valid_email": "email IS NOT NULL"}
KEYS = ("customer_id",)
SEQUENCE = "_created_ts"
CREATED_INSTANT = "_created_instant"


def raw_customers(spark: SparkSession, rows: int = 1_000_000, seed: int = 42) -> DataFrame:
    """Generated details with their creation time; stops on a missing id.

    ``_created_ts`` is a local wall clock, kept for audit; ``_created_instant``
    is the true instant that orders the changes.
    """
    created = synthetic_customers(spark, rows, seed).withColumns(
        {SEQUENCE: ingest_clock(), CREATED_INSTANT: F.current_timestamp()}
    )
    return expect_or_fail(created, FAIL_RULES, "raw_customers")


def customer_history(raw: DataFrame, sequence_by: str = CREATED_INSTANT, **options) -> DataFrame:
    valid = expect_all_or_drop(raw, DROP_RULES, Observation("customer_history"))
    times = [c for c in (SEQUENCE, CREATED_INSTANT) if c in raw.columns]
    return scd2(valid, KEYS, sequence_by, except_columns=times, **options)


def current_customers(history: DataFrame) -> DataFrame:
    return expect(current_rows(history), WARN_RULES, Observation("current_customers"))


@dataclass(frozen=True)
class CustomerTables:
    """Where the customer pipeline keeps its tables."""

    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/raw"

    @property
    def history(self) -> str:
        return f"{self.root}/history"

    @property
    def served(self) -> str:
        return f"{self.root}/served"

    @property
    def metrics(self) -> str:
        return f"{self.root}/metrics"

    def checkpoint(self, table: str) -> str:
        return f"{self.root}/checkpoints/{table}"


def run_customers(
    spark: SparkSession,
    arriving: DataFrame,
    root: str,
    sequence_by: str = CREATED_INSTANT,
    tie_breakers: Sequence[str] = (),
    except_columns: Sequence[str] = (SEQUENCE, CREATED_INSTANT),
    recorder: MetricsRecorder | None = None,
) -> CustomerTables:
    """One triggered run: take the details that are new in the stream ``arriving``, then stop.

    Raw details stop the run on a missing id; the history leaves invalid ones out and
    counts them; the current rows are served, with a warning for a missing email. The counters
    of all three go to the metrics table.
    """
    tables = CustomerTables(root)
    with recorded(spark, recorder) as metrics:
        checked = expect_or_fail(arriving, FAIL_RULES, "raw_customers")
        raw = write_stream_table(checked, tables.raw, tables.checkpoint("raw"), name="raw_customers")
        changes = read_stream_table(spark, tables.raw, arriving.schema)
        valid = expect_all_or_drop(changes, DROP_RULES, "customer_history")
        history = scd2_stream(
            valid, tables.history, tables.checkpoint("history"), KEYS, sequence_by, tie_breakers, except_columns
        )
        write_served(current_rows(read_history(spark, tables.history)), tables.served)
        # Counted on the stored rows: a sort by ranges reads its input twice.
        seen = Observation("current_customers")
        expect(spark.read.parquet(tables.served), WARN_RULES, seen).agg(F.count(F.lit(1))).collect()
        metrics.add("current_customers", seen.get, str(history.runId))
        metrics.flush(spark, tables.metrics, raw, history)
    return tables
