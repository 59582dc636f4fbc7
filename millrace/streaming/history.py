"""History (type 2) kept up to date by a stream of changes."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from millrace.operators.cdc import NO_KEY, scd2, value_columns
from millrace.sources.tables import read_if_exists, start_stream_table

OPTIONS = "options string"


def scd2_stream(
    changes: DataFrame,
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    sequence_by: str,
    tie_breakers: Sequence[str] = (),
    except_columns: Sequence[str] = (),
    coalesce_unchanged: bool = True,
    name: str = "history",
) -> StreamingQuery:
    """Add the new changes to the history at ``target``, then stop.

    A change opens a version, and the next change of its key ends it. So the table is
    an append-only log of openings: a batch writes each of its changes once and reads
    nothing, whether they come in order or late, and ``read_history`` finds the ends by one
    pass of windows. The file sink commits whole batches; a batch that ran twice counts once.

    Changes without a key are counted in the query's progress under ``name`` and left out; one
    without a sequence value stops the stream.
    """
    spark = changes.sparkSession
    value_columns(changes.columns, list(keys), except_columns)
    plan = {
        "schema": changes.schema.json(), "keys": list(keys), "sequence_by": sequence_by,
        "tie_breakers": list(tie_breakers), "except_columns": list(except_columns),
        "coalesce_unchanged": coalesce_unchanged,
    }
    known = _plan(spark, target)
    if known is None:
        row = spark.createDataFrame([(json.dumps(plan),)], OPTIONS)
        row.coalesce(1).write.mode("overwrite").parquet(f"{target}/options")
    elif known != plan:
        raise ValueError(f"{target} was begun with other options: {known}")

    def quoted(column: str):
        return F.col("`" + column.replace("`", "``") + "`")

    has_key = F.lit(True)
    for key in keys:
        has_key = has_key & quoted(key).isNotNull()
    missing = F.raise_error(F.lit("change without a sequence value"))
    sequence = F.coalesce(quoted(sequence_by), missing.cast(changes.schema[sequence_by].dataType))
    rows = (
        changes.observe(name, F.count(F.lit(1)).alias("rows_in"), F.count_if(~has_key).alias(NO_KEY))
        .where(has_key)
        .withColumn(sequence_by, sequence)
    )
    query = start_stream_table(rows, f"{target}/log", checkpoint, name=name)
    query.awaitTermination()
    return query


def _plan(spark: SparkSession, target: str) -> dict | None:
    stored = read_if_exists(spark, f"{target}/options", OPTIONS)
    row = stored.first() if stored is not None else None
    return json.loads(row["options"]) if row else None


def read_history(spark: SparkSession, target: str) -> DataFrame:
    """The history of all changes so far."""
    plan = _plan(spark, target)
    if plan is None:
        raise ValueError(f"no history at {target}")
    schema = StructType.fromJson(json.loads(plan["schema"]))
    log = read_if_exists(spark, f"{target}/log", schema)
    if log is None:
        log = spark.createDataFrame([], schema)
    return scd2(
        log, plan["keys"], plan["sequence_by"], plan["tie_breakers"], plan["except_columns"],
        plan["coalesce_unchanged"],
    )
