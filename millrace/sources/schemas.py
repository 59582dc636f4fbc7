"""Schema tracking of JSON feeds: new columns and wider types.

Bronze keeps every record as one VARIANT, next to the columns whose types are
fixed. A new field, or a value of another type, is thus stored before anyone
knows about it, and the schema only decides how the record is shown. The log
holds the merged schema after each run.
"""

from __future__ import annotations

import json
import re

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    DataType,
    DecimalType,
    DoubleType,
    NullType,
    StringType,
    StructField,
    StructType,
    VariantType,
)

from millrace.sources.tables import read_if_exists

RECORD = "record"
# One row per batch: the schema of all records up to it, and the ingestion time of its rows
# in microseconds.
LOG_SCHEMA = "last_batch long, schema_json string, ingested long"


def record_schema(record: str = RECORD) -> Column:
    """Aggregate: the merged schema of all records, as text."""
    return F.schema_of_variant_agg(record)


def from_schema_text(text: str | None) -> StructType:
    """The result of ``record_schema`` as a schema; no fields if there are none."""
    if not text or not text.startswith("OBJECT<"):
        return StructType()
    ddl = re.sub(r"\bOBJECT<", "STRUCT<", text)
    parsed = StructType.fromDDL(f"r {ddl}")["r"].dataType
    return StructType([StructField(f.name, _plain(f.dataType)) for f in parsed.fields])


def _plain(dtype: DataType) -> DataType:
    """Fractions as DOUBLE; mixed or absent types as text."""
    if isinstance(dtype, DecimalType) and dtype.scale > 0:
        return DoubleType()
    if isinstance(dtype, (VariantType, NullType)):
        return StringType()
    return dtype


def widen(a: StructType, b: StructType) -> StructType:
    """A schema that holds both: all columns, with the wider type where they differ.

    Spark's own union rules find the wider type. Types without one become text.
    """
    mine = {f.name: f.dataType for f in a.fields}
    theirs = {f.name: f.dataType for f in b.fields}
    fields = [
        StructField(name, _wider(dtype, theirs[name]) if name in theirs else dtype)
        for name, dtype in mine.items()
    ]
    return StructType(fields + [StructField(n, t) for n, t in theirs.items() if n not in mine])


def _wider(a: DataType, b: DataType) -> DataType:
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, StringType) or isinstance(b, StringType):
        return StringType()
    spark = SparkSession.active()
    one, other = (spark.createDataFrame([], StructType([StructField("c", t)])) for t in (a, b))
    try:
        return one.unionByName(other, allowMissingColumns=True).schema["c"].dataType
    except Exception:
        return StringType()


def evolve_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of both frames under the widened schema; missing columns are NULL."""
    target = widen(a.schema, b.schema)
    return _as(a, target).unionByName(_as(b, target))


def _as(df: DataFrame, target: StructType) -> DataFrame:
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.fields
        ]
    )


def logged_schema(spark: SparkSession, schema_log: str) -> tuple[int, StructType]:
    """The last batch the log covers (-1 for none), and the schema up to it."""
    log = read_if_exists(spark, schema_log, LOG_SCHEMA)
    newest = None
    if log is not None:
        newest = log.agg(F.max("last_batch"), F.max_by("schema_json", "last_batch")).first()
    if newest is None or newest[0] is None:
        return -1, StructType()
    return newest[0], StructType.fromJson(json.loads(newest[1]))


def journal_schemas(
    spark: SparkSession,
    bronze: str,
    schema_log: str,
    found: Mapping[int, tuple[str | None, int]],
) -> StructType:
    """Log the batches after the logged ones up to the last one that was found.

    ``found`` holds the schema text and the ingestion time of the batches that are known. The
    others are read from the rows of the bronze table that were ingested between the known
    batches around them, and from no others.
    """
    logged, merged = logged_schema(spark, schema_log)
    expected = range(logged + 1, max(found) + 1)
    missing = [batch for batch in expected if batch not in found]
    if missing:
        before = {batch: time for batch, (_, time) in found.items() if batch < missing[0]}
        start = before[max(before)] if before else logged_time(spark, schema_log)
        after = {batch: time for batch, (_, time) in found.items() if batch > missing[-1]}
        text = schema_between(spark, bronze, start, after[min(after)])
        merged = widen(merged, from_schema_text(text))
    rows = []
    for batch in sorted(set(expected).intersection(found)):
        text, time = found[batch]
        merged = widen(merged, from_schema_text(text))
        rows.append((batch, merged.json(), time))
    if rows:
        spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(schema_log)
    return merged


# The ingestion time is a wall clock, which goes back by an hour once a year.
CLOCK_CHANGE = 3_600_000_000


def schema_between(
    spark: SparkSession, bronze: str, start: int | None, end: int | None
) -> str | None:
    """Schema text of the records ingested from ``start`` to ``end`` (open if None). All rows
    of a batch have one ingestion time, so other files are skipped by their statistics."""
    rows = spark.read.schema(f"{RECORD} variant, ingestion_timestamp timestamp").parquet(bronze)
    if start is not None:
        rows = rows.where(F.col("ingestion_timestamp") >= F.timestamp_micros(F.lit(start - CLOCK_CHANGE)))
    if end is not None:
        rows = rows.where(F.col("ingestion_timestamp") <= F.timestamp_micros(F.lit(end + CLOCK_CHANGE)))
    return rows.agg(record_schema()).first()[0]


def logged_time(spark: SparkSession, schema_log: str) -> int | None:
    """Ingestion time of the last logged batch; None if that is not known."""
    log = read_if_exists(spark, schema_log, LOG_SCHEMA)
    return log.agg(F.max_by("ingested", "last_batch")).first()[0] if log is not None else None


def field(name: str, dtype: DataType) -> Column:
    """A field of the record; NULL where it is missing or of another type."""
    quoted = name.replace("\\", "\\\\").replace("'", "\\'")
    return F.try_variant_get(RECORD, f"$['{quoted}']", dtype.simpleString()).alias(name)


def read_evolving(
    spark: SparkSession, path: str, schema_log: str, hints: StructType, extra: StructType
) -> DataFrame:
    """A bronze table under the newest schema.

    The columns of ``hints`` and ``extra`` are stored; the others come from the
    record. Spark stores a VARIANT shredded, with a parquet column per field that files
    share, so a grown column reads its own field and not the record. Of fields that differ
    in case only, the first is shown, as column names ignore case.
    """
    stored = StructType([*hints.fields, *extra.fields]).add(RECORD, VariantType())
    _, schema = logged_schema(spark, schema_log)
    taken = {f.name.lower() for f in stored.fields}
    grown = []
    for f in schema.fields:
        if f.name.lower() not in taken:
            taken.add(f.name.lower())
            grown.append(field(f.name, f.dataType))
    return spark.read.schema(stored).parquet(path).select(*hints.names, *grown, *extra.names)
