"""Device summaries on streams."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from millrace.functions.times import since
from millrace.operators.windows import WINDOW, device_summary, hot_devices
from millrace.sources.tables import is_committed, live_parts, part_bytes, read_versioned, write_version

# Fixed value: how late a reading may be when a watermark is used.
WATERMARK = "2 minutes"


@contextmanager
def state_partitions(spark: SparkSession, count: int) -> Iterator[None]:
    """Start a stateful stream inside with ``count`` state partitions.

    The first run of a checkpoint fixes the number for good, so choose it for the
    cluster (a small multiple of its cores) and not for the first batch.
    """
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(count))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def device_summary_stream(
    readings: DataFrame, watermark: str | None = None, window: str = WINDOW
) -> DataFrame:
    """``device_summary`` as a streaming aggregate.

    Without a watermark every late reading counts and the state keeps all
    windows: use output mode ``complete`` or ``update``. With one, windows are
    emitted once in ``append`` mode and their state is dropped.
    """
    if watermark:
        readings = readings.withWatermark("event_timestamp", watermark)
    return device_summary(readings, window)


def write_summary_complete(summary: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Every batch replaces the whole summary by a new version, then stop.

    A batch that was committed already is not written again.
    """

    def replace(batch: DataFrame, batch_id: int) -> None:
        live = live_parts(batch.sparkSession, path)
        if not is_committed(live, batch_id):
            write_version(batch.withColumn("part", F.lit(0)), path, batch_id, [0], live)

    query = (
        summary.writeStream.outputMode("complete")
        .foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


PARTIAL_COLUMNS = {
    "sum_temp": "sum(temperature_celsius)",
    "n_temp": "count(temperature_celsius)",
    "max_temp": "max(temperature_celsius)",
    "sum_vibration": "sum(vibration_hz)",
    "n_vibration": "count(vibration_hz)",
    "reading_count": "count(*)",
}


def partial_summary(readings: DataFrame, window: str = WINDOW) -> DataFrame:
    """Sums and counts per device, location and window; two of them can be merged."""
    columns = [F.expr(text).alias(name) for name, text in PARTIAL_COLUMNS.items()]
    return readings.groupBy(
        "device_id", "location", F.window("event_timestamp", window)
    ).agg(*columns)


def merge_partials(partials: DataFrame) -> DataFrame:
    merge = {name: F.max if name == "max_temp" else F.sum for name in PARTIAL_COLUMNS}
    columns = [function(name).alias(name) for name, function in merge.items()]
    return partials.groupBy("device_id", "location", "window").agg(*columns)


def parts_to_merge(sizes: Mapping[int, int]) -> list[int]:
    """The newest parts that are of like size; nothing if the newest stands alone.

    A part joins those after it if it is at most twice as large as they are together. What
    stays behind is more than twice as large as what follows, so the parts of a table are
    as many as a logarithm of its size, and a row is written again as often.
    """
    group, total = [], 0
    for part in sorted(sizes, reverse=True):
        if group and sizes[part] > 2 * total:
            break
        group.append(part)
        total += sizes[part]
    return group if len(group) > 1 else []


def add_partials(partials: DataFrame, path: str, batch_id: int, schema: StructType) -> None:
    """Commit the partial summary of a batch as a part of its own, and merge parts of like
    size that older batches left. A batch that was committed before is left as it is."""
    spark = partials.sparkSession
    live = live_parts(spark, path)
    if is_committed(live, batch_id):
        return
    live = {part: version for part, version in live.items() if version >= 0}
    rows, parts = partials.withColumn("part", F.lit(batch_id).cast("int")), [batch_id]
    group = parts_to_merge(part_bytes(spark, path, live))
    if group:
        before = read_versioned(spark, path, schema, {part: live.pop(part) for part in group}).drop("part")
        merged = merge_partials(before).withColumn("part", F.lit(group[0]).cast("int"))
        rows, parts = rows.unionByName(merged), [group[0], batch_id]
    write_version(rows, path, batch_id, parts, live)


def write_summary_partials(
    readings: DataFrame, path: str, checkpoint: str, window: str = WINDOW
) -> StreamingQuery:
    """Keep the summary of a stream up to date without state, then stop.

    Every batch adds the partial summary of its own rows, so the work of a batch
    grows with the batch and not with the table, late readings count, and nothing
    is kept in executors between batches. Parts of like size are merged.
    """
    schema = partial_summary(readings, window).schema

    def add(batch: DataFrame, batch_id: int) -> None:
        add_partials(partial_summary(batch, window), path, batch_id, schema)

    query = (
        readings.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def read_summary_partials(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The summary of all readings so far; ``schema`` is that of ``partial_summary``."""
    merged = merge_partials(read_versioned(spark, path, schema).drop("part"))
    return merged.select(
        "device_id",
        "location",
        "window",
        (F.col("sum_temp") / F.nullif("n_temp", F.lit(0))).alias("avg_temp"),
        "max_temp",
        (F.col("sum_vibration") / F.nullif("n_vibration", F.lit(0))).alias("avg_vibration"),
        "reading_count",
    )


def read_summary(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return read_versioned(spark, path, schema).drop("part")


def write_alerts(
    summary: DataFrame, path: str, checkpoint: str, threshold: float, hours: int, as_of: str | None = None
) -> StreamingQuery:
    """Hot device windows as they change, one folder per batch.

    A repeated batch overwrites its own folder. The newest row of a window is
    the one with the greatest ``batch_id``; see ``read_alerts``.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        hot = hot_devices(batch, threshold, hours, as_of, extra=["location"])
        hot.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    query = (
        summary.writeStream.outputMode("update")
        .foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def read_alerts(
    spark: SparkSession, path: str, hours: int | None = None, as_of: str | None = None
) -> DataFrame:
    """The newest state of every hot device window.

    With ``hours`` only windows that start at most so long before ``as_of`` (default:
    now), so that an alert clears when its window has become old.
    """
    alerts = spark.read.parquet(path)
    if hours is not None:
        alerts = alerts.where(since(F.col("window_start"), hours, as_of))
    return (
        alerts.groupBy("device_id", "location", "window_start")
        .agg(F.max_by("max_temp", "batch_id").alias("max_temp"))
    )

