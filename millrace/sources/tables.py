"""Tables as folders: streaming reads and writes, and versioned tables.

A versioned table keeps its rows under ``data/version=N/part=P`` and one small
commit per version under ``commits/version=N`` that names the live version of
every part. Readers follow the newest commit, so a job that dies between the two
writes leaves the table as it was, and a repeated version replaces itself. A part that
got no rows has no folder; its commit row holds ``~version``, which readers skip.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType


def read_stream_table(
    spark: SparkSession, path: str, schema: StructType | None = None, **options: str
) -> DataFrame:
    """The rows a streaming sink appended to ``path``, as a stream."""
    schema = schema or spark.read.parquet(path).schema
    return spark.readStream.schema(schema).options(**options).parquet(path)


def stream_writer(
    df: DataFrame, path: str, checkpoint: str, mode: str = "append", partition_by: Sequence[str] = ()
) -> DataStreamWriter:
    writer = df.writeStream.format("parquet").outputMode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.option("path", path).option("checkpointLocation", checkpoint)


def write_stream_table(
    df: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "append",
    partition_by: Sequence[str] = (),
    name: str | None = None,
) -> StreamingQuery:
    """Append what is new to ``path``, then stop (a triggered run).

    The file sink commits whole batches, so a restart neither loses nor repeats
    rows, and another stream may read the folder.
    """
    query = start_stream_table(df, path, checkpoint, mode, partition_by, name)
    query.awaitTermination()
    return query


def start_stream_table(
    df: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "append",
    partition_by: Sequence[str] = (),
    name: str | None = None,
) -> StreamingQuery:
    """The same without waiting, so that several tables can be filled at a time."""
    writer = stream_writer(df, path, checkpoint, mode, partition_by)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(availableNow=True).start()


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    files, hadoop_path = _file_system(spark, path)
    return files.exists(hadoop_path)


def read_if_exists(
    spark: SparkSession, path: str, schema: StructType | str
) -> DataFrame | None:
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else None


COMMIT_SCHEMA = "part int, live_version long"


def _commit_folders(spark: SparkSession, path: str) -> list[int]:
    """Versions that have a commit folder, newest first."""
    files, commits = _file_system(spark, f"{path}/commits")
    if not files.exists(commits):
        return []
    names = [status.getPath().getName() for status in files.listStatus(commits)]
    return sorted((int(n.removeprefix("version=")) for n in names if n.startswith("version=")), reverse=True)


def live_parts(spark: SparkSession, path: str) -> dict[int, int]:
    """Part to live version, from the newest commit; one row per part.

    A commit is a single file, so a folder without rows was never committed.
    """
    for version in _commit_folders(spark, path):
        rows = spark.read.schema(COMMIT_SCHEMA).parquet(f"{path}/commits/version={version}").collect()
        if rows:
            return {row["part"]: row["live_version"] for row in rows}
    return {}


def is_committed(live: Mapping[int, int], version: int) -> bool:
    """Whether ``version`` is the live version of a part, with rows or without."""
    return version in live.values() or ~version in live.values()


def _written_parts(spark: SparkSession, folder: str) -> set[int]:
    files, path = _file_system(spark, folder)
    names = [status.getPath().getName() for status in files.listStatus(path)]
    return {int(n.removeprefix("part=")) for n in names if n.startswith("part=")}


def part_bytes(spark: SparkSession, path: str, live: Mapping[int, int]) -> dict[int, int]:
    """Stored size of every live part that has rows."""
    sizes = {}
    for part, version in live.items():
        if version >= 0:
            files, folder = _file_system(spark, f"{path}/data/version={version}/part={part}")
            sizes[part] = files.getContentSummary(folder).getLength()
    return sizes


def write_version(
    df: DataFrame, path: str, version: int, parts: Sequence[int], live: Mapping[int, int]
) -> None:
    """Replace ``parts`` of the table by ``df`` (with a ``part`` column) and commit.

    ``live`` is what ``live_parts`` gave before. With several parts, the rebalance
    hint gathers a small part into few files and splits a large one over several
    tasks.
    """
    spark = df.sparkSession
    placed = df.hint("rebalance", F.col("part")) if len(parts) > 1 else df
    placed.write.mode("overwrite").partitionBy("part").parquet(f"{path}/data/version={version}")
    written = _written_parts(spark, f"{path}/data/version={version}")
    live = {**live, **{part: version if part in written else ~version for part in parts}}
    commit = spark.createDataFrame(sorted(live.items()), COMMIT_SCHEMA)
    commit.coalesce(1).write.mode("overwrite").parquet(f"{path}/commits/version={version}")


def read_versioned(
    spark: SparkSession, path: str, schema: StructType, live: Mapping[int, int] | None = None
) -> DataFrame:
    """The live rows with their ``part`` column.

    ``live`` narrows the read to some parts. Only live folders are listed and read,
    however many versions came before.
    """
    if live is None:
        live = live_parts(spark, path)
    columns = [f.name for f in schema.fields if f.name != "part"]
    stored = StructType([f for f in schema.fields if f.name != "part"]).add("part", "integer")
    live = {part: version for part, version in live.items() if version >= 0}
    if not live:
        return spark.createDataFrame([], stored)
    base = f"{path}/data"
    folders = [f"{base}/version={version}/part={part}" for part, version in sorted(live.items())]
    reader = spark.read.schema(stored.add("version", "long")).option("basePath", base)
    return reader.parquet(*folders).select(*columns, "part")
