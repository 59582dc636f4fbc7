"""Any page of a stored, ordered table by its number, from the files that hold it.

The directory has one row per file of the table: how many rows it has, and how many come
before it. With a row's place in its file that gives its number, so nothing is copied and
no row but those of a page is read.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from millrace.operators.paging import KEYSET, MAX_LIMIT, Keyset, clamp_limit, key_names, order_columns

# Readers of a table pass over folders whose name begins like this.
DIRECTORY = "_pages"
DIRECTORY_SCHEMA = "file string, size long, before long"


def write_directory(spark: SparkSession, path: str, keys: Keyset = KEYSET) -> None:
    """Number the files of the table at ``path``, whose rows were written in keyset order.

    Files are ordered by their first keys, and files that begin with equal keys by name, as
    one task wrote them in turn. The window holds one row per file.
    """
    first = F.min_by(F.struct(*key_names(keys)), F.col("_metadata.row_index")).alias("first")
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("file"))
    files = files.agg(F.count(F.lit(1)).alias("size"), first).select("file", "size", "first.*")
    order = Window.orderBy(*order_columns(keys), "file").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(order), F.lit(0)).alias("before")
    files.select("file", "size", before).coalesce(1).write.mode("overwrite").parquet(f"{path}/{DIRECTORY}")


def read_directory(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DIRECTORY_SCHEMA).parquet(f"{path}/{DIRECTORY}")


def page_at(
    spark: SparkSession,
    path: str,
    number: int,
    limit: Any = None,
    select: Sequence[str] | None = None,
    cap: int = MAX_LIMIT,
) -> DataFrame:
    """Page ``number`` (from 1) in keyset order; beyond the last page no rows.

    The driver sees the names of the files that hold the page, no more than the page has rows.
    """
    if number < 1:
        raise ValueError(f"pages are numbered from 1, got {number}")
    size = clamp_limit(limit, cap)
    start = (number - 1) * size
    held = (F.col("before") < start + size) & (F.col("before") + F.col("size") > start)
    files = read_directory(spark, path).where(held).collect()
    if not files:
        return spark.read.parquet(path).limit(0).select(*(select or "*"))
    rows = spark.read.parquet(*[f"{path}/{file['file']}" for file in files])
    before = F.lit(0)
    for file in files:
        before = F.when(F.col("_metadata.file_name") == file["file"], file["before"]).otherwise(before)
    numbered = rows.select(
        F.struct(*(select or rows.columns)).alias("row"), (F.col("_metadata.row_index") + before).alias("n")
    )
    wanted = numbered.where((F.col("n") >= start) & (F.col("n") < start + size))
    return wanted.orderBy("n").limit(size).select("row.*")


def all_pages(spark: SparkSession, path: str, limit: Any = None, cap: int = MAX_LIMIT) -> DataFrame:
    """Every row with ``page_no`` (from 1) and ``row_in_page``: ``export_pages`` of a table
    that is stored in order, without a sort or a copy."""
    size, rows = clamp_limit(limit, cap), spark.read.parquet(path)
    placed = rows.select(
        F.struct(*rows.columns).alias("row"),
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.row_index").alias("place"),
    )
    numbered = placed.join(read_directory(spark, path), "file").withColumn("n", F.col("before") + F.col("place"))
    return numbered.select(
        "row.*", (F.expr(f"n div {size}") + 1).alias("page_no"), (F.col("n") % size + 1).alias("row_in_page")
    )
