"""A global order cut into slices, for work that a single task must not do."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.session import materialize

SLICE = "_slice"
POSITION = "_position"

# Layout of monotonically_increasing_id: partition number above bit 33, row below.
_ROW_BITS = 33


def ordered_slices(df: DataFrame, order: Sequence[Column], label: str) -> DataFrame:
    """``df`` in global order, with a slice number and the position in the slice.

    Spark range-partitions on the sort columns, so rows with equal sort values
    share a slice and a hot leading column is spread by the following ones. The
    result is a written table: slice bounds come from a sample, and every later
    step has to see the same ones.
    """
    row_id = F.monotonically_increasing_id()
    numbered = (
        df.orderBy(*order)
        .withColumn("_row_id", row_id)
        .withColumn(SLICE, F.shiftright("_row_id", _ROW_BITS).cast("int"))
        .withColumn(POSITION, F.col("_row_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_row_id")
    )
    return materialize(numbered, label)


def slice_offsets(sliced: DataFrame) -> DataFrame:
    """Rows before each slice. One counter per slice is all the driver sees."""
    sizes = sorted(
        (row[SLICE], row["size"])
        for row in sliced.groupBy(SLICE).agg((F.max(POSITION) + 1).alias("size")).collect()
    )
    offsets, before = [], 0
    for number, size in sizes:
        offsets.append((number, before))
        before += size
    return sliced.sparkSession.createDataFrame(offsets, f"{SLICE} int, _before long")


def row_numbers(sliced: DataFrame, name: str = "row_no") -> DataFrame:
    """Adds the zero-based number of every row in the global order."""
    offsets = F.broadcast(slice_offsets(sliced))
    return (
        sliced.join(offsets, SLICE)
        .withColumn(name, F.col("_before") + F.col(POSITION))
        .drop(SLICE, POSITION, "_before")
    )
