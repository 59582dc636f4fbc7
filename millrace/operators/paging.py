"""Keyset pages over a table, and the page number of every row."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.cursors import cursor_token
from millrace.functions.jsonsafe import item_json
from millrace.operators.ordered import ordered_slices, row_numbers

# Order of the pages, default and greatest page size.
KEYSET = (("modified_ts", "DESC"), ("customer_id", "DESC"))
DEFAULT_LIMIT = 50
MAX_LIMIT = 200

Keyset = Sequence[tuple[str, str]]


def key_names(keys: Keyset) -> list[str]:
    return [name for name, _ in keys]


def _descending(direction: str) -> bool:
    return direction.upper() == "DESC"


def order_columns(keys: Keyset = KEYSET) -> list[Column]:
    return [F.col(n).desc() if _descending(d) else F.col(n).asc() for n, d in keys]


def keyset_order(df: DataFrame, keys: Keyset = KEYSET) -> DataFrame:
    return df.orderBy(*order_columns(keys))


def after(df: DataFrame, values: Sequence[Any], keys: Keyset = KEYSET) -> DataFrame:
    """The rows strictly after the given key values, in keyset order.

    The condition on the leading key alone follows from the other one; it is stated
    for itself because it can skip files and partitions.
    """
    if len(values) != len(keys):
        raise ValueError(f"a cursor needs {len(keys)} key values, got {len(values)}")
    beyond = F.lit(False)
    for (name, direction), value in reversed(list(zip(keys, values))):
        column, bound = F.col(name), F.lit(value).cast(df.schema[name].dataType)
        past = column < bound if _descending(direction) else column > bound
        beyond = past | ((column == bound) & beyond)
    # The loop ends with the leading key.
    reached = column <= bound if _descending(direction) else column >= bound
    return df.where(reached).where(beyond)


def clamp_limit(limit: Any, cap: int = MAX_LIMIT) -> int:
    """Nothing or 0 means the default; else at least 1 and at most ``cap``."""
    asked = int(limit) if limit else DEFAULT_LIMIT
    return min(max(asked, 1), cap)


def page_with_lookahead(
    df: DataFrame,
    limit: Any = None,
    cursor: Sequence[Any] | None = None,
    keys: Keyset = KEYSET,
    cap: int = MAX_LIMIT,
) -> DataFrame:
    """The rows of a page and one more, which tells whether another page follows.

    Sort and limit together keep only the best rows of every task.
    """
    rows = after(df, cursor, keys) if cursor else df
    return keyset_order(rows, keys).limit(clamp_limit(limit, cap) + 1)


def page(
    df: DataFrame,
    limit: Any = None,
    cursor: Sequence[Any] | None = None,
    select: Sequence[str] | None = None,
    keys: Keyset = KEYSET,
    cap: int = MAX_LIMIT,
) -> DataFrame:
    """The rows of one page. Sort keys that are not selected stay hidden."""
    public = list(select or df.columns)
    internal = list(dict.fromkeys([*public, *key_names(keys)]))
    rows = after(df, cursor, keys) if cursor else df
    size = clamp_limit(limit, cap)
    return keyset_order(rows.select(*internal), keys).limit(size).select(*public)


def page_summary(
    df: DataFrame,
    limit: Any = None,
    cursor: Sequence[Any] | None = None,
    select: Sequence[str] | None = None,
    keys: Keyset = KEYSET,
    cap: int = MAX_LIMIT,
) -> DataFrame:
    """One row: count, items (JSON array text), next_cursor, has_more.

    The page has at most ``cap`` rows, so gathering it in one row is bounded.
    """
    public = list(select or df.columns)
    size = clamp_limit(limit, cap)
    internal = df.select(*dict.fromkeys([*public, *key_names(keys)]))
    rows = page_with_lookahead(internal, limit, cursor, keys, cap)
    schema = internal.select(*public).schema
    marked = rows.select(
        F.monotonically_increasing_id().alias("_n"),
        item_json(schema).alias("item"),
        cursor_token(internal.schema, key_names(keys)).alias("token"),
    )
    gathered = marked.agg(
        F.array_sort(F.collect_list(F.struct("_n", "item", "token"))).alias("rows")
    )
    kept = F.slice("rows", 1, size)
    has_more = F.size("rows") > size
    return gathered.select(
        F.size(kept).alias("count"),
        F.concat(
            F.lit("["), F.array_join(F.transform(kept, lambda r: r["item"]), ","), F.lit("]")
        ).alias("items"),
        F.when(has_more, F.element_at(kept, -1)["token"]).alias("next_cursor"),
        has_more.alias("has_more"),
    )


def with_cursor(df: DataFrame, keys: Keyset = KEYSET, name: str = "cursor") -> DataFrame:
    """Adds to every row the cursor that continues after it."""
    return df.withColumn(name, cursor_token(df.schema, key_names(keys)))


def items_json(df: DataFrame, name: str = "item") -> DataFrame:
    """Every row as one JSON object."""
    return df.select(item_json(df.schema).alias(name))


def export_pages(
    df: DataFrame, limit: Any = None, keys: Keyset = KEYSET, cap: int = MAX_LIMIT
) -> DataFrame:
    """All pages of a table in one job: ``page_no`` (from 1) and ``row_in_page``.

    The table is range-partitioned by the keys and written sorted; a row's number
    is its place in its slice plus the rows of the slices before. No window and
    no task sees the whole order.
    """
    size = clamp_limit(limit, cap)
    numbered = row_numbers(ordered_slices(df, order_columns(keys), "pages"))
    return (
        numbered.withColumn("page_no", F.expr(f"row_no div {size}") + 1)
        .withColumn("row_in_page", F.col("row_no") % size + 1)
        .drop("row_no")
    )
