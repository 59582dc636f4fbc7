"""Optional request filters and the allowlisted projection."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# What a request may select, and what it gets by default.
ALLOWED_COLUMNS = ("customer_id", "name", "email", "ip_addr", "phone", "modified_ts")
DEFAULT_COLUMNS = ("customer_id", "name", "email")


def parse_select(
    select_csv: str | None,
    allowed: Sequence[str] = ALLOWED_COLUMNS,
    default: Sequence[str] = DEFAULT_COLUMNS,
) -> list[str]:
    """Known names of the list, each once; the default when none is left."""
    asked = [name.strip() for name in (select_csv or "").split(",")]
    return list(dict.fromkeys(name for name in asked if name in allowed)) or list(default)


def project(
    df: DataFrame,
    select_csv: str | None,
    allowed: Sequence[str] = ALLOWED_COLUMNS,
    default: Sequence[str] = DEFAULT_COLUMNS,
) -> DataFrame:
    return df.select(*parse_select(select_csv, allowed, default))


def filter_exact(column: str, value: str) -> Column:
    return F.col(column) == F.lit(str(value))


def filter_id(column: str, value: Any) -> Column:
    return F.col(column) == F.lit(int(value)).cast("bigint")


def filter_ci(column: str, value: str) -> Column:
    """Equality without regard to case."""
    return F.lower(column) == F.lower(F.lit(str(value)))


def filter_contains(column: str, needle: str) -> Column:
    """Substring without regard to case; ``%`` and ``_`` are plain characters."""
    return F.contains(F.lower(column), F.lower(F.lit(str(needle))))


def filter_between(df: DataFrame, column: str, start: Any = None, end: Any = None) -> Column:
    """Half-open range ``[start, end)``.

    The bounds take the type of the column, so the comparison reaches the scan.
    """
    dtype = df.schema[column].dataType
    condition = F.lit(True)
    if start is not None:
        condition = condition & (F.col(column) >= F.lit(start).cast(dtype))
    if end is not None:
        condition = condition & (F.col(column) < F.lit(end).cast(dtype))
    return condition


FILTER_NAMES = (
    "email",
    "name",
    "name_contains",
    "customer_id",
    "ip_addr",
    "phone",
    "modified_from",
    "modified_to",
)


def parse_filters(filters: str | Mapping[str, Any] | None, lenient: bool = False) -> dict[str, Any]:
    """The given filters of a request; empty values mean "not given".

    Text that is no JSON object and unknown names raise. With ``lenient`` the
    former means no filter and the latter are ignored.
    """
    if not filters:
        return {}
    if isinstance(filters, str):
        try:
            filters = json.loads(filters)
        except ValueError:
            if lenient:
                return {}
            raise
    if not isinstance(filters, Mapping):
        if lenient:
            return {}
        raise ValueError("filters must be a JSON object")
    unknown = sorted(set(filters) - set(FILTER_NAMES))
    if unknown and not lenient:
        raise ValueError(f"unknown filters: {', '.join(unknown)}")
    given = {k: v for k, v in filters.items() if k in FILTER_NAMES and v not in (None, "")}
    if "customer_id" in given:
        given["customer_id"] = int(given["customer_id"])
    return given


def apply_filters(
    df: DataFrame, filters: str | Mapping[str, Any] | None, lenient: bool = False
) -> DataFrame:
    """The rows that meet every given filter."""
    given = parse_filters(filters, lenient)
    builders = {
        "email": lambda v: filter_ci("email", v),
        "name": lambda v: filter_exact("name", v),
        "name_contains": lambda v: filter_contains("name", v),
        "customer_id": lambda v: filter_id("customer_id", v),
        "ip_addr": lambda v: filter_exact("ip_addr", v),
        "phone": lambda v: filter_exact("phone", v),
        "modified_from": lambda v: filter_between(df, "modified_ts", start=str(v)),
        "modified_to": lambda v: filter_between(df, "modified_ts", end=str(v)),
    }
    conditions = [build(given[name]) for name, build in builders.items() if name in given]
    return df.where(reduce(Column.__and__, conditions)) if conditions else df


def sql_params(
    spark: SparkSession, query: str, params: Mapping[str, Any], **tables: DataFrame
) -> DataFrame:
    """SQL text with named parameters (``:name``, ``IDENTIFIER(:name)``, ``LIMIT :n``).

    Parameters are never pasted into the text. ``tables`` are registered as
    temporary views under their names while the text is analysed, and dropped again. A
    view of the caller's with such a name is an error, and stays.
    """
    registered = []
    try:
        for name, table in tables.items():
            table.createTempView(name)
            registered.append(name)
        return spark.sql(query, args=dict(params))
    finally:
        for name in registered:
            spark.catalog.dropTempView(name)
