"""Rows as JSON text with plain JSON types only."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DataType,
    DateType,
    DecimalType,
    StructType,
)

from millrace.functions.times import is_timestamp, iso_text


def json_safe(column: Column, dtype: DataType) -> Column:
    """Times as ISO text, decimals as numbers, bytes as text; nested values too."""
    if is_timestamp(dtype):
        return iso_text(column, dtype)
    if isinstance(dtype, DateType):
        return column.cast("string")
    if isinstance(dtype, DecimalType):
        return column.cast("double")
    if isinstance(dtype, BinaryType):
        return F.replace(F.make_valid_utf8(column.cast("string")), F.lit("�"), F.lit(""))
    if isinstance(dtype, ArrayType):
        return F.transform(column, lambda item: json_safe(item, dtype.elementType))
    if isinstance(dtype, StructType):
        fields = [json_safe(column[f.name], f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(column.isNotNull(), F.struct(*fields))
    return column


def item_json(schema: StructType) -> Column:
    """One row as a JSON object; NULL fields stay in it as ``null``."""
    fields = [json_safe(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in schema.fields]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
