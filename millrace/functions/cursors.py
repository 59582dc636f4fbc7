"""Page cursors: URL-safe base64 of ``{"after":[key, key, ...]}``."""

from __future__ import annotations

import base64
import json
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType, StringType, StructType

from millrace.functions.times import is_timestamp, iso_text


def _json_value(name: str, dtype: DataType) -> Column:
    column = F.col(name)
    if is_timestamp(dtype):
        return F.concat(F.lit('"'), iso_text(column, dtype), F.lit('"'))
    if isinstance(dtype, StringType):
        quoted = F.to_json(F.array(column))
        return F.substring(quoted, F.lit(2), F.length(quoted) - 2)
    return column.cast("string")


def cursor_token(schema: StructType, keys: Sequence[str]) -> Column:
    """The cursor that continues after a row, as a column of that row."""
    values = F.concat_ws(",", *[_json_value(key, schema[key].dataType) for key in keys])
    text = F.concat(F.lit('{"after":['), values, F.lit("]}"))
    return F.translate(F.base64(text.cast("binary")), "+/", "-_")


def parse_cursor(token: Column, dtypes: Sequence[DataType]) -> Column:
    """The key values of a token column as a struct ``k0, k1, ...``.

    Tokens with and without padding are accepted.
    """
    standard = F.translate(F.rtrim(token, F.lit("=")), "-_", "+/")
    padded = F.rpad(standard, (F.ceil(F.length(standard) / F.lit(4)) * 4).cast("int"), F.lit("="))
    text = F.unbase64(padded).cast("string")
    values = F.from_json(text, "after array<string>")["after"]

    def typed(parsed: Column) -> Column:
        return F.struct(*[parsed[i].cast(dtype).alias(f"k{i}") for i, dtype in enumerate(dtypes)])

    # A lambda's argument is computed once, however many keys are taken from it.
    return F.transform(F.array(values), typed)[0]


def decode_cursor(token: str | None, lenient: bool = False) -> list[Any] | None:
    """The key values of one token, for a single page request.

    A token that cannot be read raises; with ``lenient`` it means the first page.
    """
    if not token:
        return None
    try:
        padded = token + "=" * (-len(token) % 4)
        values = json.loads(base64.b64decode(padded, altchars=b"-_", validate=True))["after"]
        if not isinstance(values, list):
            raise ValueError("no key list")
        return values or None
    except Exception as error:
        if lenient:
            return None
        raise ValueError(f"unreadable cursor: {token!r}") from error
