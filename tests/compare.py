"""Compare a Spark result with DuckDB on the same tables."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    return value


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


# Spark type to the DuckDB types that hold the same values.
TYPES = {
    "bigint": {"BIGINT", "HUGEINT"},
    "int": {"INTEGER"},
    "double": {"DOUBLE", "DECIMAL(2,1)"},
    "string": {"VARCHAR"},
    "boolean": {"BOOLEAN"},
    "timestamp_ntz": {"TIMESTAMP"},
}


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both results are equal as multisets of rows, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = dict(zip(names, (str(d[1]) for d in result.description)))
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    for name, dtype in df.dtypes:
        if types[name] not in TYPES.get(dtype, ()):
            return f"{name}: {dtype} against {types[name]}"
    theirs = _rows(names, result.fetchall())
    ours = _rows(df.columns, df.collect())
    if ours == theirs:
        return None
    return (
        f"{sum(ours.values())} rows against {sum(theirs.values())}; "
        f"only ours {list((ours - theirs).items())[:3]}; only theirs {list((theirs - ours).items())[:3]}"
    )
