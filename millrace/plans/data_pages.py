"""Page requests over a served table."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Observation, functions as F

from millrace.functions.cursors import cursor_token, decode_cursor
from millrace.functions.jsonsafe import item_json
from millrace.operators.filters import (
    ALLOWED_COLUMNS,
    DEFAULT_COLUMNS,
    apply_filters,
    parse_select,
)
from millrace.operators.page_directory import write_directory
from millrace.operators.paging import (
    KEYSET,
    MAX_LIMIT,
    clamp_limit,
    key_names,
    order_columns,
    page_summary,
    page_with_lookahead,
)
from millrace.operators.quality import expect_or_fail


@dataclass(frozen=True)
class PageRequest:
    """One page request. ``sort_json`` is accepted and has no effect."""

    select_csv: str | None = None
    filters_json: str | Mapping[str, Any] | None = None
    sort_json: str | None = None
    limit: int | None = None
    cursor: str | None = None


@dataclass(frozen=True)
class PageService:
    """Answers page requests over ``table``, newest rows first.

    ``lenient`` reads an unusable cursor as "first page" and unusable filters as
    "no filter" instead of raising.
    """

    table: DataFrame
    allowed: Sequence[str] = ALLOWED_COLUMNS
    default: Sequence[str] = DEFAULT_COLUMNS
    max_limit: int = MAX_LIMIT
    lenient: bool = False

    def _prepare(self, request: PageRequest) -> tuple[list[str], DataFrame, list[Any] | None]:
        public = parse_select(request.select_csv, self.allowed, self.default)
        rows = apply_filters(self.table, request.filters_json, self.lenient)
        return public, rows, decode_cursor(request.cursor, self.lenient)

    def summary(self, request: PageRequest) -> DataFrame:
        """The answer as a one-row DataFrame."""
        public, rows, cursor = self._prepare(request)
        return page_summary(rows, request.limit, cursor, public, KEYSET, self.max_limit)

    def fetch(self, request: PageRequest) -> dict[str, Any]:
        """The answer as a dict. Only the rows of the page leave the executors."""
        public, rows, cursor = self._prepare(request)
        size = clamp_limit(request.limit, self.max_limit)
        internal = rows.select(*dict.fromkeys([*public, *key_names(KEYSET)]))
        found = (
            page_with_lookahead(internal, request.limit, cursor, KEYSET, self.max_limit)
            .select(
                item_json(internal.select(*public).schema).alias("item"),
                cursor_token(internal.schema, key_names(KEYSET)).alias("token"),
            )
            .collect()
        )
        shown, has_more = found[:size], len(found) > size
        return {
            "count": len(shown),
            "items": [json.loads(row["item"]) for row in shown],
            "next_cursor": shown[-1]["token"] if has_more else None,
            "has_more": has_more,
        }

    def walk(self, request: PageRequest) -> Iterator[dict[str, Any]]:
        """Page after page from ``request`` on, as a client would ask for them.

        For a whole table use ``export_pages``, which is one job.
        """
        while True:
            answer = self.fetch(request)
            yield answer
            if not answer["has_more"]:
                return
            request = PageRequest(
                request.select_csv, request.filters_json, request.sort_json, request.limit,
                answer["next_cursor"],
            )


def write_served(df: DataFrame, path: str) -> None:
    """Store a table for page requests, newest rows first.

    Rows without a sort key could not be reached by any cursor, so they stop the
    write. Range-ordered files have narrow key statistics: a cursor skips most of
    them. A directory of the files lets ``page_at`` and ``all_pages`` find any page.
    """
    names = key_names(KEYSET)
    rules = {f"{name}_given": F.col(name).isNotNull() for name in names}
    checked = expect_or_fail(df, rules, Observation())
    checked.orderBy(*order_columns(KEYSET)).write.mode("overwrite").parquet(path)
    write_directory(df.sparkSession, path, KEYSET)
