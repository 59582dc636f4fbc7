"""Quality rules as columns. A rule that gives NULL counts as failed."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, functions as F

Rules = Mapping[str, str | Column]


def _condition(rule: str | Column) -> Column:
    return F.expr(rule) if isinstance(rule, str) else rule


def holds(rule: str | Column) -> Column:
    return F.coalesce(_condition(rule), F.lit(False))


def all_hold(rules: Rules) -> Column:
    """TRUE where every rule holds, else FALSE or NULL.

    For ``where`` and ``count_if``, which take NULL as FALSE; without a coalesce
    around it a rule reaches the scan.
    """
    return reduce(Column.__and__, map(_condition, rules.values()), F.lit(True))


def failures(rule: str | Column) -> Column:
    """Aggregate: how many rows fail the rule (0 on no rows)."""
    return F.count_if(~holds(rule))


def failed_names(rules: Rules) -> Column:
    """Array with the names of the rules a row fails."""
    return F.array_compact(
        F.array(*[F.when(~holds(rule), F.lit(name)) for name, rule in rules.items()])
    )
