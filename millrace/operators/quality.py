"""Expectations on a DataFrame: warn, drop, fail, quarantine.

The counters are ``observe`` metrics, so they cost no extra pass, and work on
batch and streaming frames alike. On a batch frame pass an ``Observation`` and
read it after an action; on a stream pass a name and read the query progress.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from millrace.functions.rules import Rules, all_hold, failed_names, failures, holds

FAILED_PREFIX = "failed__"


def _observe(df: DataFrame, rules: Rules, metrics: Observation | str) -> DataFrame:
    counters = [failures(rule).alias(FAILED_PREFIX + name) for name, rule in rules.items()]
    kept = F.count_if(all_hold(rules)).alias("rows_passed")
    return df.observe(metrics, F.count(F.lit(1)).alias("rows_in"), kept, *counters)


def expect(df: DataFrame, rules: Rules, metrics: Observation | str) -> DataFrame:
    """Warn: keep every row and count the failures per rule."""
    return _observe(df, rules, metrics)


def expect_or_drop(df: DataFrame, rules: Rules, metrics: Observation | str) -> DataFrame:
    """Drop the rows that fail any rule, and count the failures per rule."""
    return _observe(df, rules, metrics).where(all_hold(rules))


expect_all_or_drop = expect_or_drop


def expect_or_fail(df: DataFrame, rules: Rules, metrics: Observation | str) -> DataFrame:
    """Stop the job on the first row that fails a rule.

    The metrics node above the check keeps later filters from moving below it,
    where they could remove a bad row before it is seen.
    """
    checked = df
    for name, rule in rules.items():
        error = F.raise_error(F.lit(f"expectation failed: {name}"))
        checked = checked.where(F.when(holds(rule), F.lit(True)).otherwise(error.cast("boolean")))
    return checked.observe(metrics, F.count(F.lit(1)).alias("rows_in"))


def split_quarantine(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """The rows that pass every rule, and the rest with the names of failed rules."""
    failed = ~F.coalesce(all_hold(rules), F.lit(False))
    return df.where(all_hold(rules)), df.where(failed).withColumn("failed_rules", failed_names(rules))


def split_counts(df: DataFrame, rules: Rules) -> DataFrame:
    """Row counts of both sides of ``split_quarantine``, in one pass."""
    side = F.when(all_hold(rules), F.lit("silver")).otherwise(F.lit("quarantine"))
    return df.groupBy(side.alias("target")).agg(F.count(F.lit(1)).alias("row_count"))


def rule_counts(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per rule with its passed and failed rows, in one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[failures(rule).alias(FAILED_PREFIX + name) for name, rule in rules.items()],
    )
    lines = [
        F.struct(
            F.lit(name).alias("rule"),
            (F.col("total") - F.col(FAILED_PREFIX + name)).alias("passed"),
            F.col(FAILED_PREFIX + name).alias("failed"),
        )
        for name in rules
    ]
    return counts.select(F.inline(F.array(*lines)))
