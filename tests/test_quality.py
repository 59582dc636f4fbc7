from __future__ import annotations

import pytest
from pyspark.sql import Observation, functions as F

from millrace.operators import quality

RULES = {"has_id": "id IS NOT NULL", "cool": "temp < 40"}


@pytest.fixture(scope="module")
def readings(spark):
    rows = [(1, 20.0), (2, 41.0), (None, 30.0), (3, None), (None, 50.0), (4, 40.0)]
    return spark.createDataFrame(rows, "id int, temp double")


def test_warn_keeps_rows_and_counts_null_as_failed(readings):
    seen = Observation()
    assert quality.expect(readings, RULES, seen).count() == 6
    assert seen.get == {"rows_in": 6, "rows_passed": 1, "failed__has_id": 2, "failed__cool": 4}


def test_drop_removes_rows_and_counts_them(readings):
    seen = Observation()
    kept = quality.expect_or_drop(readings, {"has_id": RULES["has_id"]}, seen).collect()
    assert sorted(r.id for r in kept) == [1, 2, 3, 4]
    assert seen.get["failed__has_id"] == 2


def test_rules_may_be_columns(readings):
    kept = quality.expect_all_or_drop(readings, {"cool": F.col("temp") < 40}, Observation())
    assert kept.count() == 2


def test_fail_stops_on_a_bad_row(readings):
    with pytest.raises(Exception, match="expectation failed: has_id"):
        quality.expect_or_fail(readings, {"has_id": "id IS NOT NULL"}, Observation()).collect()


def test_fail_sees_rows_that_later_filters_remove(readings):
    checked = quality.expect_or_fail(readings, {"has_id": "id IS NOT NULL"}, Observation())
    with pytest.raises(Exception, match="expectation failed: has_id"):
        checked.where("id > 0 AND temp < 25").count()


def test_fail_passes_good_rows(readings):
    good = readings.where("id IS NOT NULL")
    assert quality.expect_or_fail(good, {"has_id": "id IS NOT NULL"}, Observation()).count() == 4


def test_quarantine_is_the_exact_complement(readings):
    good, bad = quality.split_quarantine(readings, RULES)
    assert good.count() + bad.count() == readings.count()
    reasons = {(r.id, r.temp): r.failed_rules for r in bad.collect()}
    assert reasons[(None, 50.0)] == ["has_id", "cool"]
    assert reasons[(3, None)] == ["cool"]
    assert (1, 20.0) not in reasons


def test_rule_counts_add_up(readings):
    for row in quality.rule_counts(readings, RULES).collect():
        assert row.passed + row.failed == 6
    empty = quality.rule_counts(readings.where("false"), RULES).collect()
    assert [(r.passed, r.failed) for r in empty] == [(0, 0), (0, 0)]
