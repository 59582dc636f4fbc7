from __future__ import annotations

from datetime import datetime

from millrace.operators import windows


def readings(spark, rows):
    columns = "device_id string, location string, event_timestamp string, temperature_celsius double, vibration_hz double"
    df = spark.createDataFrame(rows, columns)
    return df.withColumn("event_timestamp", df.event_timestamp.cast("timestamp"))


ROWS = [
    ("a", "x", "2024-01-01 10:00:00", 20.0, 0.1),
    ("a", "x", "2024-01-01 10:00:29.999999", 41.0, 0.3),
    ("a", "x", "2024-01-01 10:00:30", 39.0, 0.5),
    ("b", "x", "2024-01-01 10:00:10", None, 0.5),
    ("b", "y", "2024-01-01 12:59:59", 40.0, 0.5),
]


def test_windows_are_half_open(spark):
    summary = windows.flatten_window(windows.device_summary(readings(spark, ROWS)))
    got = {
        (r.device_id, r.location, r.window_start.strftime("%H:%M:%S")): (r.avg_temp, r.max_temp, r.reading_count)
        for r in summary.collect()
    }
    assert got == {
        ("a", "x", "10:00:00"): (30.5, 41.0, 2),
        ("a", "x", "10:00:30"): (39.0, 39.0, 1),
        ("b", "x", "10:00:00"): (None, None, 1),
        ("b", "y", "12:59:30"): (40.0, 40.0, 1),
    }


def test_means_with_and_without_weights(spark):
    summary = windows.device_summary(readings(spark, ROWS))
    plain = {r.location: r.avg_temp for r in windows.location_mean(summary).collect()}
    weighted = {r.location: r.avg_temp for r in windows.location_mean_weighted(summary).collect()}
    assert plain["x"] == (30.5 + 39.0) / 2
    assert abs(weighted["x"] - 100.0 / 3) < 1e-9


def test_hot_devices_take_the_threshold_and_the_range_start(spark):
    rows = readings(spark, ROWS)
    for as_of, expected in (
        ("2024-01-01 13:00:00", {("a", datetime(2024, 1, 1, 10)), ("b", datetime(2024, 1, 1, 12, 59, 30))}),
        ("2024-01-01 13:00:01", {("b", datetime(2024, 1, 1, 12, 59, 30))}),
        ("2024-01-01 20:00:00", set()),
    ):
        for hot in (
            windows.hot_devices(windows.device_summary(rows), as_of=as_of),
            windows.hot_devices_from_readings(rows, as_of=as_of),
        ):
            assert {(r.device_id, r.window_start) for r in hot.collect()} == expected
            state = windows.alert_state(hot).first()
            assert (state.alert, state.hot_windows) == (bool(expected), len(expected))


def test_range_reaches_the_scan(spark, tmp_path):
    readings(spark, ROWS).write.parquet(str(tmp_path / "r"))
    stored = spark.read.parquet(str(tmp_path / "r"))
    hot = windows.hot_devices_from_readings(stored, as_of="2024-01-01 13:00:00")
    plan = hot._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(temperature_celsius,40.0)" in plan
    assert "GreaterThanOrEqual(event_timestamp" in plan
    assert "vibration_hz" not in plan


def test_default_range_ends_now(spark):
    rows = spark.sql(
        """SELECT 'a' device_id, 'x' location, current_timestamp() event_timestamp,
                  45.0D temperature_celsius, 0.1D vibration_hz"""
    )
    assert windows.hot_devices(windows.device_summary(rows)).count() == 1
