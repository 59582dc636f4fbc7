from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import Observation, functions as F

from millrace.operators.quality import expect_or_fail
from millrace.operators.windows import alert_state, hot_devices
from millrace.plans import sensor as pipeline
from millrace.plans.customers import (
    FAIL_RULES,
    current_customers,
    customer_history,
    raw_customers,
    run_customers,
)
from millrace.operators.filters import sql_params
from millrace.streaming.metrics import MetricsRecorder, metrics_table


def batch(folder, name, readings):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as file:
        json.dump(readings, file)


def reading(device, time, temperature, **more):
    return {
        "device_id": device, "timestamp": time, "temperature_celsius": temperature,
        "vibration_hz": 0.3, "location": "Factory Floor A", **more,
    }


def test_pipeline_from_files_to_alert(spark, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "tables")
    recorder = MetricsRecorder()
    spark.streams.addListener(recorder)
    try:
        batch(landing, "1.json", [
            reading("MFG-A-1000", "2025-01-01T12:00:01", 30.0),
            reading("MFG-A-1000", "2025-01-01T12:00:02", 34.0),
            reading(None, "2025-01-01T12:00:03", 31.0),
        ])
        tables = pipeline.run_pipeline(spark, landing, root, recorder=recorder)
        as_of = "2025-01-01 13:00:00"
        hot = hot_devices(pipeline.read_device_summary(spark, tables), as_of=as_of)
        assert alert_state(hot).first().alert is False

        # Offset times, a new column and hot readings.
        batch(landing, "2.json", [
            reading("MFG-B-2000", "2025-01-01T07:30:00-05:00", 45.0, pressure=7),
            reading("MFG-A-1000", "not a time", 29.0),
        ])
        pipeline.run_pipeline(spark, landing, root, recorder=recorder)
    finally:
        spark.streams.removeListener(recorder)

    bronze = pipeline.read_bronze(spark, tables)
    silver, quarantine = pipeline.read_silver(spark, tables), pipeline.read_quarantine(spark, tables)
    assert (bronze.count(), silver.count(), quarantine.count()) == (5, 3, 2)
    assert "pressure" in bronze.columns and "pressure" not in silver.columns
    failed = sorted(rule for row in quarantine.collect() for rule in row.failed_rules)
    assert failed == ["valid_device_id", "valid_event_time"]
    hot = hot_devices(pipeline.read_device_summary(spark, tables), as_of=as_of)
    assert [(r.device_id, str(r.window_start)) for r in hot.collect()] == [("MFG-B-2000", "2025-01-01 12:30:00")]
    assert alert_state(hot).first().alert is True

    counts = {
        (r.table_name, r.metric): r.n
        for r in metrics_table(spark, tables.metrics)
        .groupBy("table_name", "metric").agg(F.sum("value").alias("n")).collect()
    }
    assert counts[("bronze", "rows_in")] == 5
    assert counts[("silver_drop", "failed__valid_device_id")] == 1
    assert counts[("silver_drop", "failed__valid_event_time")] == 1
    assert counts[("quarantine", "rows_in")] == 2
    assert counts[("silver", "failed__warn_on_high_temp")] == 1

    assert counts[("summary", "rows_in")] == 3
    assert [(r.device_id, r.max_temp) for r in pipeline.read_hot(spark, tables).collect()] == [("MFG-B-2000", 45.0)]

    rebuilt = pipeline.run_pipeline(spark, landing, root, full_refresh=True)
    # Metrics are recorded without a recorder of the caller's as well.
    again = {r.table_name for r in metrics_table(spark, rebuilt.metrics).collect()}
    assert {"bronze", "silver", "silver_drop", "quarantine", "summary"} <= again
    assert rebuilt.root != tables.root and pipeline.current_tables(spark, root) == rebuilt
    one, two = (
        pipeline.read_device_summary(spark, t).select("device_id", "window.start", "avg_temp", "reading_count")
        for t in (tables, rebuilt)
    )
    assert sorted(one.collect(), key=str) == sorted(two.collect(), key=str)
    again = pipeline.run_pipeline(spark, landing, root)
    assert again == rebuilt and pipeline.read_silver(spark, again).count() == 3


def test_pipeline_without_files(spark, tmp_path):
    os.makedirs(tmp_path / "landing")
    for _ in range(2):
        tables = pipeline.run_pipeline(spark, str(tmp_path / "landing"), str(tmp_path / "tables"))
    assert pipeline.read_bronze(spark, tables).count() == 0
    assert pipeline.read_silver(spark, tables).count() == 0
    assert pipeline.read_quarantine(spark, tables).count() == 0
    assert pipeline.read_device_summary(spark, tables).count() == 0


def test_bounded_batches_give_the_same_tables(spark, tmp_path):
    landing = str(tmp_path / "landing")
    for i in range(5):
        batch(landing, f"{i}.json", [reading(f"d{i % 2}", f"2025-01-01T12:00:{i:02}", 20.0 + i, **{f"n{i}": i})])
    tables = pipeline.run_pipeline(spark, landing, str(tmp_path / "tables"), maxFilesPerTrigger="2")
    summary = pipeline.read_device_summary(spark, tables)
    assert sorted((r.device_id, r.avg_temp, r.reading_count) for r in summary.collect()) == [
        ("d0", 22.0, 3), ("d1", 22.0, 2),
    ]
    assert {f"n{i}" for i in range(5)} <= set(pipeline.read_bronze(spark, tables).columns)


def test_customer_tables(spark):
    raw = raw_customers(spark, rows=500)
    changed = raw.where("customer_id < 20").withColumns(
        {
            "email": F.when(F.col("customer_id") >= 5, "new@x.org"),
            "_created_instant": F.col("_created_instant") + F.expr("INTERVAL 1 DAY"),
        }
    )
    log = raw.unionByName(changed).unionByName(raw.where("customer_id < 3")).withColumn(
        "customer_id", F.when(F.col("customer_id") != 499, F.col("customer_id"))
    )
    history = customer_history(log)
    assert history.columns == ["customer_id", "name", "email", "ip_addr", "phone", "__START_AT", "__END_AT"]
    assert history.count() == 499 + 20
    current = current_customers(history)
    assert current.count() == 499 and "modified_ts" in current.columns
    assert current.where("email IS NULL").count() == 5
    assert customer_history(log, hot_rows=1).count() == 519


def test_customer_pipeline_adds_what_is_new(spark, tmp_path):
    root, landing = str(tmp_path / "tables"), str(tmp_path / "in")
    schema = "customer_id bigint, name string, email string, changed timestamp"
    schema = spark.createDataFrame([], schema).schema
    days = "2024-01-0{} 00:00:00"
    for number, rows in enumerate((
        [(1, "a", "a@x", 1), (2, "b", None, 1)], [(1, "a", "b@x", 3)], [(1, "z", "z@x", 2), (3, "c", "c@x", 1)], [],
    )):
        batch_rows = spark.createDataFrame([(*r[:3], days.format(r[3])) for r in rows], "customer_id bigint, name string, email string, changed string")
        batch_rows.withColumn("changed", F.col("changed").cast("timestamp")).coalesce(1).write.mode("append").parquet(landing)
        arriving = spark.readStream.schema(schema).parquet(landing)
        tables = run_customers(spark, arriving, root, "changed", except_columns=["changed"])
    served = sorted((r.customer_id, r.name, r.email, r.modified_ts.day) for r in spark.read.parquet(tables.served).collect())
    assert served == [(1, "a", "b@x", 3), (2, "b", None, 1), (3, "c", "c@x", 1)]
    last = metrics_table(spark, tables.metrics).where("table_name = 'current_customers' AND metric = 'failed__valid_email'")
    assert {r.value for r in last.collect()} == {1}


def test_sql_params_leave_a_view_of_the_caller_alone(spark):
    spark.range(3).createOrReplaceTempView("mine")
    try:
        with pytest.raises(Exception, match="mine"):
            sql_params(spark, "SELECT * FROM mine", {}, mine=spark.range(5))
        assert spark.table("mine").count() == 3
    finally:
        spark.catalog.dropTempView("mine")


def test_missing_customer_id_stops_the_load(spark):
    bad = raw_customers(spark, 5).withColumn("customer_id", F.lit(None).cast("long"))
    with pytest.raises(Exception, match="expectation failed: null_id"):
        expect_or_fail(bad, FAIL_RULES, Observation("bad_customers")).collect()
