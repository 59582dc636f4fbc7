from __future__ import annotations

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators.cdc import scd2
from millrace.operators.windows import device_summary
from millrace.sources.tables import (
    live_parts,
    read_stream_table,
    read_versioned,
    write_stream_table,
    write_version,
)
from millrace.streaming import alerts, late
from millrace.streaming.metrics import MetricsRecorder, metrics_table, recorded
from millrace.streaming.history import read_history, scd2_stream
from millrace.streaming import summary as summaries
from millrace.streaming.summary import (
    device_summary_stream,
    read_alerts,
    read_summary,
    write_alerts,
    write_summary_complete,
)

READINGS = "device_id string, location string, event_timestamp timestamp, temperature_celsius double, vibration_hz double"
BASE = datetime(2024, 1, 1, 10)


def at(seconds, device="a", temperature=20.0):
    return (device, "x", BASE + timedelta(seconds=seconds), temperature, 0.5)


class Feed:
    """A folder that grows file by file, and its stream."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema = spark, path, spark.createDataFrame([], schema).schema

    def add(self, rows):
        df = self.spark.createDataFrame(rows, self.schema)
        df.coalesce(1).write.mode("append").parquet(self.path)

    def stream(self, **options):
        return read_stream_table(self.spark, self.path, self.schema, **options)


def windows(df):
    return sorted(
        (r.device_id, r.window.start.strftime("%H:%M:%S"), r.avg_temp, r.reading_count) for r in df.collect()
    )


def test_append_drops_late_rows_and_emits_closed_windows_once(spark, tmp_path):
    feed = Feed(spark, str(tmp_path / "in"), READINGS)
    for rows in ([at(0), at(10)], [at(600)], [at(5, temperature=99.0), at(610)], [at(1200)]):
        feed.add(rows)
        write_stream_table(
            device_summary_stream(feed.stream(), "2 minutes"),
            str(tmp_path / "out"), str(tmp_path / "checkpoint"),
        )
    assert windows(spark.read.parquet(str(tmp_path / "out"))) == [
        ("a", "10:00:00", 20.0, 2),
        ("a", "10:10:00", 20.0, 2),
    ]


def test_complete_counts_late_rows_and_equals_batch(spark, tmp_path):
    feed = Feed(spark, str(tmp_path / "in"), READINGS)
    path, schema = str(tmp_path / "out"), None
    for rows in ([at(0), at(10)], [at(600)], [at(5, temperature=99.0)]):
        feed.add(rows)
        summary = device_summary_stream(feed.stream())
        schema = summary.schema
        write_summary_complete(summary, path, str(tmp_path / "checkpoint"))
    batch = device_summary(spark.read.parquet(feed.path))
    assert windows(read_summary(spark, path, schema)) == windows(batch)
    assert live_parts(spark, path) == {0: 2}


def test_partial_summaries_equal_batch(spark, tmp_path):
    feed = Feed(spark, str(tmp_path / "in"), READINGS)
    path, schema = str(tmp_path / "out"), None
    for rows in (
        [at(0), at(10), at(10, "b", None)],
        [at(600, temperature=-5.0)],
        [at(5, temperature=99.0)],
        [at(601), at(11, "b", None)],
        [at(20, "b", 1.0)],
    ):
        feed.add(rows)
        summaries.write_summary_partials(feed.stream(), path, str(tmp_path / "checkpoint"))
        schema = summaries.partial_summary(feed.stream()).schema
    order = ["device_id", "window"]
    batch = device_summary(spark.read.parquet(feed.path)).orderBy(order).collect()
    assert summaries.read_summary_partials(spark, path, schema).orderBy(order).collect() == batch
    # Parts of like size became one, so fewer are left than there were batches.
    assert len(live_parts(spark, path)) < 5


@pytest.mark.parametrize("sizes", [[1] * 200, [1, 9, 2] * 67, list(range(1, 201)), list(range(200, 0, -1)), [1000] + [1] * 199])
def test_parts_merge_by_levels(sizes):
    live, written, bound = {}, 0, sum(sizes).bit_length()
    for batch, size in enumerate(sizes):
        group = summaries.parts_to_merge(live)
        if group:
            live[group[0]] = sum(live.pop(part) for part in group)
            written += live[group[0]]
        live[batch] = size
        written += size
        assert len(live) <= bound + 2
    assert sum(live.values()) == sum(sizes) and written <= sum(sizes) * (2 * bound + 2)


def test_late_rows_go_to_their_own_table(spark, tmp_path):
    feed, path = Feed(spark, str(tmp_path / "in"), READINGS), str(tmp_path / "out")
    stream = spark.createDataFrame([], READINGS)
    no_time = ("a", "x", None, 1.0, 0.5)
    for rows in ([], [at(0), no_time], [at(600)], [at(5), at(480), at(479), at(610)], [at(600), no_time]):
        feed.add(rows)
        late.write_closing_summary(feed.stream(), path, str(tmp_path / "checkpoint"))
    assert [r.event_timestamp for r in late.read_late(spark, path, stream.schema).orderBy("event_timestamp").collect()] == [
        None, None, BASE + timedelta(seconds=5), BASE + timedelta(seconds=479)
    ]
    schema = summaries.partial_summary(stream).schema
    found = late.read_closing_summary(spark, path, schema).orderBy("window").collect()
    assert [((r.window.start - BASE).seconds, r.reading_count, r.closed) for r in found] == [
        (0, 1, True), (480, 1, False), (600, 3, False)
    ]


def test_a_batch_that_died_before_its_mark(spark, tmp_path):
    feed, path = Feed(spark, str(tmp_path / "in"), READINGS), str(tmp_path / "out")
    feed.add([at(0), at(600)])
    late.write_closing_summary(feed.stream(), path, str(tmp_path / "checkpoint"))
    # The same batch again, without its mark: a new checkpoint over the same output.
    os.rename(f"{path}/marks", str(tmp_path / "marks_before"))
    late.write_closing_summary(feed.stream(), path, str(tmp_path / "again"))
    schema = summaries.partial_summary(feed.stream()).schema
    found = late.read_closing_summary(spark, path, schema).orderBy("window").collect()
    assert [(r.reading_count, r.closed) for r in found] == [(1, True), (1, False)]


def test_late_rows_of_a_new_table(spark, tmp_path):
    readings = spark.createDataFrame([], READINGS)
    schema = summaries.partial_summary(readings).schema
    assert late.read_late(spark, str(tmp_path), readings.schema).count() == 0
    assert late.read_closing_summary(spark, str(tmp_path), schema).count() == 0


def test_alerts_keep_the_newest_maximum(spark, tmp_path):
    feed = Feed(spark, str(tmp_path / "in"), READINGS)
    for rows in ([at(0, temperature=39.0)], [at(1, temperature=41.0)], [at(2, temperature=43.0), at(-9000, "old", 50.0)]):
        feed.add(rows)
        write_alerts(
            device_summary_stream(feed.stream()), str(tmp_path / "alerts"), str(tmp_path / "checkpoint"),
            threshold=40.0, hours=2, as_of="2024-01-01 11:00:00",
        )
    assert [(r.device_id, r.max_temp) for r in read_alerts(spark, str(tmp_path / "alerts")).collect()] == [("a", 43.0)]


def test_alerts_clear_when_their_window_is_old(spark, tmp_path):
    feed, path = Feed(spark, str(tmp_path / "in"), READINGS), str(tmp_path / "alerts")
    seen = []
    for rows, as_of in (
        ([at(0, temperature=39.0)], "2024-01-01 11:00:00"),
        ([at(1, temperature=41.0)], "2024-01-01 11:00:00"),
        ([at(2, temperature=20.0)], "2024-01-03 11:00:00"),
    ):
        feed.add(rows)
        write_alerts(
            device_summary_stream(feed.stream()), path, str(tmp_path / "checkpoint"),
            threshold=40.0, hours=2, as_of=as_of,
        )
        seen.append(read_alerts(spark, path, 2, as_of).count() > 0)
    assert seen == [False, True, False]


def test_alert_intervals_fire_clear_and_take_late_windows(spark, tmp_path):
    feed, path = Feed(spark, str(tmp_path / "in"), READINGS), str(tmp_path / "hot")
    states = []
    for rows in (
        [at(0, temperature=39.0)],
        [at(1, temperature=41.0), at(2, temperature=43.0), at(5, temperature=20.0)],
        [at(9000, temperature=40.0), at(40_000, "b", 50.0)],
        [at(7200, temperature=45.0)],  # late: joins the windows before and after it
        [at(7200, temperature=44.0), at(30_000, temperature=41.0)],
    ):
        feed.add(rows)
        alerts.start_hot_windows(feed.stream(), path, str(tmp_path / "checkpoint")).awaitTermination()
        hot = alerts.read_hot_windows(spark, path, alerts.hot_windows(feed.stream()).schema)
        found = alerts.alert_intervals(hot, hours=2)
        states.append(sorted(
            (r.device_id, (r.fired_at - BASE).total_seconds(), (r.cleared_at - BASE).total_seconds(), r.max_temp, r.hot_windows)
            for r in found.collect()
        ))
    assert states[0] == []
    assert states[1] == [("a", 0, 7200, 43.0, 1)]
    assert states[2] == [("a", 0, 7200, 43.0, 1), ("a", 9000, 16200, 40.0, 1), ("b", 39_990, 47_190, 50.0, 1)]
    assert states[3] == [("a", 0, 16200, 45.0, 3), ("b", 39_990, 47_190, 50.0, 1)]
    assert states[4][:2] == [("a", 0, 16200, 45.0, 3), ("a", 30_000, 37_200, 41.0, 1)]
    up = [alerts.alerts_at(found, f"2024-01-01 {time}").count() for time in ("09:59:59", "10:00:00", "14:30:00", "14:30:01", "23:30:00")]
    assert up == [0, 1, 1, 0, 0]
    # No state: what is stored are the hot windows of each batch.
    assert spark.read.parquet(path).count() == 6 and not (tmp_path / "checkpoint" / "state").exists()


def test_state_and_late_rows_are_recorded(spark, tmp_path):
    feed, path = Feed(spark, str(tmp_path / "in"), READINGS), str(tmp_path / "metrics")
    for rows in ([at(0), at(10)], [at(600)], [at(5, temperature=99.0), at(610)]):
        feed.add(rows)
        with recorded(spark, None) as recorder:
            query = write_stream_table(
                device_summary_stream(feed.stream(), "2 minutes"), str(tmp_path / "out"), str(tmp_path / "c"), name="gold",
            )
            recorder.flush(spark, path, query)
    totals = {(r.table_name, r.metric): r.n for r in metrics_table(spark, path).groupBy("table_name", "metric").agg(F.sum("value").alias("n")).collect()}
    assert totals[("gold_state_0", "late_rows")] == 1 and ("gold_state_0", "rows") in totals


def test_a_missing_end_event_marks_the_run(spark, tmp_path, monkeypatch):
    recorder = MetricsRecorder()
    query = type("Query", (), {"runId": "r", "id": "i", "name": "lost"})()
    monkeypatch.setattr(recorder, "_end_of", lambda run_id: type("Event", (), {"wait": lambda self, timeout: False})())
    recorder.add("table", {"rows_in": 3})
    recorder.flush(spark, str(tmp_path / "m"), query)
    rows = {(r.run_id, r.table_name, r.metric, r.value) for r in metrics_table(spark, str(tmp_path / "m")).collect()}
    assert rows == {("batch", "table", "rows_in", 3), ("r", "lost", "end_event_missing", 1)}


@pytest.mark.parametrize("empty", [0, 1, 3])
def test_partials_take_a_batch_without_valid_rows(spark, tmp_path, empty):
    feed, path = Feed(spark, str(tmp_path / "in"), READINGS), str(tmp_path / "summary")
    for number in range(5):
        row = at(number)
        feed.add([(row[0], row[1], None, *row[3:]) if number == empty else row])
        readings = feed.stream().where("event_timestamp IS NOT NULL")
        summaries.write_summary_partials(readings, path, str(tmp_path / "checkpoint"))
        schema = summaries.partial_summary(readings).schema
        found = summaries.read_summary_partials(spark, path, schema)
        assert (found.agg(F.sum("reading_count")).first()[0] or 0) == number + 1 - (number >= empty)


def test_complete_takes_no_rows(spark, tmp_path):
    feed, path = Feed(spark, str(tmp_path / "in"), READINGS), str(tmp_path / "summary")
    feed.add([at(0)])
    summary = device_summary_stream(feed.stream().where("device_id IS NULL"))
    summaries.write_summary_complete(summary, path, str(tmp_path / "checkpoint"))
    assert summaries.read_summary(spark, path, summary.schema).count() == 0


def test_history_keeps_user_columns_of_any_name(spark, tmp_path):
    names = ["part", "batch_id", "version", "key", "row", "until", "hash", "_next", "_values", "a.b"]
    schema = "id int, at int, " + ", ".join(f"`{n}` int" for n in names)
    feed, target = Feed(spark, str(tmp_path / "in"), schema), str(tmp_path / "t")
    feed.add([(1, 1, *range(10)), (1, 2, *range(10, 20))])
    scd2_stream(feed.stream(), target, str(tmp_path / "c"), ["id"], "at", except_columns=["at"])
    found = read_history(spark, target)
    assert found.columns == ["id", *names, "__START_AT", "__END_AT"]
    assert sorted(map(tuple, found.collect()), key=str) == [(1, *range(10), 1, 2), (1, *range(10, 20), 2, None)]
    changes = spark.readStream.schema("id int, at int, __END_AT string").parquet(str(tmp_path))
    with pytest.raises(ValueError, match="__END_AT"):
        scd2_stream(changes, str(tmp_path / "u"), str(tmp_path / "d"), ["id"], "at")


def test_history_refuses_other_options(spark, tmp_path):
    feed, target = Feed(spark, str(tmp_path / "in"), LOG), str(tmp_path / "t")
    feed.add([(1, 1, 0, "x")])
    scd2_stream(feed.stream(), target, str(tmp_path / "c"), **OPTIONS)
    with pytest.raises(ValueError, match="other options"):
        scd2_stream(feed.stream(), target, str(tmp_path / "c"), coalesce_unchanged=False, **OPTIONS)
    with pytest.raises(ValueError, match="no history"):
        read_history(spark, str(tmp_path / "nowhere"))


def test_a_batch_writes_its_own_changes_only(spark, tmp_path):
    """In order or late, a batch of k changes adds k rows, whatever the table holds."""
    feed, target = Feed(spark, str(tmp_path / "in"), LOG), str(tmp_path / "t")
    total, files = 0, set()
    for number, (k, start) in enumerate([(200, 0), (5, 1000), (7, 500), (3, 2000)]):
        feed.add([(i % 4, start + i, 0, f"{number}-{i}") for i in range(k)] + [(None, 1, 0, "x")])
        query = scd2_stream(feed.stream(), target, str(tmp_path / "c"), **OPTIONS)
        log = spark.read.parquet(f"{target}/log")
        new = log.where(~F.input_file_name().isin(list(files) or [""]))
        assert new.count() == k
        files |= {r[0] for r in log.select(F.input_file_name()).distinct().collect()}
        total += k
        assert read_history(spark, target).count() == total
        counted = [p.observedMetrics["history"] for p in query.recentProgress if p.numInputRows]
        assert [(m["rows_in"], m["dropped__no_key"]) for m in counted] == [(k + 1, 1)]


LOG = "id int, at int, tie int, a string"
OPTIONS = dict(keys=["id"], sequence_by="at", tie_breakers=["tie"], except_columns=["at", "tie"])


def history(spark, feed, target):
    return read_history(spark, target)


@pytest.mark.parametrize("coalesce, step", [(True, 0), (True, 30), (False, 30)])
def test_incremental_history_equals_rebuild(spark, tmp_path, coalesce, step):
    """Batches in any order of their sequence values, or (with a step) mostly in order."""
    rnd = random.Random(9)
    feed, target = Feed(spark, str(tmp_path / "in"), LOG), str(tmp_path / "table")
    everything = []
    for number, keys in enumerate((range(8), range(3), [5, 11], range(8))):
        rows = [
            (rnd.choice(list(keys)), step * number + rnd.randrange(50), i, rnd.choice("xyz"))
            for i in range(120)
        ]
        rows.append((None, 1, 0, "x"))
        everything += rows
        feed.add(rows)
        scd2_stream(
            feed.stream(), target, str(tmp_path / "checkpoint"), coalesce_unchanged=coalesce, **OPTIONS
        )
        rebuilt = scd2(spark.createDataFrame(everything, LOG), coalesce_unchanged=coalesce, **OPTIONS)
        assert sorted(history(spark, feed, target).collect(), key=str) == sorted(rebuilt.collect(), key=str)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_incremental_history_by_time(spark, tmp_path, kind):
    """Sequence values around the hour that repeats when daylight saving ends."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        schema = f"id int, at {kind}, tie int, a string"
        feed, target = Feed(spark, str(tmp_path / "in"), schema), str(tmp_path / "table")
        hours = [5, 7, 6, 4] if kind != "date" else [24, 72, 48, 0]
        everything = None
        for i, hour in enumerate(hours):
            at = F.timestamp_seconds(F.lit(1762041600 + hour * 3600 + 1800)).cast(kind)
            rows = spark.range(3).select(
                F.col("id").cast("int").alias("id"), at.alias("at"), F.lit(0).alias("tie"), F.lit(f"v{i}").alias("a")
            )
            rows.coalesce(1).write.mode("append").parquet(feed.path)
            everything = rows if everything is None else everything.unionByName(rows)
            scd2_stream(feed.stream(), target, str(tmp_path / "checkpoint"), **OPTIONS)
        rebuilt, found = scd2(everything, **OPTIONS), history(spark, feed, target)
        assert found.exceptAll(rebuilt).isEmpty() and rebuilt.exceptAll(found).isEmpty()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_change_without_sequence_stops_the_stream(spark, tmp_path):
    feed = Feed(spark, str(tmp_path / "in"), LOG)
    feed.add([(1, None, 0, "x")])
    with pytest.raises(Exception, match="without a sequence value"):
        scd2_stream(feed.stream(), str(tmp_path / "t"), str(tmp_path / "c"), **OPTIONS)


def test_batch_that_died_before_its_commit_runs_again(spark, tmp_path):
    feed, target = Feed(spark, str(tmp_path / "in"), LOG), str(tmp_path / "table")
    feed.add([(1, 1, 0, "x"), (2, 1, 0, "x")])
    scd2_stream(feed.stream(), target, str(tmp_path / "checkpoint"), **OPTIONS)
    before = sorted(history(spark, feed, target).collect())
    # Rows that a batch wrote without a commit stay invisible.
    junk = spark.createDataFrame([(7, 1, 0, "junk")], feed.schema)
    junk.write.mode("append").parquet(f"{target}/log")
    assert sorted(history(spark, feed, target).collect()) == before
    feed.add([(1, 5, 0, "y")])
    scd2_stream(feed.stream(), target, str(tmp_path / "checkpoint"), **OPTIONS)
    assert sorted(map(tuple, history(spark, feed, target).collect()), key=str) == sorted(
        [(1, "x", 1, 5), (1, "y", 5, None), (2, "x", 1, None)], key=str
    )


def test_committed_batch_is_not_applied_again(spark, tmp_path):
    """A lost commit of the stream repeats the batch; the table stays the same."""
    feed, target, checkpoint = Feed(spark, str(tmp_path / "in"), LOG), str(tmp_path / "t"), tmp_path / "checkpoint"
    feed.add([(1, 1, 0, "x"), (2, 1, 0, "x")])
    scd2_stream(feed.stream(), target, str(checkpoint), **OPTIONS)
    before = sorted(history(spark, feed, target).collect())
    for name in ("0", ".0.crc"):
        if (checkpoint / "commits" / name).exists():
            os.remove(checkpoint / "commits" / name)
    scd2_stream(feed.stream(), target, str(checkpoint), **OPTIONS)
    assert sorted(history(spark, feed, target).collect()) == before


def test_only_touched_parts_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(10).withColumn("part", (F.col("id") % 2).cast("int"))
    write_version(rows, path, 0, [0, 1], {})
    write_version(rows.where("part = 1 AND id < 5"), path, 1, [1], live_parts(spark, path))
    assert live_parts(spark, path) == {0: 0, 1: 1}
    ids = sorted(r.id for r in read_versioned(spark, path, rows.schema).collect())
    assert ids == [0, 1, 2, 3, 4, 6, 8]
    plan = read_versioned(spark, path, rows.schema, {1: 1})
    assert all("version=1/part=1" in f for f in plan.inputFiles()) or plan.count() == 2
