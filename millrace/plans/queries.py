"""One query per operator, over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from millrace.functions.cursors import parse_cursor
from millrace.functions.times import parse_event_time
from millrace.operators import cdc, filters, page_directory, paging, quality, windows
from millrace.operators.projections import READING_SCHEMA, to_silver
from millrace.plans import customers, sensor as pipeline
from millrace.plans.data_pages import PageRequest, PageService, write_served
from millrace.plans.views import (
    EVENT_CUTS,
    ORDER_CUTS,
    arrivals,
    change_log,
    landed,
    order_versions,
    sensor,
    served,
    table,
)
from millrace.session import new_scratch
from millrace.sources import json_arrays
from millrace.sources.audit import with_ingest_meta
from millrace.sources.customers import customer_details
from millrace.sources.json_files import ingest_json
from millrace.sources.tables import read_stream_table, write_stream_table
from millrace.streaming import alerts, late
from millrace.streaming.history import read_history, scd2_stream
from millrace.streaming.metrics import MetricsRecorder, metrics_table
from millrace.streaming.summary import (
    WATERMARK,
    device_summary_stream,
    partial_summary,
    read_alerts,
    read_summary,
    read_summary_partials,
    state_partitions,
    write_alerts,
    write_summary_complete,
    write_summary_partials,
)

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2024-01-30 00:00:00"
RULES = {
    "valid_device_id": "device_id IS NOT NULL",
    "warn_on_high_temp": "temperature_celsius < 40",
}
DROP_RULES = {"valid_device_id": "device_id IS NOT NULL"}
CURSOR = ["1998-10-03 00:00:00", 5000]
SCD2 = dict(
    keys=["customer_id"],
    sequence_by="o_orderdate",
    tie_breakers=["o_orderkey"],
    except_columns=["o_orderdate", "o_orderkey"],
)


def ntz(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz").alias(name)


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sensor(spark, sf_dir).where(quality.all_hold(DROP_RULES))


def rounded_summary(summary: DataFrame) -> DataFrame:
    return windows.flatten_window(summary).select(
        F.col("device_id").cast("bigint").alias("device_id"),
        "location",
        ntz("window_start"),
        ntz("window_end"),
        F.round("avg_temp", 6).alias("avg_temp"),
        "max_temp",
        F.round("avg_vibration", 6).alias("avg_vibration"),
        "reading_count",
    )


def silver_columns(silver: DataFrame) -> DataFrame:
    return silver.select(
        F.col("device_id").cast("bigint").alias("device_id"),
        ntz("event_timestamp"),
        "temperature_celsius",
        "vibration_hz",
        "location",
    )


# Projections and filters ------------------------------------------------------


def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = landed(sensor(spark, sf_dir)).withColumns(
        {"ingestion_timestamp": F.current_timestamp(), "source_file": F.lit("events")}
    )
    return silver_columns(to_silver(raw))


def parse_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = sensor(spark, sf_dir).select("event_id", F.col("event_timestamp").alias("t"))
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    eastern = F.date_format(F.col("t") - F.expr("INTERVAL 5 HOURS"), iso)
    texts = shown.select(
        "event_id",
        F.date_format("t", iso).alias("naive"),
        F.concat(eastern, F.lit("-05:00")).alias("with_offset"),
        F.concat(F.date_format("t", iso), F.lit(" o'clock")).alias("malformed"),
    )
    return texts.select(
        "event_id",
        *[
            parse_event_time(c).cast("timestamp_ntz").alias(c)
            for c in ("naive", "with_offset", "malformed")
        ],
    )


def filtered(request: dict) -> Query:
    return lambda spark, sf_dir: filters.apply_filters(served(spark, sf_dir), request)


def api_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.project(served(spark, sf_dir), "customer_id, phone,secret,phone,modified_ts")


def param_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table's name is put together from two parameters."""
    return filters.sql_params(
        spark,
        """SELECT phone, customer_id FROM IDENTIFIER(:stage || '_' || :entity)
           WHERE customer_id BETWEEN :low AND :high AND phone LIKE :digits
           ORDER BY customer_id LIMIT :n""",
        {"stage": "served", "entity": "orders", "low": 100, "high": 4000, "digits": "1%", "n": 70},
        served_orders=served(spark, sf_dir),
    )


# Data quality -----------------------------------------------------------------


def dq_warn_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rule_counts(sensor(spark, sf_dir), RULES)


def dq_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.expect_or_drop(sensor(spark, sf_dir), DROP_RULES, Observation("dq_drop"))


def dq_fail_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = {"has_time": "event_timestamp IS NOT NULL"}
    return quality.expect_or_fail(sensor(spark, sf_dir), rule, Observation("dq_fail"))


def dq_all_or_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.expect_all_or_drop(sensor(spark, sf_dir), RULES, Observation("dq_all"))


def dq_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, failed = quality.split_quarantine(sensor(spark, sf_dir), RULES)
    return failed.withColumn("failed_rules", F.array_join("failed_rules", ","))


def dq_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.split_counts(sensor(spark, sf_dir), DROP_RULES)


# Aggregations and windows -----------------------------------------------------


def device_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_summary(windows.device_summary(clean(spark, sf_dir)))


def location_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = windows.location_mean(windows.device_summary(clean(spark, sf_dir)))
    return means.withColumn("avg_temp", F.round("avg_temp", 6))


def location_mean_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = windows.location_mean_weighted(windows.device_summary(clean(spark, sf_dir)))
    return means.withColumn("avg_temp", F.round("avg_temp", 6))


def hot_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.hot_devices(windows.device_summary(clean(spark, sf_dir)), as_of=AS_OF)


def hot_devices_pushdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.hot_devices_from_readings(clean(spark, sf_dir), as_of=AS_OF)


def alert_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.alert_state(hot_devices_pushdown(spark, sf_dir))


# Change data capture ----------------------------------------------------------


def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.scd2(change_log(spark, sf_dir), **SCD2)


def scd2_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.current_rows(scd2_history(spark, sf_dir))


def scd2_null_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority"))
    return cdc.scd2(change_log(spark, sf_dir).withColumn("o_orderpriority", priority), **SCD2)


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = order_versions(spark, sf_dir)
    return cdc.change_feed(old, new, ["o_orderkey"])


def change_feed_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = order_versions(spark, sf_dir)
    return cdc.change_feed(old, new, ["o_orderkey"], buckets=4096)


def streamed_history(order: list[int]) -> Query:
    """History from three arrivals, in the given order of their time ranges."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = new_scratch(spark, "history")
        log = change_log(spark, sf_dir)
        parts = arrivals(log, "o_orderdate", ORDER_CUTS)
        for index in order:
            parts[index].write.mode("append").parquet(f"{root}/arrivals")
            changes = read_stream_table(spark, f"{root}/arrivals", log.schema)
            scd2_stream(changes, f"{root}/table", f"{root}/checkpoint", **SCD2)
        return read_history(spark, f"{root}/table")

    return run


# Paging -----------------------------------------------------------------------


def page_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.page(served(spark, sf_dir))


def page_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.page(served(spark, sf_dir), limit=500, cursor=CURSOR)


PAGE_NUMBERS = (1, 9, 22)


def page_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of 70 rows by number, out of the stored table."""
    path = new_scratch(spark, "served")
    write_served(served(spark, sf_dir), path)
    pages = [
        page_directory.page_at(spark, path, number, 70).withColumn("page_no", F.lit(number)) for number in PAGE_NUMBERS
    ]
    return reduce(DataFrame.unionByName, pages)


def all_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page of every row of the stored table."""
    path = new_scratch(spark, "served")
    write_served(served(spark, sf_dir), path)
    return page_directory.all_pages(spark, path, 150).select("customer_id", "modified_ts", "page_no", "row_in_page")


def page_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.page(served(spark, sf_dir), limit=20, cursor=CURSOR, select=["name", "phone"])


def page_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    request = PageRequest(
        select_csv="customer_id,name,modified_ts",
        filters_json='{"email": "p", "name_contains": "urgent", "modified_to": "2001-01-01"}',
        limit=5,
    )
    return PageService(served(spark, sf_dir)).summary(request)


def keyset_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row beyond the cursor, for an export that starts there."""
    return paging.after(served(spark, sf_dir), CURSOR)


def cursor_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = served(spark, sf_dir)
    tokens = paging.with_cursor(rows)
    dtypes = [rows.schema[name].dataType for name in paging.key_names(paging.KEYSET)]
    parsed = tokens.withColumn("k", parse_cursor(F.col("cursor"), dtypes))
    return parsed.select(
        "cursor", F.col("k.k0").alias("modified_ts"), F.col("k.k1").alias("customer_id")
    )


def export_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = paging.export_pages(served(spark, sf_dir), limit=200)
    return pages.select("customer_id", "modified_ts", "page_no", "row_in_page")


def items_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.items_json(served(spark, sf_dir))


# Sources and streams ----------------------------------------------------------


def ingest_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    stamped = with_ingest_meta(events)
    return stamped.select(
        "event_id",
        F.substring_index("source_file", "/", -1).alias("file_name"),
        F.col("ingestion_timestamp").isNotNull().alias("stamped"),
    )


def details(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.col("c_custkey").alias("customer_id")
    )
    return customer_details(ids, seed=42)


def ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three arrivals and a fourth run without new files; each file counts once."""
    root = new_scratch(spark, "ingest")
    tables = pipeline.SensorTables(f"{root}/tables")
    landing = f"{root}/landing"
    for part in [*arrivals(sensor(spark, sf_dir), "event_timestamp", EVENT_CUTS), None]:
        if part is not None:
            landed(part).write.mode("append").json(landing)
        ingest_json(
            spark, landing, tables.bronze, tables.checkpoint("bronze"), tables.schema_log,
            hints=READING_SCHEMA,
        )
    return pipeline.read_bronze(spark, tables).select(
        "event_id", "device_id", "timestamp", "temperature_celsius", "vibration_hz", "location"
    )


def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second arrival has a new column, the third a wider type for another."""
    root = new_scratch(spark, "evolution")
    tables = pipeline.SensorTables(f"{root}/tables")
    landing = f"{root}/landing"
    first, second, third = arrivals(sensor(spark, sf_dir), "event_timestamp", EVENT_CUTS)
    whole = F.floor("temperature_celsius")
    humidity = F.col("temperature_celsius") / 10
    for part in (
        landed(first).withColumn("level", whole),
        landed(second).withColumn("level", whole).withColumn("wetness", humidity),
        landed(third).withColumn("level", whole + 0.5).withColumn("wetness", humidity),
    ):
        part.write.mode("append").json(landing)
        ingest_json(
            spark, landing, tables.bronze, tables.checkpoint("bronze"), tables.schema_log,
            hints=READING_SCHEMA,
        )
    return pipeline.read_bronze(spark, tables).select(
        "event_id", "device_id", "level", F.round("wetness", 6).alias("wetness")
    )


def run_in_arrivals(
    spark: SparkSession, sf_dir: str, recorder: MetricsRecorder | None = None
) -> pipeline.SensorTables:
    root = new_scratch(spark, "sensor")
    tables = None
    for part in arrivals(sensor(spark, sf_dir), "event_timestamp", EVENT_CUTS):
        landed(part).drop("event_id").write.mode("append").json(f"{root}/landing")
        tables = pipeline.run_pipeline(
            spark, f"{root}/landing", f"{root}/tables", recorder=recorder
        )
    return tables


def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = run_in_arrivals(spark, sf_dir)
    good = silver_columns(pipeline.read_silver(spark, tables)).withColumn("target", F.lit("silver"))
    bad = silver_columns(pipeline.read_quarantine(spark, tables))
    return good.unionByName(bad.withColumn("target", F.lit("quarantine")))


def _run_flawed(spark: SparkSession, sf_dir: str) -> pipeline.SensorTables:
    """Three runs: the first one brings only readings without a device, and all of
    them some whose time cannot be read."""
    root = new_scratch(spark, "flawed")
    tables = None
    for number, part in enumerate(arrivals(sensor(spark, sf_dir), "event_timestamp", EVENT_CUTS)):
        unreadable = F.when(F.col("event_id") % 7 == 0, F.lit("no time")).otherwise(F.col("timestamp"))
        rows = landed(part).withColumn("timestamp", unreadable).drop("event_id")
        if number == 0:
            rows = rows.where("device_id IS NULL")
        rows.write.mode("append").json(f"{root}/landing")
        tables = pipeline.run_pipeline(spark, f"{root}/landing", f"{root}/tables")
    return tables


def bad_times_quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table; silver and quarantine together are bronze."""
    tables = _run_flawed(spark, sf_dir)
    frames = {
        "bronze": pipeline.read_bronze(spark, tables),
        "silver": pipeline.read_silver(spark, tables),
        "quarantine": pipeline.read_quarantine(spark, tables),
    }
    counts = [df.agg(F.count("*").alias("n")).withColumn("target", F.lit(name)) for name, df in frames.items()]
    summary = pipeline.read_device_summary(spark, tables)
    readings = summary.agg(F.coalesce(F.sum("reading_count"), F.lit(0)).alias("n"))
    counts.append(readings.withColumn("target", F.lit("summary")))
    return reduce(DataFrame.unionByName, counts)


def pipeline_empty_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The device summary after a first run without a valid reading."""
    return rounded_summary(pipeline.read_device_summary(spark, _run_flawed(spark, sf_dir)))


def incremental_equals_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same landing files after three runs and after a full refresh."""
    root = new_scratch(spark, "refresh")
    for part in arrivals(sensor(spark, sf_dir), "event_timestamp", EVENT_CUTS):
        landed(part).drop("event_id").write.mode("append").json(f"{root}/landing")
        pipeline.run_pipeline(spark, f"{root}/landing", f"{root}/tables")
    grown = pipeline.current_tables(spark, f"{root}/tables")
    pipeline.run_pipeline(spark, f"{root}/landing", f"{root}/tables", full_refresh=True)
    rebuilt = pipeline.current_tables(spark, f"{root}/tables")
    both = [
        rounded_summary(pipeline.read_device_summary(spark, tables)).withColumn("run", F.lit(name))
        for name, tables in (("incremental", grown), ("full", rebuilt))
    ]
    return both[0].unionByName(both[1])


def dq_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of every table and rule over all runs, from the metrics table."""
    recorder = MetricsRecorder()
    spark.streams.addListener(recorder)
    try:
        tables = run_in_arrivals(spark, sf_dir, recorder)
    finally:
        spark.streams.removeListener(recorder)
    return (
        metrics_table(spark, tables.metrics)
        .groupBy("table_name", "metric")
        .agg(F.sum("value").alias("value"))
    )


def _arriving_silver(spark: SparkSession, root: str, part: DataFrame) -> DataFrame:
    """Appends one arrival to a silver folder and opens the folder as a stream."""
    timed = part.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    timed.where(quality.all_hold(DROP_RULES)).write.mode("append").parquet(f"{root}/silver")
    return read_stream_table(spark, f"{root}/silver", timed.schema)


def stream_summary_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All windows from state, replaced by every batch."""
    root = new_scratch(spark, "complete")
    schema = None
    for part in arrivals(sensor(spark, sf_dir), "event_timestamp", EVENT_CUTS):
        summary = device_summary_stream(_arriving_silver(spark, root, part))
        with state_partitions(spark, spark.sparkContext.defaultParallelism):
            write_summary_complete(summary, f"{root}/summary", f"{root}/checkpoint")
        schema = summary.schema
    return rounded_summary(read_summary(spark, f"{root}/summary", schema))


def stream_summary_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same windows from partial summaries, without state."""
    root = new_scratch(spark, "partials")
    schema = None
    for part in arrivals(sensor(spark, sf_dir), "event_timestamp", EVENT_CUTS):
        readings = _arriving_silver(spark, root, part)
        write_summary_partials(readings, f"{root}/summary", f"{root}/checkpoint")
        schema = partial_summary(readings).schema
    return rounded_summary(read_summary_partials(spark, f"{root}/summary", schema))


def stream_summary_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows closed by the watermark, each emitted once."""
    root = new_scratch(spark, "append")
    for part in arrivals(sensor(spark, sf_dir), "event_timestamp", EVENT_CUTS):
        summary = device_summary_stream(_arriving_silver(spark, root, part), WATERMARK)
        with state_partitions(spark, spark.sparkContext.defaultParallelism):
            write_stream_table(summary, f"{root}/summary", f"{root}/checkpoint")
    return rounded_summary(spark.read.parquet(f"{root}/summary"))


def alert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hot windows reported while the readings arrive."""
    root = new_scratch(spark, "alerts")
    for part in arrivals(sensor(spark, sf_dir), "event_timestamp", EVENT_CUTS):
        summary = device_summary_stream(_arriving_silver(spark, root, part))
        with state_partitions(spark, spark.sparkContext.defaultParallelism):
            write_alerts(
                summary, f"{root}/alerts", f"{root}/checkpoint",
                windows.HOT_CELSIUS, windows.ALERT_HOURS, AS_OF,
            )
    hot = read_alerts(spark, f"{root}/alerts", windows.ALERT_HOURS, AS_OF)
    return hot.select("device_id", "location", ntz("window_start"), "max_temp")


def unpacked_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events out of files of one line each, with the braces of ``props`` inside strings."""
    root = new_scratch(spark, "arrays")
    events = table(spark, sf_dir, "events").select("event_id", "value", "props")
    items = events.select(F.to_json(F.struct("*")).alias("value"))
    items.write.option("lineSep", ",").text(f"{root}/source")
    json_arrays.unpack_arrays(spark, f"{root}/source", f"{root}/lines", f"{root}/checkpoint")
    return spark.read.schema(events.schema).json(f"{root}/lines").select("event_id", "value", "props")


def late_rows_accounted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings per location in closed windows, in open ones, and behind the watermark; one
    reading in fifty comes with the next arrival."""
    root = new_scratch(spark, "late")
    number = F.when(F.col("event_timestamp") < F.lit(EVENT_CUTS[0]).cast("timestamp_ntz"), 0).when(
        F.col("event_timestamp") < F.lit(EVENT_CUTS[1]).cast("timestamp_ntz"), 1).otherwise(2)
    delayed = F.least(number + (F.col("event_id") % 50 == 7).cast("int"), F.lit(2))
    readings = sensor(spark, sf_dir).withColumn("arrival", delayed)
    schema = None
    for arrival in range(3):
        stream = _arriving_silver(spark, root, readings.where(F.col("arrival") == arrival))
        late.write_closing_summary(stream, f"{root}/out", f"{root}/checkpoint")
        schema = stream.schema
    of_partials = partial_summary(spark.createDataFrame([], schema)).schema
    found = late.read_closing_summary(spark, f"{root}/out", of_partials).select(
        "location", F.when(F.col("closed"), "closed").otherwise("open").alias("kind"), F.col("reading_count").alias("n")
    )
    behind = late.read_late(spark, f"{root}/out", schema).select("location", F.lit("late").alias("kind"), F.lit(1).alias("n"))
    return found.unionByName(behind).groupBy("location", "kind").agg(F.sum("n").alias("n"))


ALERT_TIMES = ("2023-12-31 00:00:00", "2024-01-15 12:00:00", "2024-02-15 00:00:00")


def alert_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When the alerts of devices fired and cleared; the readings come out of order."""
    root = new_scratch(spark, "intervals")
    schema = None
    parts = arrivals(sensor(spark, sf_dir), "event_timestamp", EVENT_CUTS)
    for index in (2, 0, 1):
        readings = _arriving_silver(spark, root, parts[index])
        alerts.start_hot_windows(readings, f"{root}/hot", f"{root}/checkpoint").awaitTermination()
        schema = alerts.hot_windows(readings).schema
    found = alerts.alert_intervals(alerts.read_hot_windows(spark, f"{root}/hot", schema))
    return found.select("device_id", "location", ntz("fired_at"), ntz("cleared_at"), "max_temp", "hot_windows")


def alert_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the alert is up before, during and after the readings, from the pipeline's table."""
    found = alerts.alert_intervals(pipeline.read_hot(spark, run_in_arrivals(spark, sf_dir)))
    states = [
        alerts.alerts_at(found, time).agg(F.count("*").alias("devices")).select(
            F.lit(time).alias("as_of"), (F.col("devices") > 0).alias("alert"), "devices"
        )
        for time in ALERT_TIMES
    ]
    return reduce(DataFrame.unionByName, states)


def _run_customers(spark: SparkSession, sf_dir: str) -> customers.CustomerTables:
    """Three runs of the customer pipeline over orders as changes of customer details."""
    root = new_scratch(spark, "customers")
    email = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")).alias("email")
    log = change_log(spark, sf_dir).select(
        "customer_id", F.col("o_orderstatus").alias("name"), email, "o_orderdate", "o_orderkey"
    )
    tables = None
    for part in arrivals(log, "o_orderdate", ORDER_CUTS):
        part.write.mode("append").parquet(f"{root}/arrivals")
        arriving = read_stream_table(spark, f"{root}/arrivals", log.schema)
        tables = customers.run_customers(
            spark, arriving, f"{root}/tables", "o_orderdate", ["o_orderkey"], ["o_orderdate", "o_orderkey"]
        )
    return tables


def customer_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The served customers after three runs from raw details over the history."""
    return spark.read.parquet(_run_customers(spark, sf_dir).served)


def customer_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of the customer tables: streams over all runs, current rows of the last one."""
    rows = metrics_table(spark, _run_customers(spark, sf_dir).metrics)
    current = F.col("table_name") == "current_customers"
    totals = rows.groupBy("table_name", "metric").agg(
        F.sum("value").alias("total"), F.max_by("value", "batch_time").alias("last")
    )
    return totals.select("table_name", "metric", F.when(current, F.col("last")).otherwise(F.col("total")).alias("value"))


QUERIES: dict[str, Query] = {
    "ingest_json": ingested,
    "unpacked_arrays": unpacked_arrays,
    "schema_evolution": schema_evolution,
    "ingest_meta": ingest_meta,
    "synthetic_customers": details,
    "stream_silver": stream_silver,
    "bad_times_quarantined": bad_times_quarantined,
    "pipeline_empty_batch": pipeline_empty_batch,
    "incremental_equals_full": incremental_equals_full,
    "silver_clean": silver_clean,
    "parse_event_time": parse_times,
    "api_projection": api_projection,
    "api_filter_exact": filtered({"name": "2-HIGH"}),
    "api_filter_id": filtered({"customer_id": 1234}),
    "api_filter_ci": filtered({"email": "f"}),
    "api_filter_contains": filtered({"name_contains": "Not Spec"}),
    "api_filter_time": filtered({"modified_from": "1996-01-01", "modified_to": "1998-07-01"}),
    "api_filters_all": filtered(
        {
            "email": "p",
            "name": "1-URGENT",
            "name_contains": "urg",
            "ip_addr": "7",
            "modified_from": "1995-06-01",
            "modified_to": "2001-06-01T00:00:00",
        }
    ),
    "param_query": param_query,
    "dq_warn_counts": dq_warn_counts,
    "dq_drop": dq_drop,
    "dq_fail_passes": dq_fail_passes,
    "dq_all_or_drop": dq_all_or_drop,
    "dq_quarantine": dq_quarantine,
    "dq_split_counts": dq_split_counts,
    "dq_metrics": dq_metrics,
    "device_summary": device_summary,
    "location_mean": location_mean,
    "location_mean_weighted": location_mean_weighted,
    "hot_devices": hot_devices,
    "hot_devices_pushdown": hot_devices_pushdown,
    "alert_state": alert_state,
    "alert_stream": alert_stream,
    "alert_intervals": alert_intervals,
    "alert_timeline": alert_timeline,
    "customer_pipeline": customer_pipeline,
    "customer_metrics": customer_metrics,
    "stream_summary_append": stream_summary_append,
    "late_rows_accounted": late_rows_accounted,
    "stream_summary_complete": stream_summary_complete,
    "stream_summary_partials": stream_summary_partials,
    "scd2_history": scd2_history,
    "scd2_current": scd2_current,
    "scd2_null_update": scd2_null_update,
    "scd2_incremental": streamed_history([0, 1, 2]),
    "scd2_out_of_order": streamed_history([2, 0, 1]),
    "change_feed": change_feed,
    "change_feed_digests": change_feed_digests,
    "page_first": page_first,
    "page_after": page_after,
    "page_at": page_at,
    "all_pages": all_pages,
    "page_projection": page_projection,
    "page_summary": page_summary,
    "keyset_after": keyset_after,
    "cursor_roundtrip": cursor_roundtrip,
    "export_pages": export_pages,
    "items_json": items_json,
}
