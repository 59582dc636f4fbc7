"""The test tables seen as the inputs of this library."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Dates that cut the event and order tables into three arrivals.
EVENT_CUTS = ("2024-01-11", "2024-01-21")
ORDER_CUTS = ("1997-03-01", "1999-05-01")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as readings; one device id in a hundred is missing."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_id") % 100 != 0, F.col("user_id")).alias("device_id"),
        F.col("ts").alias("event_timestamp"),
        F.col("value").alias("temperature_celsius"),
        F.get_json_object("props", "$.k").cast("double").alias("vibration_hz"),
        F.col("event_type").alias("location"),
    )


def landed(readings: DataFrame) -> DataFrame:
    """Readings in the form in which they land: text ids, ISO time text."""
    return readings.select(
        "event_id",
        F.col("device_id").cast("string").alias("device_id"),
        F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        "temperature_celsius",
        "vibration_hz",
        "location",
    )


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as changes of a customer's status and priority."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        "o_orderdate",
        "o_orderkey",
        "o_orderstatus",
        "o_orderpriority",
    )


def order_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The order table before and after a load: late orders arrive, finished old
    ones are archived, urgent partial ones are finished."""
    orders = table(spark, sf_dir, "orders")
    old = orders.where(F.col("o_orderdate") < F.lit("2001-02-01").cast("timestamp_ntz"))
    archived = (F.col("o_orderstatus") == "F") & (
        F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")
    )
    finished = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")
    new = orders.where(~archived).withColumn(
        "o_orderstatus", F.when(finished, "F").otherwise(F.col("o_orderstatus"))
    )
    return old, new


def served(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the table behind the page requests."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("customer_id"),
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderstatus").alias("email"),
        (F.col("o_custkey") % 256).cast("string").alias("ip_addr"),
        F.col("o_custkey").cast("string").alias("phone"),
        F.col("o_orderdate").alias("modified_ts"),
    )


def arrivals(df: DataFrame, column: str, cuts: tuple[str, str]) -> list[DataFrame]:
    """The whole of ``df`` in three time ranges; rows without a time come last."""
    first, second = (F.lit(c).cast("timestamp_ntz") for c in cuts)
    time = F.col(column)
    return [
        df.where(time < first),
        df.where((time >= first) & (time < second)),
        df.where((time >= second) | time.isNull()),
    ]
