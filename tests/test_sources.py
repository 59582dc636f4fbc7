from __future__ import annotations

import dataclasses
import json
import os
from datetime import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions.times import parse_event_time
from millrace.operators.projections import READING_SCHEMA, to_silver
from millrace.plans import sensor as pipeline
from millrace.session import materialize, scratch_root
from millrace.sources.audit import with_ingest_meta
from millrace.sources.customers import synthetic_customers
from millrace.sources.json_files import ingest_json
from millrace.sources import json_arrays, schemas
from millrace.sources.schemas import evolve_union, from_schema_text, logged_schema, widen


def reading(n, **more):
    return {
        "device_id": f"MFG-A-{1000 + n}",
        "timestamp": "2025-01-01T12:00:00.000001",
        "temperature_celsius": 25.5,
        "vibration_hz": 0.25,
        "location": "Factory Floor A",
        **more,
    }


def land(folder, name, items, at=None):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as file:
        json.dump(items, file)
    if at is not None:
        os.utime(path, (at, at))


def run(spark, landing, tables, hints=READING_SCHEMA, **options):
    return ingest_json(
        spark, landing, tables.bronze, tables.checkpoint("bronze"), tables.schema_log, hints, **options
    )


@pytest.fixture
def tables(tmp_path):
    return pipeline.SensorTables(str(tmp_path / "tables"))


def test_array_files_are_read_once(spark, tables, tmp_path):
    landing = str(tmp_path / "landing")
    land(landing, "1.json", [reading(1), reading(2)])
    for _ in range(2):
        run(spark, landing, tables)
        assert pipeline.read_bronze(spark, tables).count() == 2
    land(landing, "2.json", [reading(3)])
    land(landing, "3.json", [reading(4)])
    run(spark, landing, tables, maxFilesPerTrigger="1")
    rows = pipeline.read_bronze(spark, tables)
    assert sorted(r.device_id for r in rows.collect()) == [f"MFG-A-100{i}" for i in range(1, 5)]
    assert rows.select("source_file").distinct().count() == 3
    assert rows.where("ingestion_timestamp IS NULL").count() == 0


def test_schema_grows_and_widens(spark, tables, tmp_path):
    landing = str(tmp_path / "landing")
    land(landing, "1.json", [reading(1, level=1, tag=1)])
    run(spark, landing, tables)
    land(landing, "2.json", [reading(2, level=2, humidity_percent=40.5, pressure=1.5, tag="a")])
    run(spark, landing, tables)
    land(landing, "3.json", [reading(3, level=2.5)])
    run(spark, landing, tables)
    run(spark, landing, tables)
    rows = pipeline.read_bronze(spark, tables)
    assert dict(rows.dtypes)["level"] == "double" and dict(rows.dtypes)["tag"] == "string"
    found = {r.device_id[-1]: (r.level, r.humidity_percent, r.pressure, r.tag) for r in rows.collect()}
    assert found == {
        "1": (1.0, None, None, "1"), "2": (2.0, 40.5, 1.5, "a"), "3": (2.5, None, None, None),
    }
    assert logged_schema(spark, tables.schema_log)[0] == 2


def test_schema_is_found_when_the_log_missed_batches(spark, tables, tmp_path):
    landing = str(tmp_path / "landing")
    land(landing, "1.json", [reading(1, first=1)])
    run(spark, landing, tables)
    lost = dataclasses.replace(tables)
    land(landing, "2.json", [reading(2, second=2.5)])
    ingest_json(
        spark, landing, lost.bronze, lost.checkpoint("bronze"), str(tmp_path / "lost_log"), READING_SCHEMA
    )
    land(landing, "3.json", [reading(3, third={"x": 1})])
    run(spark, landing, tables)
    rows = {r.device_id[-1]: r for r in pipeline.read_bronze(spark, tables).collect()}
    assert (rows["1"].first, rows["2"].second, rows["3"].third.x) == (1, 2.5, 1)
    assert rows["3"].first is None


def test_a_long_run_is_journalled_without_reading_bronze(spark, tables, tmp_path, monkeypatch):
    def read(*_):
        raise AssertionError("bronze was read")

    monkeypatch.setattr(schemas, "schema_between", read)
    landing = str(tmp_path / "landing")
    for number in range(104):
        land(landing, f"{number:03}.json", [reading(number, **{f"f{number % 3}": number})], at=number)
    query = run(spark, landing, tables, maxFilesPerTrigger="1")
    assert len(query.recentProgress) < 104
    log = spark.read.parquet(tables.schema_log)
    assert sorted(r.last_batch for r in log.collect()) == list(range(104))
    last, schema = logged_schema(spark, tables.schema_log)
    assert last == 103 and {"f0", "f1", "f2"} <= set(schema.names)


def test_a_gap_is_read_from_its_own_rows(spark, tmp_path):
    bronze, log = str(tmp_path / "bronze"), str(tmp_path / "log")
    times = {number: (number + 1) * 3 * schemas.CLOCK_CHANGE for number in range(5)}
    for number, name in enumerate("abcde"):
        row = spark.createDataFrame([(f'{{"{name}": 1}}', times[number])], "t string, at long")
        row = row.select(F.parse_json("t").alias("record"), F.timestamp_micros("at").alias("ingestion_timestamp"))
        row.write.mode("append").parquet(bronze)
    # Batch 0 is logged with a field of its own; of 1 to 4, batch 2 did not report.
    schemas.journal_schemas(spark, bronze, log, {0: ("OBJECT<z: BIGINT>", times[0])})
    found = {1: ("OBJECT<b: BIGINT>", times[1]), 3: ("OBJECT<d: BIGINT>", times[3]), 4: ("OBJECT<y: BIGINT>", times[4])}
    assert schemas.journal_schemas(spark, bronze, log, found).names == ["z", "b", "c", "d", "y"]
    assert logged_schema(spark, log)[0] == 4
    assert schemas.schema_between(spark, bronze, None, times[0]) == "OBJECT<a: BIGINT>"


def test_values_of_another_type_stay_in_the_record(spark, tables, tmp_path):
    landing = str(tmp_path / "landing")
    land(landing, "1.json", [reading(1, temperature_celsius="hot")])
    os.makedirs(landing, exist_ok=True)
    with open(os.path.join(landing, "2.json"), "w") as file:
        file.write(json.dumps(reading(2)) + "\n" + "{broken\n" + json.dumps([reading(3), reading(4)]) + "\n")
    run(spark, landing, tables)
    rows = pipeline.read_bronze(spark, tables)
    assert rows.count() == 5
    assert rows.where("temperature_celsius IS NULL").count() == 2
    assert [r.unparsed for r in rows.where("unparsed IS NOT NULL").collect()] == ["{broken"]
    stored = spark.read.parquet(tables.bronze)
    assert stored.where("try_variant_get(record, '$.temperature_celsius', 'string') = 'hot'").count() == 1


def test_arrays_over_several_lines(spark, tables, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "1.json").write_text(json.dumps([reading(i) for i in range(4)], indent=2))
    run(spark, str(landing), tables, multiLine="true")
    assert pipeline.read_bronze(spark, tables).where("device_id IS NOT NULL").count() == 4


def test_field_names_that_differ_in_case(spark, tables, tmp_path):
    landing = str(tmp_path / "landing")
    land(landing, "1.json", [reading(1, Level=1, LOCATION="elsewhere"), reading(2, level=2)])
    run(spark, landing, tables)
    rows = pipeline.read_bronze(spark, tables)
    assert [c.lower() for c in rows.columns].count("level") == 1
    assert rows.where("location = 'Factory Floor A'").count() == 2


def test_schema_texts():
    text = "OBJECT<a: BIGINT, `b c`: DECIMAL(4,2), c: VARIANT, d: VOID, e: OBJECT<f: STRING>, g: ARRAY<BIGINT>>"
    assert from_schema_text(text).simpleString() == (
        "struct<a:bigint,b c:double,c:string,d:string,e:struct<f:string>,g:array<bigint>>"
    )
    assert from_schema_text("VOID") == from_schema_text(None) == StructType()


def test_a_grown_column_reads_its_own_field(spark, tables, tmp_path):
    landing = str(tmp_path / "landing")
    land(landing, "1.json", [reading(n, pressure=n, note="n" * n) for n in range(300)])
    run(spark, landing, tables)
    grown = pipeline.read_bronze(spark, tables).select("device_id", "pressure")
    plan = grown._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<device_id:string,record:struct<0:bigint>>" in plan
    file = next(name for name in os.listdir(tables.bronze) if name.endswith(".parquet"))
    stored = {column.path for column in pq.ParquetFile(os.path.join(tables.bronze, file)).schema}
    assert {"record.typed_value.pressure.typed_value", "record.typed_value.note.typed_value"} <= stored
    assert grown.agg(F.sum("pressure")).first()[0] == 299 * 150


def test_hints_win_over_inference(spark, tables, tmp_path):
    landing = str(tmp_path / "landing")
    land(landing, "1.json", [reading(1, temperature_celsius=30)])
    run(spark, landing, tables)
    assert dict(pipeline.read_bronze(spark, tables).dtypes)["temperature_celsius"] == "double"


def test_widen():
    a = StructType.fromDDL("a int, b bigint, c date, d string, e int, s struct<x:int>")
    b = StructType.fromDDL("b double, a bigint, c timestamp, d int, e boolean, f int, s struct<x:int,y:int>")
    assert widen(a, b).simpleString() == (
        "struct<a:bigint,b:double,c:timestamp,d:string,e:string,s:struct<x:int,y:int>,f:int>"
    )
    assert widen(a, a) == a


def test_evolve_union(spark):
    a = spark.createDataFrame([(1, 2)], "id int, n int")
    b = spark.createDataFrame([(2, 2.5, "x")], "id int, n double, t string")
    assert sorted(map(tuple, evolve_union(a, b).collect())) == [(1, 2.0, None), (2, 2.5, "x")]


def test_event_time_texts(spark):
    texts = [
        ("2025-11-02T05:30:00.123456", datetime(2025, 11, 2, 5, 30, 0, 123456)),
        ("2025-11-02T01:30:00-04:00", datetime(2025, 11, 2, 5, 30)),
        ("2025-11-02T01:30:00-05:00", datetime(2025, 11, 2, 6, 30)),
        ("yesterday at noon", None),
        (None, None),
    ]
    df = spark.createDataFrame([(t,) for t, _ in texts], "t string")
    assert [r.p for r in df.select(parse_event_time("t").alias("p")).collect()] == [e for _, e in texts]


def test_silver_has_fixed_columns(spark):
    bronze = spark.createDataFrame([], pipeline.BRONZE_SCHEMA).withColumn("extra", F.lit(1))
    assert "extra" not in to_silver(bronze).columns


def test_audit_columns(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    row = with_ingest_meta(spark.read.parquet(str(tmp_path / "t")), "Asia/Tokyo").select(
        "source_file", (F.col("ingestion_timestamp") - F.current_timestamp()).alias("ahead")
    ).first()
    assert row.source_file.startswith("file:") and row.ahead.total_seconds() == 9 * 3600


def test_generated_customers_repeat(spark):
    one = synthetic_customers(spark, 1000, seed=1)
    again = synthetic_customers(spark, 1000, seed=1).repartition(7)
    assert one.columns == ["customer_id", "name", "email", "ip_addr", "phone"]
    assert one.exceptAll(again).count() == 0 and one.count() == 1000
    assert synthetic_customers(spark, 1000, seed=2).intersect(one).count() == 0
    assert one.where("ip_addr RLIKE '^([0-9]{1,3}[.]){3}[0-9]{1,3}$' AND phone LIKE '___-___-____'").count() == 1000


def test_scratch_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_root(spark) == root
    kept = materialize(spark.range(5), "t")
    assert kept.count() == 5 and root in kept.inputFiles()[0]


ODD = [
    {"a": 1}, {}, {"s": "}{\"}{ \\"}, {"s": "a\\\"{", "n": {"m": {"o": "}"}, "p": [{"q": 1}, {}]}},
    {"}": "{"}, {"s": "é日本 [1, {2}]\n"}, {"s": ""}, {"s": "\\\\"}, {"s": "\\\\\"}, {"},
]


@pytest.mark.parametrize("indent", [None, 2])
def test_an_array_is_taken_apart_by_many_tasks(spark, tmp_path, indent):
    source = str(tmp_path / "source")
    items = [{**odd, "id": n * len(ODD) + i} for n in range(400) for i, odd in enumerate(ODD)]
    os.makedirs(source)
    with open(os.path.join(source, "1.json"), "w") as file:
        json.dump(items, file, indent=indent, ensure_ascii=False)
    with open(os.path.join(source, "2.json"), "w") as file:
        file.write("\n".join(json.dumps({**odd, "id": -1 - i}) for i, odd in enumerate(ODD)))
    (tmp_path / "source" / "3.json").write_text("[]")
    (tmp_path / "source" / "4.json").write_text("")
    (tmp_path / "source" / "5.json").write_text('[1, {"id": -100}, two, {"id": -101}, "x"]')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        text = spark.read.option("lineSep", json_arrays.CLOSE).text(source)
        assert text.rdd.getNumPartitions() > 5
        json_arrays.unpack_arrays(spark, source, str(tmp_path / "lines"), str(tmp_path / "checkpoint"))
        lines = [r.value for r in spark.read.text(str(tmp_path / "lines")).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    stray = sorted(line for line in lines if not line.startswith("{"))
    assert stray == ['"x"', "1", "two"]
    expected = items + [{**odd, "id": -1 - i} for i, odd in enumerate(ODD)] + [{"id": -100}, {"id": -101}]
    found = [json.loads(line) for line in lines if line.startswith("{")]
    assert sorted(found, key=lambda r: r["id"]) == sorted(expected, key=lambda r: r["id"])


def test_an_unpacked_array_gives_the_same_bronze(spark, tables, tmp_path):
    source, lines = str(tmp_path / "source"), str(tmp_path / "lines")
    land(source, "1.json", [reading(n, note="{}}") for n in range(50)])
    json_arrays.unpack_arrays(spark, source, lines, str(tmp_path / "unpack"))
    run(spark, lines, tables)
    land(source, "2.json", [reading(n) for n in range(50, 60)])
    json_arrays.unpack_arrays(spark, source, lines, str(tmp_path / "unpack"))
    run(spark, lines, tables)
    rows = pipeline.read_bronze(spark, tables)
    assert sorted(r.device_id for r in rows.collect()) == sorted(f"MFG-A-{1000 + n}" for n in range(60))
    assert rows.where("note = '{}}'").count() == 50
