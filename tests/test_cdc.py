from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import cdc
from millrace.operators.cdc import END, START

SCHEMA = "id int, at int, tie int, a string, b int"
OPTIONS = dict(keys=["id"], sequence_by="at", tie_breakers=["tie"], except_columns=["at", "tie"])


def expected_history(rows, coalesce=True):
    """Row-at-a-time history for small inputs."""
    out = []
    by_key = {}
    for row in rows:
        if row[0] is not None:
            by_key.setdefault(row[0], []).append(row)
    none_first = lambda v: (v is not None, v)
    for key, changes in by_key.items():
        changes.sort(key=lambda r: (r[1], *map(none_first, r[2:])))
        last = {r[1]: r for r in changes}
        versions = []
        for at in sorted(last):
            values = last[at][3:]
            if not coalesce or not versions or versions[-1][1] != values:
                versions.append((at, values))
        for i, (at, values) in enumerate(versions):
            end = versions[i + 1][0] if i + 1 < len(versions) else None
            out.append((key, *values, at, end))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.select("id", "a", "b", START, END).collect()), key=str)


def make(seed, n=400, keys=6, hot=0.5):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        key = 0 if rnd.random() < hot else rnd.randrange(1, keys)
        rows.append(
            (key, rnd.randrange(120), rnd.randrange(3), rnd.choice(["x", "y", None]), rnd.choice([1, None]))
        )
    rows.append((None, 5, 0, "x", 1))
    return rows


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("coalesce", [True, False])
def test_history_equals_row_at_a_time(spark, seed, coalesce):
    rows = make(seed)
    log = spark.createDataFrame(rows, SCHEMA)
    assert got(cdc.scd2(log, coalesce_unchanged=coalesce, **OPTIONS)) == expected_history(rows, coalesce)


@pytest.mark.parametrize("hot_rows", [0, 100])
@pytest.mark.parametrize("coalesce", [True, False])
def test_hot_keys_give_the_same_history(spark, hot_rows, coalesce):
    rows = make(7, n=900)
    log = spark.createDataFrame(rows, SCHEMA).repartition(6)
    sliced = cdc.scd2(log, coalesce_unchanged=coalesce, hot_rows=hot_rows, **OPTIONS)
    assert got(sliced) == expected_history(rows, coalesce)


def test_some_keys_hot_and_some_not(spark):
    rows = make(11, n=300)
    log = spark.createDataFrame(rows, SCHEMA)
    assert got(cdc.scd2(log, hot_rows=20, **OPTIONS)) == expected_history(rows)


def test_hot_keys_leave_before_any_shuffle_of_rows(spark, tmp_path):
    spark.createDataFrame(make(1), SCHEMA).write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    changes, _ = cdc._changes(log, ["id"], "at", ["tie"], ["at", "tie"], None)
    hot = changes.join(cdc._hot_groups(changes, 100), "hash", "left_semi")
    assert {r.key.id for r in hot.select("key").collect()} == {0}
    plan = cdc.scd2(log, hot_rows=100, **OPTIONS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin [hash") >= 2 and "SortMergeJoin" not in plan


def test_nothing_runs_before_the_result_is_used(spark):
    """A log that cannot be read gives a plan; the error comes with the rows."""
    log = spark.range(5).selectExpr(
        "cast(id AS int) AS id", "1 AS at", "1 AS tie", "string(raise_error('read')) AS a", "1 AS b"
    )
    history = cdc.scd2(log, **OPTIONS)
    with pytest.raises(Exception, match="read"):
        history.collect()


@pytest.mark.parametrize("hot_rows", [None, 0])
def test_user_columns_may_have_any_name_but_two(spark, hot_rows):
    names = ["key", "hash", "at", "tie", "row", "until", "slice", "cuts", "rank", "one", "first", "border", "previous",
             "unchanged", "following", "before", "_next", "_values", "_before", "_outside", "_slice", "_position", "n",
             "part", "version", "batch_id", "_first_change", "a.b", "c`d", "e f"]
    log = spark.range(6).selectExpr("id % 2 AS id", "id AS s", *(f"id * {i} AS `{n.replace('`', '``')}`" for i, n in enumerate(names, 3)))
    found = cdc.scd2(log, ["id"], "s", except_columns=["s"], hot_rows=hot_rows)
    assert found.columns == ["id", *names, START, END]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [(i % 2, *(i * k for k in range(3, 3 + len(names))), i, i + 2 if i < 4 else None) for i in range(6)], key=str
    )
    for taken in (START, END):
        with pytest.raises(ValueError, match=taken):
            cdc.scd2(log.withColumnRenamed("key", taken), ["id"], "s", hot_rows=hot_rows)
        assert cdc.scd2(log.withColumnRenamed("key", taken), ["id"], "s", except_columns=[taken]).count() == 6


@pytest.mark.parametrize("hot_rows", [None, 0])
def test_maps_are_compared_as_text(spark, hot_rows):
    log = spark.range(4).selectExpr("1 AS id", "id AS s", "map('a', id div 2) AS m")
    found = cdc.scd2(log, ["id"], "s", except_columns=["s"], hot_rows=hot_rows)
    assert [(r.m, r[START], r[END]) for r in found.orderBy(START).collect()] == [({"a": 0}, 0, 2), ({"a": 1}, 2, None)]


@pytest.mark.parametrize("kind", ["int", "double", "decimal(20,3)", "string", "date", "timestamp", "timestamp_ntz", "boolean"])
def test_slices_follow_the_sequence_of_any_type(spark, monkeypatch, kind):
    monkeypatch.setattr(cdc, "SLICES", 16)
    value = {"boolean": "id % 2 = 1", "string": "concat('k', lpad(string(id), 4, '0'))", "date": "date_add(date'2024-01-01', int(id))",
             "timestamp": "timestamp_micros(id * 40000000001)", "timestamp_ntz": "timestamp_micros(id * 40000000001)"}
    log = spark.range(300).selectExpr("id % 3 AS k", f"cast({value.get(kind, 'id / 4')} AS {kind}) AS s", "id div 7 AS v", "id AS t")
    options = dict(keys=["k"], sequence_by="s", tie_breakers=["t"], except_columns=["s", "t"])
    one, other = cdc.scd2(log, hot_rows=None, **options), cdc.scd2(log, hot_rows=0, **options)
    assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()
    changes, _ = cdc._changes(log, ["k"], "s", ["t"], ["s", "t"], None)
    sliced = cdc._sliced(changes, changes, cdc._rank(F.col("at"), log.schema["s"].dataType))
    sizes = [r["count"] for r in sliced.groupBy("slice").count().collect()]
    if kind != "boolean":
        assert max(sizes) <= 2 * 300 / 16 + 3


def test_rows_without_a_key_are_counted(spark):
    from pyspark.sql import Observation

    seen = Observation("history")
    cdc.scd2(spark.createDataFrame(make(1), SCHEMA), metrics=seen, hot_rows=None, **OPTIONS).collect()
    assert seen.get == {"rows_in": 401, cdc.NO_KEY: 1}


def test_hot_key_with_one_instant(spark):
    """A key with most changes at one sequence value; its last change counts."""
    rows = [(1, 5, tie, "x", tie) for tie in range(600)] + [(1, 4, 0, "w", 0), (1, 6, 0, "x", 599), (1, 7, 0, "z", 1)]
    log = spark.createDataFrame(rows, SCHEMA).repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got(cdc.scd2(log, hot_rows=10, **OPTIONS)) == expected_history(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_hot_key_with_one_value_spans_many_slices(spark):
    """Most slices keep no version at all; the ends still join up."""
    rows = [(1, at, 0, "x" if at < 500 else "y", 1) for at in range(1000)] + [(1, 1500, 0, "x", 1)]
    log = spark.createDataFrame(rows, SCHEMA).repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sliced = cdc.scd2(log, hot_rows=10, **OPTIONS)
        assert got(sliced) == [(1, "x", 1, 0, 500), (1, "x", 1, 1500, None), (1, "y", 1, 500, 1500)]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_arrival_order_does_not_matter(spark):
    rows = make(3)
    shuffled = rows[:]
    random.Random(1).shuffle(shuffled)
    one, two = (cdc.scd2(spark.createDataFrame(r, SCHEMA), **OPTIONS) for r in (rows, shuffled))
    assert got(one) == got(two)


def test_intervals_do_not_overlap_and_one_is_open(spark):
    history = cdc.scd2(spark.createDataFrame(make(5), SCHEMA), **OPTIONS)
    by_key = {}
    for row in history.collect():
        by_key.setdefault(row.id, []).append((row[START], row[END]))
    for spans in by_key.values():
        spans.sort()
        assert [end for _, end in spans].count(None) == 1
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
        assert all(end is None or start < end for start, end in spans)


def test_null_overwrites(spark):
    rows = [(1, 1, 0, "x", 1), (1, 2, 0, None, 1)]
    history = cdc.scd2(spark.createDataFrame(rows, SCHEMA), **OPTIONS)
    assert got(history) == expected_history(rows)
    current = cdc.current_rows(history).collect()
    assert [(r.id, r.a, r.modified_ts) for r in current] == [(1, None, 2)]


@pytest.mark.parametrize("hot_rows", [None, 0])
def test_missing_sequence_is_an_error(spark, hot_rows):
    log = spark.createDataFrame([(1, None, 0, "x", 1)], SCHEMA)
    with pytest.raises(Exception, match="without a sequence value"):
        cdc.scd2(log, hot_rows=hot_rows, **OPTIONS).collect()


def test_one_shuffle_and_one_sort(spark, tmp_path):
    spark.createDataFrame(make(1), SCHEMA).write.parquet(str(tmp_path / "log"))
    history = cdc.scd2(spark.read.parquet(str(tmp_path / "log")), **OPTIONS)
    expected = expected_history(make(1))
    assert got(history) == expected
    history.collect()  # without hot keys, the ways for them are cut off while the query runs
    plan = history._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1


def test_change_feed_applied_to_old_gives_new(spark):
    rnd = random.Random(2)
    old_rows = [(i, rnd.choice(["p", "q", None]), rnd.choice([1.0, None])) for i in range(200)]
    new_rows = [
        (i, rnd.choice(["p", "q", None]) if rnd.random() < 0.3 else a, b)
        for i, a, b in old_rows
        if rnd.random() < 0.8
    ] + [(i, "n", 2.0) for i in range(200, 230)]
    old, new = (spark.createDataFrame(r, "id int, a string, b double") for r in (old_rows, new_rows))
    feed = [tuple(r) for r in cdc.change_feed(old, new, ["id"]).collect()]
    state = {r[0]: r for r in old_rows}
    for *row, kind in feed:
        if kind in ("delete", "update_preimage"):
            assert state.pop(row[0]) == tuple(row)
    for *row, kind in feed:
        if kind in ("insert", "update_postimage"):
            assert row[0] not in state
            state[row[0]] = tuple(row)
    assert state == {r[0]: r for r in new_rows}
    assert cdc.change_feed(old, old, ["id"]).count() == 0


def test_change_feed_refuses_repeated_keys(spark):
    one = spark.createDataFrame([(1, "a"), (1, "b")], "id int, a string")
    none = one.where("false")
    for old, new in ((one, none), (none, one), (one, one)):
        with pytest.raises(Exception, match="key repeats"):
            cdc.change_feed(old, new, ["id"]).collect()


def test_change_feed_has_one_shuffle(spark, tmp_path):
    spark.range(100).withColumn("v", F.col("id") % 3).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    plan = cdc.change_feed(table, table.where("v > 0"), ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "Join" not in plan


def test_change_feed_shuffles_changed_buckets_alone(spark, tmp_path):
    spark.range(20_000).selectExpr(
        "id", "if(id % 7 = 0, NULL, id) AS a", "if(id % 7 = 0, 'x', NULL) AS b", "CAST(id AS STRING) AS bucket", "id AS side"
    ).write.parquet(str(tmp_path / "t"))
    old = spark.read.parquet(str(tmp_path / "t"))
    # A value that moves between columns, one that changes, a row that goes and one that comes.
    moved = old.withColumn("a", F.expr("if(id = 5, NULL, if(id = 11, 0, a))"))
    new = moved.withColumn("b", F.expr("if(id = 5, '5', b)")).where("id <> 13").union(
        spark.range(1).selectExpr("-1L", "1L", "'n'", "'n'", "2L")
    ).orderBy(F.desc("id"))
    plain = cdc.change_feed(old, new, ["id"])
    feed = cdc.change_feed(old, new, ["id"], buckets=5000)
    assert sorted(map(str, feed.collect())) == sorted(map(str, plain.collect())) and feed.count() == 6
    before, after = cdc.changed_buckets(old, new, ["id"], 5000)
    assert 3 <= before.count() < 60 and 3 <= after.count() < 60
    plan = feed._jdf.queryExecution().executedPlan().toString()
    assert plan.index("hashpartitioning(id") < plan.index("LeftSemi")
    assert cdc.change_feed(old, old.selectExpr("*"), ["id"], buckets=64).count() == 0
    wider = old.withColumn("side", F.col("side").cast("decimal(30,0)"))
    assert cdc.change_feed(old, wider, ["id"], buckets=64).count() == 0


def test_change_feed_digests_refuse_what_they_cannot_tell(spark):
    flat, inner = spark.range(2), spark.range(2).select("id", F.array("id").alias("a"))
    with pytest.raises(ValueError, match="inner values"):
        cdc.change_feed(inner, inner, ["id"], buckets=8)
    with pytest.raises(ValueError, match="buckets"):
        cdc.change_feed(flat, flat, ["id"], buckets=0)
