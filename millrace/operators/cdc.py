"""Change data capture: history (type 2), current rows, change feed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DateType,
    MapType,
    NumericType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
    VariantType,
)

START = "__START_AT"
END = "__END_AT"

# Keys are counted in so many groups by their hash; those of a group with more changes
# than HOT_ROWS are cut into slices of their time.
KEY_GROUPS = 1 << 16
HOT_ROWS = 20_000_000

# Number of time slices: no task holds more changes of a hot key than about all changes
# of hot keys divided by it.
SLICES = 1024

# Counter of the rows that have no key.
NO_KEY = "dropped__no_key"


def scd2(
    log: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    tie_breakers: Sequence[str] = (),
    except_columns: Sequence[str] = (),
    coalesce_unchanged: bool = True,
    hot_rows: int | None = HOT_ROWS,
    metrics: Observation | str | None = None,
) -> DataFrame:
    """History of a change log: one row per version, open versions end in NULL.

    Changes are placed by ``sequence_by``, not by arrival. Of several changes of
    a key at one sequence value the last by ``tie_breakers`` counts (then by the
    remaining values, so that the result is fixed). NULLs in a change overwrite.
    ``except_columns`` are left out of the result and of change detection. A row
    without a sequence value is an error. Rows without a key are dropped, and
    counted if ``metrics`` is given. User columns live inside structs, so any name
    may be theirs but ``__START_AT`` and ``__END_AT``.

    Nothing runs before the result is used. Keys with at most ``hot_rows`` changes take
    one shuffle by key and one sort. Groups of keys with more are found by counting, in the
    same query (their numbers, KEY_GROUPS at most, are sent to every task), and leave before that
    shuffle: their changes at one instant are merged, their time is cut into slices of about equal
    shares, windows run per key and slice, and what crosses a slice comes from a window
    over the first and last version of every slice. Both ways give the same history.
    ``hot_rows=None`` leaves the second one out.
    """
    changes, values = _changes(log, list(keys), sequence_by, tie_breakers, except_columns, metrics)
    if hot_rows is None:
        versions = _by_key(changes, coalesce_unchanged)
    else:
        rank = _rank(F.col("at"), log.schema[sequence_by].dataType)
        hot = F.broadcast(_hot_groups(changes, hot_rows))
        cold = _by_key(changes.join(hot, "hash", "left_anti"), coalesce_unchanged)
        many = changes.join(hot, "hash", "left_semi")
        last = many.groupBy("key", "at").agg(F.max_by("row", "tie").alias("row"))
        versions = cold.unionByName(_by_slice(_sliced(last, many, rank), coalesce_unchanged))
    return versions.select(
        *[F.col(f"key.{_quoted(c)}").alias(c) for c in keys],
        *[F.col(f"row.{_quoted(c)}").alias(c) for c in values],
        F.col("at").alias(START),
        F.col("until").alias(END),
    )


def value_columns(columns: Sequence[str], keys: Sequence[str], except_columns: Sequence[str]) -> list[str]:
    """The columns of a change log whose changes make versions."""
    values = [c for c in columns if c not in keys and c not in except_columns]
    if not values:
        raise ValueError("a history needs at least one value column")
    taken = {START, END} & {*keys, *values}
    if taken:
        raise ValueError(f"the history has columns of its own with these names: {sorted(taken)}")
    return values


def _changes(
    log: DataFrame, keys: list[str], sequence_by: str, tie_breakers: Sequence[str],
    except_columns: Sequence[str], metrics: Observation | str | None,
) -> tuple[DataFrame, list[str]]:
    """``key``, its ``hash``, ``at``, ``tie`` and ``row`` of the changes that have a key; the value columns."""
    values = value_columns(log.columns, keys, except_columns)
    ties = list(dict.fromkeys([*tie_breakers, *values]))
    has_key = F.lit(True)
    for key in keys:
        has_key = has_key & F.col(_quoted(key)).isNotNull()
    rows = log
    if metrics is not None:
        rows = rows.observe(metrics, F.count(F.lit(1)).alias("rows_in"), F.count_if(~has_key).alias(NO_KEY))
    missing = F.raise_error(F.lit("change without a sequence value")).cast(log.schema[sequence_by].dataType)
    return rows.where(has_key).select(
        F.struct(*map(_quoted, keys)).alias("key"),
        F.pmod(F.xxhash64(*map(_quoted, keys)), F.lit(KEY_GROUPS)).cast("int").alias("hash"),
        F.coalesce(F.col(_quoted(sequence_by)), missing).alias("at"),
        F.struct(*[_orderable(c, log.schema[c].dataType).alias(f"t{i}") for i, c in enumerate(ties)]).alias("tie"),
        F.struct(*map(_quoted, values)).alias("row"),
    ), values


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _orderable(column: str, dtype: DataType) -> Column:
    """The column, or its JSON text where Spark cannot order its type."""
    value = F.col(_quoted(column))
    return F.to_json(F.struct(value.alias("v"))) if _has_no_order(dtype) else value


def _has_no_order(dtype: DataType) -> bool:
    if isinstance(dtype, ArrayType):
        return _has_no_order(dtype.elementType)
    if isinstance(dtype, StructType):
        return any(_has_no_order(f.dataType) for f in dtype.fields)
    return isinstance(dtype, (MapType, VariantType))


def _rank(value: Column, dtype: DataType) -> Column:
    """A number that never falls where the sequence rises; equal numbers share a slice."""
    if isinstance(dtype, NumericType):
        return value.cast("double")
    if isinstance(dtype, TimestampType):
        return F.unix_micros(value).cast("double")
    if isinstance(dtype, TimestampNTZType):
        parts = F.struct(F.unix_date(value.cast("date")).cast("double").alias("d"), value.alias("t"))
        seconds = F.hour(parts["t"]) * 3600 + F.minute(parts["t"]) * 60 + F.second(parts["t"])
        return parts["d"] * 86400 + seconds
    if isinstance(dtype, DateType):
        return F.unix_date(value).cast("double")
    if isinstance(dtype, StringType):
        return F.conv(F.rpad(F.hex(F.substring(F.encode(value, "UTF-8"), 1, 6)), 12, "0"), 16, 10).cast("double")
    return F.lit(0.0)


def _hot_groups(changes: DataFrame, hot_rows: int) -> DataFrame:
    """``hash`` of the groups of keys with more than ``hot_rows`` changes."""
    counted = changes.groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") > hot_rows).select("hash")


def _by_key(changes: DataFrame, coalesce_unchanged: bool) -> DataFrame:
    """``key``, ``row``, ``at`` and ``until``; all windows share one partitioning and one sort."""
    per_key = Window.partitionBy("key")
    by_at = per_key.orderBy("at")
    following = F.lead("at").over(per_key.orderBy("at", "tie"))
    rows = changes.withColumn("following", following).where(~F.col("following").eqNullSafe(F.col("at")))
    if coalesce_unchanged:
        rows = rows.withColumn("before", F.lag(F.struct("row")).over(by_at))
        rows = rows.where(F.col("before").isNull() | ~_same("before.row", "row", changes.schema["row"].dataType))
    return rows.withColumn("until", F.lead("at").over(by_at)).select("key", "row", "at", "until")


def _same(a: str, b: str, dtype: DataType) -> Column:
    """Whether two columns are equal or both null; JSON text stands for what has no order."""
    one, other = F.col(a), F.col(b)
    if _has_no_order(dtype):
        one, other = F.to_json(F.struct(one.alias("v"))), F.to_json(F.struct(other.alias("v")))
    return one.eqNullSafe(other)


def _sliced(rows: DataFrame, changes: DataFrame, rank: Column) -> DataFrame:
    """Adds the number of the time slice of ``at``: how many of the changes' quantiles are
    not above it.

    The quantiles are one row, which is sent to every task.
    """
    # One literal: a plan with a literal per quantile takes longer to analyse than to run.
    shares = F.split(F.lit(",".join(str(i / SLICES) for i in range(1, SLICES))), ",").cast("array<double>")
    cuts = changes.agg(F.percentile_approx(rank, shares, 20 * SLICES).alias("cuts"), F.lit(0).alias("one"))
    # A binary search: every step moves on if the quantile in the middle is not above.
    steps = ", ".join(str(SLICES >> i) for i in range(1, SLICES.bit_length()))
    number = f"aggregate(array({steps}), 0, (n, step) -> if(get(cuts, n + step - 1) <= rank, n + step, n))"
    placed = rows.withColumns({"rank": rank, "one": F.lit(0)}).join(F.broadcast(cuts), "one")
    return placed.select("key", "at", "row", F.expr(number).alias("slice"))


def _by_slice(rows: DataFrame, coalesce_unchanged: bool) -> DataFrame:
    """The same as ``_by_key`` from one row per key and instant, with its slice."""
    dtype = rows.schema["row"].dataType
    inside = "OVER (PARTITION BY key, slice ORDER BY at)"
    if coalesce_unchanged:
        # The first row of a slice stays until the slice before is known.
        rows = rows.withColumn("before", F.expr(f"lag(struct(row)) {inside}"))
        rows = rows.where(F.col("before").isNull() | ~_same("before.row", "row", dtype))
    rows = rows.selectExpr(
        "key", "at", "row", "slice", f"row_number() {inside} = 1 AS first", f"lead(at) {inside} AS until"
    )
    # Border rows, the first and last of a slice, meet in one group per key; all others
    # stay in groups of their slice. Newest first, so that looking ahead is looking back.
    rows = rows.withColumn("border", F.expr("first OR until IS NULL"))
    across = "OVER (PARTITION BY key, if(border, NULL, slice) ORDER BY at DESC"
    if coalesce_unchanged:
        rows = rows.withColumn("previous", F.expr(f"lead(struct(row)) {across})"))
        unchanged = F.expr("first AND previous IS NOT NULL") & _same("previous.row", "row", dtype)
    else:
        unchanged = F.lit(False)
    # Where the version before a slice ends: at the slice's first row, or, if that one
    # changes nothing, at the next row of the slice, if there is one.
    begins = "CASE WHEN first AND unchanged THEN until WHEN first THEN at END"
    following = f"last({begins}, true) {across} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    rows = rows.withColumn("unchanged", unchanged).withColumn("following", F.expr(following))
    return rows.where("NOT unchanged").selectExpr("key", "row", "at", "coalesce(until, if(border, following, NULL)) AS until")


def current_rows(history: DataFrame, start_as: str = "modified_ts") -> DataFrame:
    """The open version of every key."""
    return history.where(F.col(END).isNull()).drop(END).withColumnRenamed(START, start_as)


# Most buckets of digests; their numbers are sent to all tasks.
MOST_BUCKETS = 1 << 20


def _digests(df: DataFrame, bucket: Column) -> DataFrame:
    """``bucket``, and sums over its rows that do not depend on their order.

    Two 64-bit hashes per row are added up in halves, so that no sum overflows. A hash skips
    NULLs, so it also takes in where they stand.
    """
    names = sorted(df.columns)
    columns = [F.col(f"`{name}`") for name in names]
    nulls = F.concat(*(F.when(c.isNull(), "1").otherwise("0") for c in columns))
    low = F.lit((1 << 32) - 1)
    rows = df.select(bucket.alias("bucket"), *(F.xxhash64(F.lit(seed), nulls, *columns).alias(f"h{seed}") for seed in (1, 2)))
    halves = [half for seed in (1, 2) for half in (F.col(f"h{seed}").bitwiseAND(low), F.shiftrightunsigned(f"h{seed}", 32))]
    sums = [F.sum(half).alias(f"s{number}") for number, half in enumerate(halves)]
    return rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), *sums)


def changed_buckets(old: DataFrame, new: DataFrame, keys: Sequence[str], buckets: int) -> tuple[DataFrame, DataFrame]:
    """The rows of both versions whose bucket of keys is not the same in both.

    Each version is read once for its digests, which meet as one row per bucket. Buckets whose
    digests agree leave before anything is shuffled.
    """
    if not 1 <= buckets <= MOST_BUCKETS:
        raise ValueError(f"between 1 and {MOST_BUCKETS} buckets, got {buckets}")
    fields = old.unionByName(new).schema.fields
    if any(isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType)) for f in fields):
        raise ValueError("digests need columns without inner values")
    # Equal values of different types have different hashes.
    sides = {
        side: df.select(*(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in fields))
        for side, df in (("old", old), ("new", new))
    }
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    both = reduce(DataFrame.unionByName, (_digests(df, bucket).withColumn("side", F.lit(side)) for side, df in sides.items()))
    told = [F.count_distinct("n", *(f"s{number}" for number in range(4))).alias("kinds"), F.count(F.lit(1)).alias("versions")]
    changed = both.groupBy("bucket").agg(*told).where("kinds > 1 OR versions = 1").select("bucket")

    def kept(df: DataFrame) -> DataFrame:
        rows = df.select(F.struct("*").alias("row"), bucket.alias("bucket"))
        return rows.join(F.broadcast(changed), "bucket", "left_semi").select("row.*")

    return kept(sides["old"]), kept(sides["new"])


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Row changes between two versions of a table with unique ``keys``.

    With ``buckets`` both versions are first compared by digests of so many groups of keys, and
    only groups that differ are shuffled (and checked for repeated keys). That pays when few
    groups differ, as it reads both versions twice.

    ``_change_type`` is insert, delete, update_preimage or update_postimage. Both
    versions go through one shuffle by key; each row looks at its neighbour, so
    nothing is multiplied. A key that repeats within a version is an error.
    """
    values = [c for c in old.columns if c not in keys]
    if sorted(new.columns) != sorted(old.columns):
        raise ValueError("both versions need the same columns")
    if buckets is not None:
        old, new = changed_buckets(old, new, keys, buckets)
    row = F.struct(*values) if values else F.struct(F.lit(1).alias("_none"))
    sides = old.select(*keys, F.lit(0).alias("_side"), row.alias("_row")).unionByName(
        new.select(*keys, F.lit(1).alias("_side"), row.alias("_row"))
    )
    order = Window.partitionBy(*keys).orderBy("_side")
    is_old = F.col("_side") == 0
    paired = sides.select(
        "*",
        F.lag("_side").over(order).alias("_side_before"),
        F.when(is_old, F.lead("_row").over(order)).otherwise(F.lag("_row").over(order)).alias("_other"),
    )
    repeated = F.col("_side_before") == F.col("_side")
    kind = (
        F.when(repeated, F.raise_error(F.lit("key repeats within one table version")).cast("string"))
        .when(F.col("_other").isNull(), F.when(is_old, "delete").otherwise("insert"))
        .when(
            ~F.col("_other").eqNullSafe(F.col("_row")),
            F.when(is_old, "update_preimage").otherwise("update_postimage"),
        )
    )
    changes = paired.withColumn("_change_type", kind).where(F.col("_change_type").isNotNull())
    return changes.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in values], "_change_type")
