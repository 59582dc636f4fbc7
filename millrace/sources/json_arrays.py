"""Large JSON arrays taken apart by many tasks.

A file that is one array is one record to a JSON reader, and so one task. Here it is read as
text that ends at each closing brace, which Spark splits like lines. Whether a piece begins
inside a string, and how deep in objects, follows from sums over all pieces before it: sums
within a block of the file, and sums over the blocks. Only numbers take part in them; the
text moves when pieces of one element meet.

Defined results: every object of an array, or of lines, becomes one line of text, with line
breaks between its fields as spaces; text between the objects that is no separator becomes a
line of its own, for the reader of the lines to judge; an empty file gives no line. Objects
that a broken file never closes stay one line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

CLOSE = "}"

_PLACE = ("file", "block")


def _count(text: Column, character: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(character), F.lit("")))


def _pieces(text: DataFrame) -> DataFrame:
    """Pieces with their place: file, block of the file, and order in the block."""
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    )


def _numbers(pieces: DataFrame) -> DataFrame:
    """Quotes of each piece, and the objects it opens if it begins outside or inside a string."""
    # An escape never reaches into the next piece, as a closing brace is not escaped.
    bare = F.regexp_replace("value", r"(?s)\\.", "")

    def opened(text: Column) -> Column:
        return _count(F.regexp_replace(text, r'"[^"]*("|$)', ""), "{")

    return pieces.select(
        *_PLACE, "at", _count(bare, '"').alias("quotes"),
        opened(bare).alias("opens_outside"), opened(F.concat(F.lit('"'), bare)).alias("opens_inside"),
    )


def _running(rows: DataFrame, value: str) -> DataFrame:
    """``before``: the sum of ``value`` over all pieces of the file before each one. The
    windows hold the pieces of one block, and the blocks of one file."""
    blocks = rows.groupBy(*_PLACE).agg(F.sum(value).alias("total"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select(*_PLACE, F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("carried"))
    inside = Window.partitionBy(*_PLACE).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("local", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = local.join(carried, list(_PLACE)).withColumn("before", F.col("local") + F.col("carried"))
    return joined.drop("local", "carried")


def elements(text: DataFrame) -> DataFrame:
    """``value``: one line per element. ``text`` is read with ``lineSep`` as ``CLOSE``."""
    pieces = _pieces(text)
    quoted = _running(_numbers(pieces), "quotes").withColumn("inside", F.col("before") % 2 == 1)
    opens = F.when(F.col("inside"), F.col("opens_inside")).otherwise(F.col("opens_outside"))
    # The brace that ends the piece closes an object unless it stands in a string.
    closes = ((F.col("before") + F.col("quotes")) % 2 == 0).cast("int")
    changes = quoted.select(*_PLACE, "at", "inside", opens.alias("opens"), closes.alias("closes"))
    deep = _running(changes.withColumn("change", F.col("opens") - F.col("closes")), "change")
    deep = deep.withColumnRenamed("before", "depth").withColumn(
        "ends", ((F.col("closes") == 1) & (F.col("depth") + F.col("change") == 0)).cast("int")
    )
    numbered = _running(deep, "ends").withColumnRenamed("before", "element")
    # After the last object only the end of the array is left, which opens nothing.
    first = (F.col("depth") == 0) & ~F.col("inside")
    numbered = numbered.select(
        *_PLACE, "at", "element", first.alias("first"), (first & (F.col("opens") == 0)).alias("rest")
    )
    placed = pieces.join(numbered, [*_PLACE, "at"])
    start = F.when(F.col("first"), F.instr("value", "{")).otherwise(1)
    whole = F.concat(F.expr("substr(value, start)"), F.lit(CLOSE))
    placed = placed.withColumn("start", F.when(F.col("rest"), F.length("value") + 1).otherwise(start))
    met = placed.groupBy("file", "element").agg(
        F.sort_array(
            F.collect_list(F.when(~F.col("rest"), F.struct("block", "at", whole.alias("text"))))
        ).alias("parts"),
        F.max(F.when(F.col("first"), F.expr("substr(value, 1, start - 1)"))).alias("between"),
    )
    line = F.array_join(F.transform("parts", lambda part: part["text"]), "")
    stray = F.regexp_replace("between", r"^[\s,\[\]]+|[\s,\[\]]+$", "")
    lines = met.select(F.explode(F.array(line, stray)).alias("value")).where("value <> ''")
    return lines.select(F.regexp_replace("value", r"[\r\n]+", " ").alias("value"))


def unpack_arrays(spark: SparkSession, source: str, target: str, checkpoint: str, **options: str) -> StreamingQuery:
    """Write the elements of every new file below ``source`` as lines below ``target``, then stop.

    ``target`` is the landing folder of an ingest that runs after it. Options go to the file
    source. A repeated batch replaces its own folder.
    """
    reader = spark.readStream.options(recursiveFileLookup="true", lineSep=CLOSE)

    def unpack(batch: DataFrame, batch_id: int) -> None:
        elements(batch).write.mode("overwrite").text(f"{target}/batch_id={batch_id}")

    text = reader.options(**options).text(source).select("value", "_metadata")
    writer = text.writeStream.foreachBatch(unpack).option("checkpointLocation", checkpoint)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query
