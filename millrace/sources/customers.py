"""Generated customer details."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Words of the generated names and addresses.
WORDS = ("amet", "dolor", "elit", "ipsum", "lorem", "magna", "sit", "tempor")
DOMAINS = ("com", "net", "org", "co.uk")


# Hexadecimal digits of the digest that one draw uses.
DIGITS = 4


def _draw(number: int, size: int) -> Column:
    """The ``number``-th draw of a row, in [0, size)."""
    digits = F.substring("_digest", number * DIGITS + 1, DIGITS)
    return (F.conv(digits, 16, 10).cast("int") % size).cast("int")


def _pick(number: int, choices: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in choices]), _draw(number, len(choices)) + 1)


def _digits(number: int, size: int, width: int) -> Column:
    return F.lpad(_draw(number, size).cast("string"), width, "0")


def customer_details(ids: DataFrame, seed: int = 42) -> DataFrame:
    """Name, email, address and phone for a frame with ``customer_id``.

    All values come from one digest of id and seed, so they do not depend on the
    partitioning and a lost task gives the same rows again.
    """
    text = F.concat_ws("-", F.col("customer_id").cast("string"), F.lit(str(seed)))
    drawn = ids.select("customer_id", F.sha2(text, 256).alias("_digest"))
    return drawn.select(
        "customer_id",
        F.concat_ws(" ", *[_pick(i, WORDS) for i in (0, 1, 2)]).alias("name"),
        F.concat(
            _pick(3, WORDS), F.lit("@"), _pick(4, WORDS), F.lit("."), _pick(5, DOMAINS)
        ).alias("email"),
        F.concat_ws(".", *[_draw(i, 256).cast("string") for i in (6, 7, 8, 9)]).alias("ip_addr"),
        F.concat_ws("-", _digits(10, 1000, 3), _digits(11, 1000, 3), _digits(12, 10000, 4)).alias(
            "phone"
        ),
    )


def synthetic_customers(spark: SparkSession, rows: int = 1_000_000, seed: int = 42) -> DataFrame:
    """A generated customer table with ``rows`` rows."""
    return customer_details(spark.range(rows).withColumnRenamed("id", "customer_id"), seed)
