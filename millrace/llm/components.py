"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.session import materialize


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One step: neighbours of a node are linked to the least node near it.

    A large step moves greater neighbours, a small step lesser ones and the node itself.
    Each row stays one row, so nothing is multiplied; the least node is a partial
    aggregate, and the join with it can be split at a hot node.
    """
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.union(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    joined = both.join(least, "u")
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return moved.where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component; for linked nodes only.

    ``links`` has the columns ``a`` and ``b``. Every round is a written table; it ends
    when a round changes nothing.
    """
    current = materialize(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(),
        "links",
    )
    mark = None
    while True:
        state = current.agg(
            F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")
        ).first()
        if mark == (state["n"], state["x"]):
            break
        mark = (state["n"], state["x"])
        current = materialize(_star(_star(current, True), False), "links")
    roots = current.select("b").distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots.select("b", "b"))
