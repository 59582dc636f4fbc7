"""Hard negatives by Four-Russians scoring.

The components of a candidate are written as bit planes in two's complement, eight
dimensions to a byte. For a group of eight dimensions an anchor has a table of the sums of
all 256 subsets of its components. A byte of a candidate's plane is an index into that
table; the looked-up sums are added over the groups, and the planes are added by doubling,
highest plane first, which counts negative. The result is the exact integer inner product.

Anchors and candidates meet in blocks: every block of anchors with every block of
candidates, once to find the positives (within a label), once for the negatives. A
block is a share of the rows by number, so repeated vectors, ids and hot labels are spread
like all others; a block returns a few rows per anchor, which one window per anchor merges.

Defined results: rows with a null label, a null vector or a component that is null or not
finite take no part; vectors may differ in length, missing components are 0; rows are
told apart by their place, so repeated rows are candidates (and anchors) of their own, and
after equal scores and ids the one read first comes first; null ids come last and are no
anchors. An anchor without a positive or a negative has no rows. An empty table gives an
empty table. Other columns are ignored. Products that need more than 63 bits are an error.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.session import materialize

#: Dimensions of a subset table.
GROUP = 8
POSITIVES = 5
NEGATIVES = 10
#: Rows of a block, and anchors whose tables are in memory at a time.
ANCHOR_ROWS, CANDIDATE_ROWS = 1024, 4096
SLICE = 64


def packed_planes(vectors: np.ndarray, bits: int) -> np.ndarray:
    """Bytes by vector, plane (lowest first) and group, of integers that fit ``bits`` bits."""
    unsigned = vectors.astype(np.int64).view(np.uint64)
    planes = [((unsigned >> np.uint64(k)) & np.uint64(1)).astype(np.uint8) for k in range(bits)]
    return np.stack([np.packbits(plane, axis=1, bitorder="little") for plane in planes], axis=1)


def subset_tables(vectors: np.ndarray, kind: type) -> np.ndarray:
    """Sums by group, subset and vector; bit i of a subset stands for component i of the group."""
    parts = vectors.astype(kind).reshape(len(vectors), -1, GROUP).transpose(1, 2, 0)
    tables = np.zeros((len(parts), 1 << GROUP, len(vectors)), kind)
    for i in range(GROUP):
        tables[:, 1 << i : 2 << i] = tables[:, : 1 << i] + parts[:, i : i + 1]
    return tables


def scores(anchors: np.ndarray, planes: np.ndarray, kind: type) -> np.ndarray:
    """Inner products by anchor and candidate; ``planes`` are by plane, group and candidate."""
    tables = subset_tables(anchors, kind)
    total = np.zeros((planes.shape[2], len(anchors)), kind)
    looked = np.empty_like(total)
    for k in range(len(planes) - 1, -1, -1):
        total += total
        for table, indices in zip(tables, planes[k]):
            np.take(table, indices, axis=0, out=looked)
            if k == len(planes) - 1:
                total -= looked
            else:
                total += looked
    return np.ascontiguousarray(total.T)


def _padded(values: pa.Array, width: int) -> np.ndarray:
    """Lists of integers as rows of ``width``, filled up with 0."""
    lengths = values.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = values.flatten().to_numpy(zero_copy_only=False)
    filled = np.zeros((len(values), width), np.int64)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    filled[np.repeat(np.arange(len(values)), lengths), place] = flat
    return filled


def _whole(size: int) -> int:
    """``size`` rounded up to whole groups."""
    return -(-max(size, 1) // GROUP) * GROUP


def _gathered(packed: list[bytes], bits: int, groups: int) -> np.ndarray:
    """Planes of a block by plane, group and candidate, filled up with 0."""
    sizes = {len(own) for own in packed}
    if sizes == {bits * groups}:
        return np.ascontiguousarray(np.frombuffer(b"".join(packed), np.uint8).reshape(-1, bits, groups).transpose(1, 2, 0))
    planes = np.zeros((bits, groups, len(packed)), np.uint8)
    for i, own in enumerate(packed):
        planes[:, : len(own) // bits, i] = np.frombuffer(own, np.uint8).reshape(bits, -1)[:, :groups]
    return planes


#: Rows of a block: numbers, ids (null for none) and labels of the candidates.
Candidates = tuple[np.ndarray, list, np.ndarray]
#: Picks rows for one anchor from its candidates' order and scores, best first.
Choice = Callable[[dict, Candidates, np.ndarray, np.ndarray], list[tuple]]


def _first_positives(anchor: dict, candidates: Candidates, order: np.ndarray, products: np.ndarray) -> list[tuple]:
    rows, ids, _ = candidates
    others = [(j, s) for j, s in zip(order[: POSITIVES + 1], products) if rows[j] != anchor["row"]]
    return [(anchor["row"], int(rows[j]), ids[j], int(s)) for j, s in others[:POSITIVES]]


def _first_negatives(anchor: dict, candidates: Candidates, order: np.ndarray, products: np.ndarray) -> list[tuple]:
    rows, ids, labels = candidates
    other = labels[order] != anchor["label"]
    order, falling = order[other], -products[other].astype(np.int64)
    found = []
    for positive in anchor["positives"]:
        least, most = -(-30 * positive["score"] // 100), 90 * positive["score"] // 100
        start, end = np.searchsorted(falling, -most), np.searchsorted(falling, -least, side="right")
        found.extend(
            (anchor["row"], positive["place"], int(rows[order[k]]), ids[order[k]], -int(falling[k]))
            for k in range(start, min(end, start + NEGATIVES))
        )
    return found


def _scored(sides: DataFrame, choose: Choice, bits: int, names: list[str]) -> DataFrame:
    """What ``choose`` picks for every anchor, block by block."""

    def run(group: pa.Table) -> pa.Table:
        side = group.column("is_anchor").combine_chunks()
        anchors = group.filter(side)
        others = group.filter(pc.invert(side)).sort_by([("vec_id", "ascending"), ("row", "ascending")])
        found: list[tuple] = []
        if len(anchors) and len(others):
            width = _whole(max(map(len, anchors.column("vector").to_pylist())))
            vectors = _padded(anchors.column("vector").combine_chunks(), width)
            planes = _gathered(others.column("planes").to_pylist(), bits, width // GROUP)
            kind = np.int32 if width * int(np.abs(vectors).max()) << bits < 1 << 31 else np.int64
            candidates = (
                others.column("row").to_numpy(), others.column("vec_id").to_pylist(), others.column("label").to_numpy()
            )
            own = anchors.drop(["vector", "planes"]).to_pylist()
            for at in range(0, len(own), SLICE):
                for anchor, products in zip(own[at:], scores(vectors[at : at + SLICE], planes, kind)):
                    order = np.argsort(-products, kind="stable")
                    found.extend(choose(anchor, candidates, order, products[order]))
        columns = list(zip(*found)) if found else [[] for _ in names]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)

    return sides.groupBy("within", "a", "b").applyInArrow(run, ", ".join(f"{name} bigint" for name in names))


def _numbered(anchors: DataFrame, candidates: DataFrame, within: str | None) -> tuple[DataFrame, DataFrame]:
    """Both sides with the numbers of blocks, ``lefts`` of anchors and ``rights`` of candidates."""
    if within is None:
        sizes = [(anchors.count(), ANCHOR_ROWS, "lefts"), (candidates.count(), CANDIDATE_ROWS, "rights")]
        numbers = {name: F.lit(-(-count // size)) for count, size, name in sizes}
        return anchors.withColumns(numbers), candidates.withColumns(numbers)
    counts = [
        rows.groupBy(within).agg(F.ceil(F.count("*") / size).alias(name))
        for rows, size, name in ((anchors, ANCHOR_ROWS, "lefts"), (candidates, CANDIDATE_ROWS, "rights"))
    ]
    blocks = materialize(counts[0].join(counts[1], within), "blocks")  # Spark knows the size of a table
    return anchors.join(blocks, within), candidates.join(blocks, within)


def _paired(anchors: DataFrame, candidates: DataFrame, within: str | None = None) -> DataFrame:
    """Both sides by block ``a``, ``b`` (and ``within``): every block of anchors beside every
    block of candidates. Rows are joined with numbers of blocks only, never with each other."""
    columns = [*candidates.columns, *(c for c in anchors.columns if c not in candidates.columns)]

    def side(rows: DataFrame, is_anchor: bool) -> DataFrame:
        own, every = ("lefts", "rights") if is_anchor else ("rights", "lefts")
        place = F.pmod(F.xxhash64("row"), F.col(own))
        beside = F.explode(F.sequence(F.lit(0).cast("long"), F.col(every) - 1))
        return rows.select(
            *(c if c in rows.columns else F.lit(None).alias(c) for c in columns), F.lit(is_anchor).alias("is_anchor"),
            (F.lit(0) if within is None else F.col(within)).alias("within"),
            (place if is_anchor else beside).alias("a"), (beside if is_anchor else place).alias("b"),
        )

    anchors, candidates = _numbered(anchors, candidates, within)
    return side(anchors, True).union(side(candidates, False))


def _best(rows: DataFrame, by: list[str], score: str, vec_id: str, row: str, keep: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc(score), F.asc_nulls_last(vec_id), row)
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def _quantised(rows: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """``row`` (a number of its own), ``vec_id``, ``label`` and ``vector`` of longs, for the
    rows that take part."""
    own = rows.select(
        F.monotonically_increasing_id().alias("row"), F.col(vec_id).cast("long").alias("vec_id"),
        F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("v"),
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    kept = own.where(F.col("label").isNotNull() & F.col("v").isNotNull() & finite)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform("v", lambda x: F.floor(256 * x))
    return kept.select("row", "vec_id", moved.alias("label"), whole.alias("vector"))


def _bits(table: DataFrame) -> int:
    """Bits of a component, its sign included; an error where a product might not fit."""
    ends = table.agg(
        F.max(F.array_max("vector")).alias("most"), F.min(F.array_min("vector")).alias("least"),
        F.max(F.size("vector")).alias("size"),
    ).first()
    bits = max(ends["most"] or 0, -1 - (ends["least"] or 0), 1).bit_length() + 1
    if _whole(ends["size"] or 0) << 2 * bits >= 1 << 63:
        raise ValueError("inner products of these vectors need more than 63 bits")
    return bits


def _packed(table: DataFrame, bits: int) -> DataFrame:
    """``planes`` instead of ``vector``."""

    def batch(values: pa.Array) -> pa.Array:
        alike = len(values.value_lengths().unique()) == 1
        parts = [values] if alike else [values.slice(i, 1) for i in range(len(values))]
        padded = (_padded(part, _whole(len(part[0]))) for part in parts)
        return pa.array([own.tobytes() for part in padded for own in packed_planes(part, bits)], pa.binary())

    return table.withColumn("planes", F.arrow_udf(batch, "binary")("vector")).drop("vector")


def mine(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", anchor_every: int = 100) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id`` and both scores.

    Anchors are the rows whose id is divisible by ``anchor_every``. A negative scores between
    30 and 90 percent of the positive.
    """
    table = materialize(_quantised(rows, vec_id, vector, label), "vectors")
    bits = _bits(table)
    index = materialize(_packed(table, bits), "planes")
    anchors = table.where(F.col("vec_id") % anchor_every == 0)

    near = _scored(_paired(anchors, index, "label"), _first_positives, bits,
                   ["row", "positive_row", "positive_id", "positive_score"])
    near = materialize(_best(near, ["row"], "positive_score", "positive_id", "positive_row", POSITIVES), "positives")
    listed = near.groupBy("row").agg(
        F.collect_list(F.struct(F.col("rank").cast("long").alias("place"), F.col("positive_score").alias("score"))).alias("positives")
    )
    found = _scored(_paired(anchors.join(listed, "row"), index), _first_negatives, bits,
                    ["row", "place", "negative_row", "negative_id", "negative_score"])
    best = _best(found, ["row", "place"], "negative_score", "negative_id", "negative_row", NEGATIVES)
    positives = near.select("row", F.col("rank").cast("long").alias("place"), "positive_id", "positive_score")
    own = anchors.select("row", F.col("vec_id").alias("anchor_id"))
    return best.join(positives, ["row", "place"]).join(own, "row").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
