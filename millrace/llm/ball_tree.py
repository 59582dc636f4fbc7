"""Exact ranked lexical search: inner products of sparse vectors, pruned by ball trees.

A document is a vector with a weight per term, an item the vector of its terms' numbers;
the score is their inner product in 64-bit integers. Documents are gathered in trees of
at most TREE_DOCS of them. A node of a tree knows the centroid of its documents and the
radius of a ball around it, so no document below it scores more than (item, centroid) +
|item| * radius. Terms that an item lacks make that radius large; so the terms are also dealt into
GROUPS groups with a ball each, and the sum of the groups' bounds is taken where it is less. All
bounds are rounded up by more than floating point can lose. A tree is searched best bound first, until the best open bound is below the item's last place;
leaves are scored exactly. The last places are carried on from tree to tree.

The items are taken in blocks of about QUERY_BYTES and QUERY_ITEMS (an item is never cut), and every
block passes over all documents: a pass counts the block's terms in whole texts, which
also gives the statistics, the next one searches. What is broadcast is one block. No
text is shuffled, a task holds one tree at a time, and returns a few rows per item.

Defined results: null or empty texts and items without a term match nothing; items and
documents are told apart by their place, so each repeated item has its own rows, and repeated
documents rank beside each other, by document id (null ids last), then by place. Very long texts are
one vector of at most as many entries as the block has terms. Empty tables give an empty table. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.common import terms, texts
from millrace.session import materialize

TOP = 10
TREE_DOCS, TREE_ENTRIES = 8192, 1 << 22
LEAF_DOCS = 16
GROUPS = 4096
QUERY_BYTES, QUERY_ITEMS = 8 << 20, 4096
#: Relative room for rounding: a sum of n products is off by less than n * 2**-52 of its terms.
ROOM = 1e-9


class Tree:
    """A ball tree over documents in CSR form: ``starts``, ``columns`` and integer ``values``;
    no document is empty. Documents are reordered, so that every node is a range of them."""

    def __init__(self, starts: np.ndarray, columns: np.ndarray, values: np.ndarray, width: int):
        self.order = np.arange(len(starts) - 1)
        self.nodes: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        self.balls: list[tuple[np.ndarray, np.ndarray, float, np.ndarray, np.ndarray]] = []
        self._sizes = np.diff(starts)
        self._norms = np.add.reduceat(values.astype(float) ** 2, starts[:-1])
        self._build(starts, columns, values.astype(float), width)
        taken = self._entries(starts, self.order)
        self.columns, self.values = columns[taken], values[taken]
        self.starts = np.concatenate([[0], np.cumsum(self._sizes[self.order])])

    def _entries(self, starts: np.ndarray, docs: np.ndarray) -> np.ndarray:
        sizes = self._sizes[docs]
        ends = np.cumsum(sizes)
        return np.arange(ends[-1]) + np.repeat(starts[docs] - ends + sizes, sizes)

    def _build(self, starts: np.ndarray, columns: np.ndarray, values: np.ndarray, width: int) -> None:
        dense = np.zeros(width)
        todo = [(0, len(self.order), None)]
        while todo:
            low, high, parent = todo.pop()
            node = len(self.nodes)
            self.nodes.append((low, high))
            self.children.append(None)
            if parent is not None:
                self.children[parent] = (self.children[parent] or ()) + (node,)
            docs = self.order[low:high]
            taken = self._entries(starts, docs)
            own, weights = columns[taken], values[taken]
            ends = np.concatenate([[0], np.cumsum(self._sizes[docs])])[:-1]

            def away(centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                """Inner products with a dense vector, and squared distances from it."""
                products = np.add.reduceat(weights * centre[own], ends)
                norm = float(centre @ centre)
                return products, self._norms[docs] - 2 * products + norm + ROOM * (self._norms[docs] + norm)

            centroid = np.bincount(own, weights, width) / len(docs)
            _, distances = away(centroid)
            used = np.flatnonzero(centroid)
            groups, radii = _group_radii(own, weights, self._sizes[docs], used, centroid)
            self.balls.append((used, centroid[used], float(np.sqrt(distances.max())), groups, radii))
            if len(docs) <= LEAF_DOCS:
                continue
            # Two documents far apart; the others go to the nearer one, in halves.
            sides = []
            far = int(distances.argmax())
            for _ in range(2):
                entries = slice(starts[docs[far]], starts[docs[far] + 1])
                dense[columns[entries]] = values[entries]
                products, distances = away(dense)
                dense[columns[entries]] = 0
                sides.append(products)
                far = int(distances.argmax())
            self.order[low:high] = docs[np.argsort(sides[0] - sides[1], kind="stable")]
            middle = (low + high) // 2
            todo += [(middle, high, node), (low, middle, node)]

    def bounds(self, item_starts: np.ndarray, item_columns: np.ndarray, counts: np.ndarray, width: int) -> np.ndarray:
        """By item and node, what no document of the node exceeds; items in CSR form, none empty."""
        squares = counts.astype(float) ** 2
        norms = np.sqrt(np.add.reduceat(squares, item_starts[:-1]))
        # The items' norms by group, in CSR form as well.
        key = np.repeat(np.arange(len(norms)), np.diff(item_starts)) * GROUPS + item_columns % GROUPS
        keys, at = np.unique(key, return_inverse=True)
        parts, part_groups = np.sqrt(np.bincount(at, squares)), keys % GROUPS
        part_starts = np.searchsorted(keys, np.arange(len(norms)) * GROUPS)
        found = np.empty((len(norms), len(self.nodes)))
        dense, by_group = np.zeros(width), np.zeros(GROUPS)
        for node, (used, centroid, radius, groups, radii) in enumerate(self.balls):
            dense[used], by_group[groups] = centroid, radii
            middle = np.add.reduceat(dense[item_columns] * counts, item_starts[:-1])
            apart = np.add.reduceat(by_group[part_groups] * parts, part_starts)
            found[:, node] = middle + np.minimum(norms * radius, apart)
            dense[used], by_group[groups] = 0, 0
        return found * (1 + ROOM)

    def leaf_scores(self, node: int, item: np.ndarray) -> tuple[int, np.ndarray]:
        """The first document of a leaf, and exact scores; ``item`` is dense."""
        low, high = self.nodes[node]
        start, end = self.starts[low], self.starts[high]
        products = self.values[start:end] * item[self.columns[start:end]]
        return low, np.add.reduceat(products, self.starts[low:high] - start)


def _group_radii(
    columns: np.ndarray, values: np.ndarray, sizes: np.ndarray, used: np.ndarray, centroid: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The groups of the terms ``used``, and the radius of the documents around the centroid in
    each; ``sizes`` are the documents' numbers of entries."""
    base = np.bincount(used % GROUPS, centroid[used] ** 2, GROUPS)
    key = columns % GROUPS * len(sizes) + np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(key, kind="stable")
    key, near = key[order], centroid[columns[order]]
    starts = np.flatnonzero(np.diff(key, prepend=-1))
    # A document without an entry is off by the centroid alone: the base of the group.
    square, product = values[order] ** 2, values[order] * near
    change = np.add.reduceat(square - 2 * product, starts)
    room = ROOM * np.add.reduceat(square + 2 * product, starts)
    of = key[starts] // len(sizes)
    firsts = np.flatnonzero(np.diff(of, prepend=-1))
    groups = of[firsts]
    most = np.maximum(np.maximum.reduceat(change + room, firsts), 0.0)
    return groups, np.sqrt(base[groups] * (1 + ROOM) + most)


class Items(NamedTuple):
    """A block of items in CSR form, over numbers of terms."""

    rows: list[int]
    starts: np.ndarray
    columns: np.ndarray
    counts: np.ndarray
    numbers: dict[bytes, int]


def _gathered(found: list[tuple[int, str]]) -> Items:
    """Items with at least one term."""
    numbers: dict[bytes, int] = {}
    rows, starts, columns, counts = [], [0], [], []
    for row, text in found:
        own = Counter(terms(text))
        if own:
            rows.append(row)
            columns.extend(numbers.setdefault(term, len(numbers)) for term in own)
            counts.extend(own.values())
            starts.append(len(columns))
    return Items(rows, np.array(starts), np.array(columns, np.int64), np.array(counts, np.int64), numbers)


class _Best:
    """The first TOP documents of an item, as (-score, null id, id, row), best first."""

    def __init__(self):
        self.found: list[tuple] = []

    def last(self) -> int:
        """The least score that can still take a place."""
        return -self.found[-1][0] if len(self.found) == TOP else 1

    def add(self, new: list[tuple]) -> None:
        self.found = sorted(self.found + new, key=lambda f: (f[0], f[1], 0 if f[1] else f[2], f[3]))[:TOP]


def _search(tree: Tree, items: Items, columns: np.ndarray, width: int, ids: list, rows: list[int], best: list[_Best]) -> int:
    """Improve ``best`` by the documents of a tree; ``columns`` are the items' in the tree's
    numbering (``width`` for terms that it lacks). Returns how many leaves were scored."""
    bounds = tree.bounds(items.starts, columns, items.counts, width + 1)
    dense, scored = np.zeros(width + 1, np.int64), 0
    for item, mine in enumerate(best):
        entries = slice(items.starts[item], items.starts[item + 1])
        dense[columns[entries]] = items.counts[entries]
        dense[width] = 0
        bound = bounds[item]
        open_nodes = [(-bound[0], 0)]
        while open_nodes and -open_nodes[0][0] >= mine.last():
            _, node = heapq.heappop(open_nodes)
            if tree.children[node]:
                for child in tree.children[node]:
                    heapq.heappush(open_nodes, (-bound[child], child))
                continue
            scored += 1
            low, scores = tree.leaf_scores(node, dense)
            places = np.flatnonzero(scores >= mine.last())
            if len(places):
                docs = tree.order[low + places]
                mine.add([(-int(s), ids[d] is None, ids[d], rows[d]) for s, d in zip(scores[places], docs)])
        dense[columns[entries]] = 0
    return scored


def _count_terms(items: Broadcast):
    """Batches of row, id and text to row, id, ``n`` (terms) and the block's terms with numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = items.value.numbers.get
        for batch in batches:
            sizes, columns, counts = [], [], []
            for text in texts(batch.column("text")):
                found = terms(text)
                own = [(number(term), n) for term, n in Counter(found).items()]
                own = [(column, n) for column, n in own if column is not None]
                sizes.append(len(found))
                columns.append([column for column, _ in own])
                counts.append([n for _, n in own])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), pa.array(sizes, pa.int64()),
                 pa.array(columns, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))],
                ["row", "id", "n", "terms", "counts"],
            )

    return run


def _cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most TREE_DOCS documents and about TREE_ENTRIES entries."""
    ends = np.cumsum(batch.column("terms").value_lengths().to_numpy(zero_copy_only=False))
    low = 0
    while low < len(batch):
        before = ends[low - 1] if low else 0
        high = min(low + TREE_DOCS, max(low + 1, int(np.searchsorted(ends, before + TREE_ENTRIES, side="right"))))
        yield batch.slice(low, high - low)
        low = high


def _rank(items: Broadcast, weights: Broadcast, documents: int, length: int, kind: pa.DataType):
    """Batches of documents with terms to the first TOP of this task for every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, weight = items.value, weights.value
        best = [_Best() for _ in block.rows]
        for part in (part for batch in batches for part in _cut(batch)):
            n = part.column("n").to_numpy().astype(np.int64)
            sizes = part.column("terms").value_lengths().to_numpy().astype(np.int64)
            found = part.column("terms").flatten().to_numpy().astype(np.int64)
            tf = part.column("counts").flatten().to_numpy()
            m = np.repeat(100 - 75 + 75 * n * documents // length, sizes)
            values = weight[found] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            used, own = np.unique(found, return_inverse=True)
            place = np.full(len(weight), len(used))
            place[used] = np.arange(len(used))
            tree = Tree(np.concatenate([[0], np.cumsum(sizes)]), own, values, len(used))
            _search(tree, block, place[block.columns], len(used), part.column("id").to_pylist(), part.column("row").to_pylist(), best)
        rows = [(item, *found) for item, mine in zip(block.rows, best) for found in mine.found]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[3] for r in rows], kind),
             pa.array([r[4] for r in rows], pa.int64()), pa.array([-r[1] for r in rows], pa.int64())],
            ["item", "doc_id", "row", "score"],
        )

    return run


def _weights(index: DataFrame, items: Items) -> tuple[np.ndarray, int, int]:
    """The weight of every term of the block, the number of documents and their length."""
    total = index.agg(F.sum((F.col("n") > 0).cast("long")).alias("documents"), F.sum("n").alias("length")).first()
    held = np.zeros(len(items.numbers), np.int64)
    counted = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    for row in counted.collect():  # one row per term of the block
        held[row["term"]] = row["n"]
    documents, length = total["documents"] or 0, total["length"] or 0
    return np.floor(1000 * np.log((2 * documents + 2) / (2 * held + 1))).astype(np.int64), documents, length


def _search_block(docs: DataFrame, items: Items) -> DataFrame:
    """``item``, ``doc_id``, ``row`` and ``score``, the best documents of every task."""
    broadcast = docs.sparkSession.sparkContext.broadcast
    shared = broadcast(items)
    kind = docs.schema["id"].dataType.simpleString()
    index = materialize(
        docs.mapInArrow(_count_terms(shared), f"row bigint, id {kind}, n bigint, terms array<int>, counts array<bigint>"),
        "terms",
    )
    weights, documents, length = _weights(index, items)
    arrow = {"string": pa.string(), "int": pa.int32()}.get(kind, pa.int64())
    rank = _rank(shared, broadcast(weights), documents, max(length, 1), arrow)
    return index.where(F.size("terms") > 0).mapInArrow(rank, f"item bigint, doc_id {kind}, row bigint, score bigint")


def search(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id`` and ``score`` of each item's TOP documents."""
    number = F.monotonically_increasing_id()
    asked = materialize(items.select(number.alias("item"), F.col(item_id).alias("item_id"), F.col(item_text).alias("text")), "items")
    rows = docs.select(number.alias("row"), F.col(doc_id).alias("id"), F.col(text).alias("text"))
    size = asked.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("n")).first()
    blocks = 1 + max((size["bytes"] or 0) // QUERY_BYTES, size["n"] // QUERY_ITEMS)
    found = None
    for block in range(blocks):
        own = asked.where((F.pmod(F.xxhash64("item"), F.lit(blocks)) == block) & F.col("text").isNotNull())
        gathered = _gathered([(r["item"], r["text"]) for r in own.select("item", "text").collect()])
        if gathered.rows:
            part = materialize(_search_block(rows, gathered), "ranked")
            found = part if found is None else found.union(part)
    if found is None:
        kind = rows.schema["id"].dataType.simpleString()
        return asked.select("item_id").limit(0).selectExpr(
            "item_id", "cast(0 as int) as rank", f"cast(null as {kind}) as doc_id", "cast(0 as bigint) as score"
        )
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)
    return ranked.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
