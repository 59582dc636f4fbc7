"""Packing into token sequences by cutting-stock column generation.

A document is its token ids and an end id. It is cut into full sequences and a rest;
the rests are counted by length class, and the histogram is all the driver sees. A
linear program covers the histogram by patterns (how many pieces of each class share a
sequence); a knapsack over the dual prices finds the next pattern, until none is worth
more than the allowed gap. Whole parts of the solution are used as they are, what is
left is filled greedily by class. Pieces are ranked within their class, and the rank
gives the pattern copy, its sequence and the place there.

Length classes are exact up to CLASS_STEPS tokens and then 1/CLASS_STEPS of the length
wide, so their number (and with it the program and the broadcast pattern table) is
bounded by the sequence length alone, whatever the input. A piece never exceeds the size
of its class, so a pattern always fits.

Defined results: a null or empty text has the end id alone; repeated rows are packed one
by one; a null id is an id like others; an empty table gives no piece. Other columns are
ignored.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from millrace.llm.common import PieceMemory, in_chunks, texts
from millrace.session import materialize

SEQUENCE = 4096
END_ID = 2
CLASS_STEPS = 64
#: Column generation ends when the program is at most this far from its bound; a pattern
#: prices out when it is worth more than a sequence by this.
GAP = 0.0001
PRICED_OUT = 1e-9
#: A degenerate program may turn in a circle; every step is a cover, so it can be left.
STEPS_PER_CLASS = 4
#: Stands between words that are encoded in one call; it never joins with a word.
BETWEEN = "\x01"
WORDS_PER_CALL = 64
#: Words that a worker remembers (about 200 bytes each): as many recent ones, and as many
#: before them. Fewer take less memory and more time.
MEMORY_WORDS = 1 << 19


class WordTokenizer:
    """Ids of whole texts; words between ASCII white space are encoded once.

    The tokenizer drops white space and never joins across it, so a text's ids are
    those of its words one after another. Pickled as the tokenizer file's content.
    """

    def __init__(self, definition: str, memory_words: int = MEMORY_WORDS):
        self.definition, self.memory_words = definition, memory_words

    def __reduce__(self):
        return WordTokenizer, (self.definition, self.memory_words)

    def ready(self) -> WordTokenizer:
        key = zlib.crc32(self.definition.encode()), self.memory_words
        if key not in _READY:
            _READY.clear()
            # Spark has a worker per core already; threads of the tokenizer would be more.
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            self.tokenizer = Tokenizer.from_str(self.definition)
            normalizer = json.loads(self.definition).get("normalizer") or {}
            self.lowers = any(n["type"] == "Lowercase" for n in normalizer.get("normalizers", [normalizer]) if n)
            self.memory = PieceMemory(self._encode_words, self.memory_words)
            (self.between,) = self._ids(BETWEEN)
            _READY[key] = self
        return _READY[key]

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _encode_words(self, words: list[bytes]) -> Iterator[bytes]:
        """Codes of words, many in one call; ids of the mark between them cut the result."""
        for at in range(0, len(words), WORDS_PER_CALL):
            some = [word.decode() for word in words[at : at + WORDS_PER_CALL]]
            ids = np.array(self._ids(f" {BETWEEN} ".join(some)), "<u4")
            cuts = np.flatnonzero(ids == self.between)
            if len(cuts) != len(some) - 1:
                yield from (np.array(self._ids(word), "<u4").tobytes() for word in some)
                continue
            code = ids.tobytes()
            edges = [-1, *cuts.tolist(), len(ids)]
            yield from (code[4 * a + 4 : 4 * b] for a, b in zip(edges, edges[1:]))

    def encode(self, values: list[str]) -> list[bytes]:
        """Ids of each text as packed little-endian unsigned 32-bit integers.

        Where the tokenizer lowers all letters, ASCII ones are lowered at once, which
        leaves fewer different words.
        """
        data = map(str.encode, values)
        return self.memory.encode([text.split() for text in (map(bytes.lower, data) if self.lowers else data)])


_READY: dict[tuple[int, int], WordTokenizer] = {}


def class_size(length: int, steps: int = CLASS_STEPS) -> int:
    """The size of the length class: ``length`` rounded up to its step."""
    step = 1 << max(0, (length - 1).bit_length() - steps.bit_length() + 1)
    return -(-length // step) * step


def _cut(tokenizer: WordTokenizer, sequence: int, keep_ids: bool, id_type: pa.DataType):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "size", "part", "local_rank"]
    kinds = [id_type, *[pa.int64()] * 7] + [pa.binary()] * keep_ids
    schema = pa.schema(list(zip(names + ["ids"] * keep_ids, kinds)))
    end = END_ID.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready, part, ranks = tokenizer.ready(), TaskContext.get().partitionId(), {}
        for batch in batches:
            rows = []
            coded = (ids for chunk in in_chunks(texts(batch.column(1))) for ids in ready.encode(chunk))
            for doc_id, ids in zip(batch.column(0).to_pylist(), coded):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, sequence):
                    piece = ids[4 * start : 4 * (start + sequence)]
                    length = len(piece) // 4
                    size = class_size(length)
                    rank = ranks.get(size, 0)
                    ranks[size] = rank + 1
                    row = (doc_id, start, length, zlib.crc32(piece), total, size, part, rank)
                    rows.append((*row, piece) if keep_ids else row)
            columns = zip(*rows) if rows else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], schema=schema)

    return cut


def pieces(
    docs: DataFrame, definition: str, doc_id: str = "doc_id", text: str = "text",
    sequence: int = SEQUENCE, keep_ids: bool = False, memory_words: int = MEMORY_WORDS,
) -> DataFrame:
    """Pieces with their class size, and their rank in the class within a partition."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType
    id_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind.simpleString()]
    schema = (
        f"doc_id {kind.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, "
        "size long, part long, local_rank long" + ", ids binary" * keep_ids
    )
    return rows.mapInArrow(_cut(WordTokenizer(definition, memory_words), sequence, keep_ids, id_type), schema)


def knapsack(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> np.ndarray:
    """How often each size is taken in a sequence of the greatest total price.

    Dynamic program over the capacity, one size after another. Taking a size again
    and again is a running maximum along every residue of the capacity.
    """
    best = [np.zeros(capacity + 1)]
    for size, price in zip(sizes.tolist(), prices):
        rows = -(-(capacity + 1) // size)
        grid = np.full(rows * size, -np.inf)
        grid[: capacity + 1] = best[-1]
        lift = np.repeat(np.arange(rows) * price, size)
        grid -= lift
        np.maximum.accumulate(grid.reshape(rows, size), axis=0, out=grid.reshape(rows, size))
        grid += lift
        best.append(grid[: capacity + 1])
    counts, room = np.zeros(len(sizes), np.int64), capacity
    for i in range(len(sizes) - 1, -1, -1):
        while room >= sizes[i] and best[i + 1][room] > best[i][room] + 1e-12:
            counts[i] += 1
            room -= int(sizes[i])
    return counts


def greedy_basis(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """One pattern per class in the order in which classes run out, and its amount."""
    m = len(sizes)
    columns, amounts, rest = np.zeros((m, m), np.int64), np.zeros(m), demand.astype(float)
    open_classes = list(np.argsort(-sizes))
    for k in range(m):
        pattern, room = columns[:, k], capacity
        for i in open_classes:
            pattern[i] = room // sizes[i]
            room -= pattern[i] * sizes[i]
        inside = np.flatnonzero(pattern)
        ratios = rest[inside] / pattern[inside]
        amounts[k] = ratios.min()
        rest -= amounts[k] * pattern
        open_classes.remove(inside[int(np.argmin(ratios))])
    return columns, amounts


def invert(matrix: np.ndarray) -> np.ndarray:
    """The inverse by elimination. It is small, and this needs no threads of a library,
    which may stop for good in a driver that has forked."""
    m = len(matrix)
    left, right = matrix.astype(float), np.eye(m)
    for k in range(m):
        pivot = k + int(np.argmax(np.abs(left[k:, k])))
        for side in (left, right):
            side[[k, pivot]] = side[[pivot, k]]
        scale = left[k, k]
        left[k] /= scale
        right[k] /= scale
        factors = left[:, k].copy()
        factors[k] = 0
        rows = np.flatnonzero(factors)
        left[rows] -= factors[rows, None] * left[k]
        right[rows] -= factors[rows, None] * right[k]
    return right


def solve(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = GAP) -> list[tuple[np.ndarray, int]]:
    """Patterns with their number of copies that cover ``demand`` exactly.

    The simplex method with generated columns. The basis starts with greedy
    patterns, each used until a class runs out. Prices are first drawn towards those of
    a program without waste (a size's share of the sequence), which calms them; the
    program's own prices decide. Every pricing bounds the program from below: prices at
    which no pattern is worth more than v prove that it needs (prices, demand) / v sequences. It
    ends when no pattern prices out, or when the bound, in whole sequences or but for
    the gap, has been reached.
    """
    m = len(sizes)
    ideal = sizes / capacity
    bound = float(ideal @ demand)  # no sequence is more than full
    columns, amounts = greedy_basis(sizes, demand, capacity)
    inverse = invert(columns)
    for _ in range(STEPS_PER_CLASS * m):
        prices = inverse.sum(axis=0)
        for share in (0.8, 0.0):
            drawn = share * ideal + (1 - share) * prices
            pattern = knapsack(sizes, drawn, capacity)
            bound = max(bound, float(drawn @ demand) / float(drawn @ pattern))
            value = float(prices @ pattern)
            if value > 1 + PRICED_OUT:
                break
        used = float(amounts.sum())
        if value <= 1 + PRICED_OUT or used <= (1 + gap) * bound or np.ceil(used - PRICED_OUT) <= np.ceil(bound - PRICED_OUT):
            break
        direction = (inverse * pattern).sum(axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            ratios = np.where(direction > 1e-9, amounts / direction, np.inf)
        leaving = int(np.argmin(ratios))
        step = ratios[leaving]
        if not np.isfinite(step):
            break
        amounts = np.maximum(amounts - step * direction, 0)
        amounts[leaving] = step
        inverse[leaving] /= direction[leaving]
        others = np.arange(m) != leaving
        inverse[others] -= np.outer(direction[others], inverse[leaving])
        columns[:, leaving] = pattern
    copies = np.floor(amounts + 1e-6).astype(np.int64)
    rest = demand - columns @ copies
    while (rest < 0).any():
        copies[int(np.argmax((columns[int(np.argmin(rest))] > 0) * (copies > 0)))] -= 1
        rest = demand - columns @ copies
    plan = [(columns[:, i], int(copies[i])) for i in range(m) if copies[i]]
    while rest.any():
        pattern, room = np.zeros(m, np.int64), capacity
        for i in np.argsort(-sizes):
            pattern[i] = min(rest[i], room // sizes[i])
            room -= pattern[i] * sizes[i]
        times = int(min(rest[i] // pattern[i] for i in np.flatnonzero(pattern)))
        plan.append((pattern, times))
        rest = rest - times * pattern
    return plan


def slots(sizes: np.ndarray, plan: list[tuple[np.ndarray, int]]) -> list[tuple[int, ...]]:
    """Which ranks of a class go to which copies of a pattern.

    Rows: size, first rank, end rank, pieces of the class in a copy, first sequence,
    place of the class in the pattern.
    """
    used, first, rows = np.zeros(len(sizes), np.int64), 0, []
    for pattern, copies in plan:
        for place, i in enumerate(np.flatnonzero(pattern)[::-1]):
            count = int(pattern[i])
            rows.append((int(sizes[i]), int(used[i]), int(used[i]) + count * copies, count, first, place))
            used[i] += count * copies
        first += copies
    return rows


def pack(
    docs: DataFrame, definition: str, doc_id: str = "doc_id", text: str = "text",
    sequence: int = SEQUENCE, keep_ids: bool = False, memory_words: int = MEMORY_WORDS,
) -> DataFrame:
    """Pieces with ``sequence_id``, ``offset``, and the ``padding`` of their sequence.

    ``definition`` is the content of a tokenizer file. With ``keep_ids`` the packed
    ids of a piece are returned as well.
    """
    spark = docs.sparkSession
    cut = materialize(pieces(docs, definition, doc_id, text, sequence, keep_ids, memory_words), "pieces")
    counts = cut.groupBy("size", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    histogram = sorted((r["size"], r["n"]) for r in counts.groupBy("size").agg(F.sum("n").alias("n")).collect())
    sizes = np.array([size for size, _ in histogram], np.int64)
    plan = solve(sizes, np.array([n for _, n in histogram], np.int64), sequence) if histogram else []
    table = spark.createDataFrame(
        slots(sizes, plan), "size long, low long, high long, count long, base long, place long"
    )
    ranked = cut.drop("ids").join(firsts, ["size", "part"]).withColumn("rank", F.col("first") + F.col("local_rank"))
    placed = ranked.join(
        F.broadcast(table).withColumnRenamed("size", "class_size"),
        (F.col("size") == F.col("class_size")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")),
    )
    within = F.col("rank") - F.col("low")
    placed = placed.withColumn("sequence_id", F.col("base") + F.expr("(rank - low) div count")).withColumn(
        "slot", F.col("place") * (sequence + 1) + within % F.col("count")
    )
    order = Window.partitionBy("sequence_id").orderBy("slot")
    total = F.sum("length").over(Window.partitionBy("sequence_id"))
    piece = ["part", "size", "local_rank"]
    is_power = F.bit_count(F.col("total")) == 1
    packed = (
        placed.withColumn("offset", F.sum("length").over(order) - F.col("length"))
        .withColumn("total", total)
        .select(
            "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
            F.when(is_power, 0).otherwise(sequence - F.col("total")).cast("long").alias("padding"),
            *piece,
        )
    )
    # The ids join last, so they are shuffled once and not with each step.
    return packed.join(cut.select(*piece, "ids"), piece).drop(*piece) if keep_ids else packed.drop(*piece)
