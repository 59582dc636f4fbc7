"""Removal of byte strings that occur more than once, with sorted suffixes.

Every byte covered by a string of LENGTH bytes that also starts elsewhere is removed.
Such a string has the same least k-gram wherever it stands, so starts with the same least
k-gram (its anchor) are one fragment, and only fragments with equal anchors can share
a string:

* equal fragments are counted first, by hash; they need no sorting;
* anchors with a fragment that is alone and another one go to groups whose suffixes are
  sorted in two stages: suffixes smaller than their successors are sorted directly, the
  others are induced from them by scans over the buckets of their first byte. A start
  is repeated when its neighbour in the order has LENGTH bytes in common with it;
* an anchor with more than HOT_FRAGMENTS different fragments is not sorted in one
  task: its strings are counted one by one, by hash.

Hashes have 64 bits, and fragments are compared only under equal anchors.

Defined results: a null text is empty; texts shorter than LENGTH keep all bytes; the same
text in two rows (or a repeated row) is a repetition, so it loses all bytes if it is long
enough; ids are only carried along. An empty table gives an empty table. Other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.hashing import RangeHash, mix
from millrace.session import materialize

LENGTH = 200
KGRAM = 32
#: Starts of a text that are handled at a time; bounds memory for very long texts.
SEGMENT = 1 << 20
FRAGMENTS_PER_GROUP = 2000
HOT_FRAGMENTS = 32_768

_PLACE_BITS = 21
_FRAGMENT = "key binary, anchor long, content long, start long, starts long, times long"
_SPAN = "key binary, start long, starts long"


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values in a row."""
    rows = -(-len(values) // width)
    grid = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    grid[: len(values)] = values
    grid = grid.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(values) - width + 1
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def fragments(data: bytes, length: int = LENGTH, kgram: int = KGRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """Anchor, content hash, first start and number of starts of all fragments."""
    for begin in range(0, len(data) - length + 1, SEGMENT):
        part = data[begin : begin + SEGMENT + length - 1]
        hashed = RangeHash(part)
        at = np.arange(len(part) - kgram + 1)
        grams = hashed(at, at + kgram)
        places = at.astype(np.uint64)
        least = sliding_least(
            (grams >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | places, length - kgram + 1
        ) & np.uint64((1 << _PLACE_BITS) - 1)
        first = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
        ends = np.concatenate([first[1:], [len(least)]])
        anchor = grams[least[first].astype(np.int64)]
        content = mix(hashed(first, ends + length - 1) ^ (ends - first).astype(np.uint64))
        yield anchor.view(np.int64), content.view(np.int64), first + begin, ends - first


_FRAGMENT_TYPES = pa.schema([("key", pa.binary()), *((n, pa.int64()) for n in ("anchor", "content", "start", "starts", "times"))])


def _table(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _merge(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of ranges, as first values and lengths."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], (starts + counts)[order]
    reach = np.maximum.accumulate(ends)
    new = np.concatenate([[True], starts[1:] > reach[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(starts) - 1]])
    return starts[new], reach[last] - starts[new]


def _emit_fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct fragments of each text with their number. Those repeated within the text
    are also given as spans (``times`` is 0)."""
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            for anchor, content, start, starts in fragments(text.as_py().encode()):
                pairs = np.stack([anchor, content], axis=1)
                _, first, of, times = np.unique(pairs, axis=0, return_index=True, return_inverse=True, return_counts=True)
                columns = [anchor[first], content[first], start[first], starts[first], times]
                if len(first) < len(start):
                    again = times[of.ravel()] > 1
                    begin, count = _merge(start[again], starts[again])
                    nothing = np.zeros(len(begin), np.int64)
                    columns = [np.concatenate(c) for c in zip(columns, [nothing, nothing, begin, count, nothing])]
                yield _table([pa.array([key] * len(columns[0]), pa.binary()), *columns], _FRAGMENT_TYPES)


def _suffix_types(data: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its successor; the last one is not."""
    step = np.sign(np.diff(data.astype(np.int16), append=np.int16(-1)))
    at = np.where(step != 0, np.arange(len(data)), len(data))
    return step[np.minimum.accumulate(at[::-1])[::-1]] > 0


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` bytes, sorted in two stages."""
    size = len(data)
    smaller = _suffix_types(data)
    padded = np.concatenate([data, np.zeros(depth, np.uint8)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, depth)
    direct = np.flatnonzero(smaller)
    heads = padded[direct].astype(np.int64) * 256 + padded[direct + 1]
    direct = direct[np.argsort(heads, kind="stable")]
    edges = np.flatnonzero(np.diff(np.sort(heads), prepend=-1))
    for a, b in zip(edges, [*edges[1:], len(direct)]):
        rows = np.ascontiguousarray(windows[direct[a:b]]).view(f"S{depth}").ravel()
        direct[a:b] = direct[a:b][np.argsort(rows, kind="stable")]
    cuts = np.searchsorted(data[direct], np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    induced[data[-1]].append(np.array([size - 1]))
    order = []
    for byte in range(256):
        front = np.concatenate(induced[byte]) if induced[byte] else np.empty(0, np.int64)
        larger = []
        while len(front):
            larger.append(front)
            before = front[front > 0] - 1
            front = before[(data[before] == byte) & ~smaller[before]]
        bucket = np.concatenate([*larger, direct[cuts[byte] : cuts[byte + 1]]])
        order.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[data[before] > byte]
        following = data[before]
        spread = np.argsort(following, kind="stable")
        values, starts = np.unique(following[spread], return_index=True)
        for value, a, b in zip(values, starts, [*starts[1:], len(spread)]):
            induced[value].append(before[spread[a:b]])
    return np.concatenate(order)


def repeated_starts(pieces: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each byte string, where strings of ``length`` start that also start elsewhere
    in any of them."""
    between = b"\xff"  # no byte of UTF-8
    data = np.frombuffer(between.join(pieces) + between, np.uint8)
    ends = np.cumsum([len(piece) + 1 for piece in pieces]) - 1
    sizes = np.array([len(piece) for piece in pieces])
    whole = np.zeros(len(data), bool)
    for end, size in zip(ends, sizes):
        whole[end - size : max(end - length + 1, end - size)] = True
    order = suffix_array(data, length)
    order = order[whole[order]]
    windows = np.lib.stride_tricks.sliding_window_view(data, length) if len(data) >= length else None
    equal = np.zeros(max(0, len(order) - 1), bool)
    for at in range(0, len(equal), 1 << 16):
        a, b = order[at : at + (1 << 16)], order[at + 1 : at + 1 + (1 << 16)]
        equal[at : at + (1 << 16)] = (windows[a[: len(b)]] == windows[b]).all(axis=1)
    found = np.zeros(len(data), bool)
    found[order[:-1][equal]] = True
    found[order[1:][equal]] = True
    return [np.flatnonzero(found[end - size : end]) for end, size in zip(ends, sizes)]


_SPAN_TYPES = pa.schema([("key", pa.binary()), ("start", pa.int64()), ("starts", pa.int64())])


def _sort_group(group: pa.Table) -> pa.Table:
    """Repeated starts of the fragments that are alone, as spans of their text."""
    found = repeated_starts([bytes(piece) for piece in group.column("piece").to_pylist()])
    rows = []
    for key, start, single, own in zip(
        group.column("key").to_pylist(), group.column("start").to_pylist(), group.column("single").to_pylist(), found
    ):
        if single and len(own):
            begin, count = _merge(own, np.ones(len(own), np.int64))
            rows += [(key, start + int(b), int(c)) for b, c in zip(begin, count)]
    return pa.Table.from_batches([_table(list(zip(*rows)) if rows else [[], [], []], _SPAN_TYPES)])


_PIECE_TYPES = pa.schema([
    ("key", pa.binary()), ("start", pa.int64()), ("single", pa.bool_()), ("anchor", pa.int64()),
    ("hot", pa.bool_()), ("piece", pa.binary()),
])


def _cut_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for key, text, wanted in zip(*(batch.column(i) for i in range(3))):
            data = text.as_py().encode()
            for w in wanted.as_py():
                piece = data[w["start"] : w["start"] + w["starts"] + LENGTH - 1]
                rows.append((key.as_py(), w["start"], w["single"], w["anchor"], w["hot"], piece))
        yield _table(list(zip(*rows)) if rows else [[]] * 6, _PIECE_TYPES)


_STRING_TYPES = pa.schema([("key", pa.binary()), ("start", pa.int64()), ("anchor", pa.int64()), ("content", pa.int64())])


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every string of a piece, by its hash."""
    for batch in batches:
        for key, start, anchor, piece in zip(*(batch.column(n).to_pylist() for n in ("key", "start", "anchor", "piece"))):
            at = np.arange(len(piece) - LENGTH + 1)
            content = RangeHash(piece)(at, at + LENGTH).view(np.int64)
            yield _table([[key] * len(at), at + start, [anchor] * len(at), content], _STRING_TYPES)


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    words = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).alias("doc_id"), words.alias("text"), F.unhex(F.md5(words)).alias("key"))


def repeated_spans(rows: DataFrame) -> DataFrame:
    """``key`` and ``spans`` (start, starts) of repeated strings, from ``keyed`` documents."""
    spark = rows.sparkSession
    found = materialize(rows.select("key", "text").mapInArrow(_emit_fragments, _FRAGMENT), "fragments")
    anchors = found.where("times > 0").groupBy("anchor").agg(F.sum("times").alias("n")).where("n > 1").select("anchor")
    shared = materialize(found.where("times > 0").join(anchors, "anchor"), "shared")
    place = F.min(F.struct("key", "start", "starts")).alias("place")
    contents = materialize(shared.groupBy("anchor", "content").agg(F.sum("times").alias("n"), place), "contents")
    kinds = contents.groupBy("anchor").agg(
        F.count("*").alias("kinds"), F.count(F.when(F.col("n") == 1, 1)).alias("alone")
    ).where("kinds > 1 and alone > 0")
    wanted = contents.join(kinds, "anchor").select(
        "place.*", "anchor", (F.col("n") == 1).alias("single"), (F.col("kinds") > HOT_FRAGMENTS).alias("hot")
    )
    by_text = wanted.groupBy("key").agg(
        F.collect_list(F.struct("start", "starts", "anchor", "single", "hot")).alias("wanted")
    )
    texts = rows.select("key", "text").join(by_text, "key").dropDuplicates(["key"])
    pieces = materialize(
        texts.select("key", "text", "wanted").mapInArrow(
            _cut_pieces, "key binary, start long, single boolean, anchor long, hot boolean, piece binary"
        ),
        "pieces",
    )
    cold = pieces.where("not hot")
    groups = max(1, -(-cold.count() // FRAGMENTS_PER_GROUP))
    group = F.pmod(F.xxhash64("anchor"), F.lit(groups)).alias("group")
    spans = cold.select("*", group).groupBy("group").applyInArrow(_sort_group, _SPAN)
    strings = pieces.where("hot").select("key", "start", "anchor", "piece").mapInArrow(
        _strings, "key binary, start long, anchor long, content long"
    )
    again = strings.groupBy("anchor", "content").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    hot = strings.join(again, ["anchor", "content"]).select("key", "start", F.lit(1).cast("long").alias("starts"))
    twice = contents.where("n > 1").select("anchor", "content")
    equal = shared.join(twice, ["anchor", "content"]).select("key", "start", "starts")
    local = found.where("times = 0").select("key", "start", "starts")
    every = local.union(equal).union(spans).union(hot)
    return every.groupBy("key").agg(F.collect_set(F.struct("start", "starts")).alias("spans"))


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, sizes, removed = [], [], []
        for text, spans in zip(batch.column("text"), batch.column("spans")):
            data = text.as_py().encode()
            sizes.append(len(data))
            ranges = [(s["start"], s["starts"]) for s in spans.as_py() or ()]
            if not ranges:
                kept.append(data)
                removed.append([])
                continue
            starts, counts = (np.array(c) for c in zip(*ranges))
            begin, count = _merge(starts, counts + LENGTH - 1)
            ends = (begin + count).tolist()
            removed.append([{"start": a, "end": b} for a, b in zip(begin.tolist(), ends)])
            kept.append(b"".join(data[a:b] for a, b in zip([0, *ends], [*begin.tolist(), len(data)])))
        out = batch.drop_columns(["text", "spans"])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        arrays = [*out.columns, pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()), pa.array(removed, kind)]
        yield pa.RecordBatch.from_arrays(arrays, [*out.schema.names, "kept", "n_bytes", "removed"])


def remove_repeated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``kept`` (bytes), ``n_bytes`` and ``removed`` (array of start, end)."""
    rows = keyed(docs, doc_id, text)
    spans = materialize(repeated_spans(rows), "spans")
    joined = rows.join(spans, "key", "left").select("doc_id", "text", "spans")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(
        _remove, f"doc_id {kind}, kept binary, n_bytes long, removed array<struct<start: bigint, end: bigint>>"
    )


def shorten(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with repeated strings taken out of ``text``; a character that is cut in
    the middle goes as well. Other columns are unchanged; null stays null."""
    words = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"), words.alias("text"), F.unhex(F.md5(words)).alias("key"))
    spans = materialize(repeated_spans(rows.select("key", "text")), "spans")
    joined = rows.join(spans, "key", "left").select("row", "text", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _remove(batches):
            short = [v.as_py().decode(errors="ignore") for v in batch.column("kept")]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(short, pa.string())], ["row", "short"])

    row_type = joined.schema["row"].dataType.simpleString()
    cut_rows = joined.mapInArrow(cut, f"row {row_type}, short string")
    short = F.when(F.col(f"row.`{text}`").isNotNull(), F.col("short")).alias(text)
    return cut_rows.select(*(short if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns))
