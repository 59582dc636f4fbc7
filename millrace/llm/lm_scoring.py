"""Language-model scoring by deleted interpolation.

The probability of a token after its predecessor mixes the maximum-likelihood estimates
of the pair and of the token with a uniform floor. The mixture depends on how often the
predecessor was seen (one set of weights per power of two). Weights are learned by
expectation-maximisation on the tokens of a deleted part of the training documents,
against counts that leave this part out; scores use the counts of all training
documents.

Counts are of all documents and grow with them, so no table of them is ever sent to all
tasks. Documents are written as blocks of word numbers. A block asks for the counts of
its distinct keys (64-bit hashes of tokens and pairs), cut by key range; each range adds
up what all blocks bring and answers each of them. A frequent key comes once per
block, so no range is hot. The driver sees the weights and two totals.

Defined results: a null text is empty and has the end token alone; documents are
scored row by row, so repeated rows get equal scores; a null document id is kept. With
no training document N and V are 0 and every score is 0. An empty table gives an empty
table. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.hashing import mix
from millrace.session import materialize

BLOCK_TOKENS = 1_500_000
ROUNDS = 12
#: Weights stop when the mean log10 likelihood of the deleted part gains less.
LEAST_GAIN = 1e-5

_BLOCK = "block long, doc_ids array<{}>, lengths array<int>, train array<boolean>, " \
    "deleted array<boolean>, tokens binary, hashes binary"
_REQUEST = "bucket int, block long, kind int, keys binary, counts binary"
_ANSWER = "block long, kind int, bucket int, counts binary, types long, tokens long"
_SCORED = "doc_ids array<{}>, ends array<int>, known array<int>, base array<double>, " \
    "cells binary, cell_counts binary, deleted_cells binary"


def _shrink(values: np.ndarray) -> bytes:
    """Compressed integers, byte planes apart so that small ones take little room."""
    flat = np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8)
    return zstandard.compress(flat.T.tobytes(), 1)


def _grow(data: bytes) -> np.ndarray:
    flat = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(flat.T).view("<u8").ravel()


def _keys_out(keys: np.ndarray) -> bytes:
    return _shrink(np.diff(keys, prepend=np.uint64(0)))


def _keys_in(data: bytes) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumsum(_grow(data), dtype=np.uint64)


END = b""


class _BlockBuilder:
    def __init__(self):
        self.numbers = {END: 0}
        self.parts: list[np.ndarray] = []
        self.ids, self.lengths, self.train, self.deleted = [], [], [], []
        self.tokens = 0

    def add(self, doc_id, text: str, train: bool, deleted: bool) -> None:
        words = text.encode().lower().split()
        number, known = self.numbers.setdefault, self.numbers
        part = np.fromiter((number(w, len(known)) for w in words), np.uint32, len(words))
        self.parts += [part, np.zeros(1, np.uint32)]
        self.ids.append(doc_id)
        self.lengths.append(len(words) + 1)
        self.train.append(bool(train))
        self.deleted.append(bool(deleted))
        self.tokens += len(words) + 1

    def row(self, block: int) -> tuple:
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, self.numbers), np.uint64, len(self.numbers))
        tokens = zstandard.compress(np.concatenate(self.parts).tobytes(), 1)
        return block, self.ids, self.lengths, self.train, self.deleted, tokens, hashes.tobytes()


def _blocks(schema: pa.Schema, size: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        builder = _BlockBuilder()
        for batch in batches:
            for doc_id, text, train, deleted in zip(*(batch.column(i) for i in range(4))):
                builder.add(doc_id.as_py(), text.as_py() or "", train.as_py(), deleted.as_py())
                if builder.tokens >= size:
                    yield _record([builder.row(block)], schema)
                    block, builder = block + 1, _BlockBuilder()
        if builder.ids:
            yield _record([builder.row(block)], schema)

    return build


def _record(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of all batches; one at a time is held as Python objects."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _groups(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct value, by value, and the number of each place's value."""
    order = np.argsort(values)
    ordered = values[order]
    new = np.ones(len(values), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    del ordered
    of = np.empty(len(values), np.uint32)
    of[order] = np.cumsum(new, dtype=np.uint32) - np.uint32(1)
    return order[new], of


class _Block:
    """A stored block: tokens, predecessors, and distinct keys of tokens and pairs."""

    def __init__(self, tokens: bytes, hashes: bytes, lengths: list[int]):
        words = np.frombuffer(hashes, np.uint64)
        self.tokens = np.frombuffer(zstandard.decompress(tokens), np.uint32)
        self.ends = np.cumsum(lengths)
        before = np.concatenate([[np.uint32(0)], self.tokens[:-1]])
        with np.errstate(over="ignore"):
            pairs = (mix(words) * np.uint64(3))[before]
            pairs += words[self.tokens]
            pairs = mix(pairs)
        first, self.pair_of = _groups(pairs)
        self.pair_keys = pairs[first]
        #: Word numbers of the predecessor and the token of each distinct pair.
        self.pair_words = before[first], self.tokens[first]
        #: Word numbers by key.
        self.word_order = np.argsort(words)
        self.word_keys = words[self.word_order]

    def ask(self, parts: list[np.ndarray]) -> list[tuple[int, np.ndarray, list[np.ndarray]]]:
        """The distinct keys of each kind with their counts in parts of the tokens."""
        words = [np.bincount(self.tokens[part], minlength=len(self.word_keys))[self.word_order] for part in parts]
        pairs = [np.bincount(self.pair_of[part], minlength=len(self.pair_keys)) for part in parts]
        return [(1, self.word_keys, words), (2, self.pair_keys, pairs)]


_REQUEST_TYPES = pa.schema([
    ("bucket", pa.int32()), ("block", pa.int64()), ("kind", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())
])
_ANSWER_TYPES = pa.schema([
    ("block", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int32()), ("counts", pa.binary()),
    ("types", pa.int64()), ("tokens", pa.int64()),
])


def _block_requests(row: dict, bits: int) -> pa.RecordBatch:
    parts = [np.repeat(row[name], row["lengths"]) for name in ("train", "deleted")]
    kinds = _Block(row["tokens"], row["hashes"], row["lengths"]).ask(parts)
    edges = np.array([i << (64 - bits) for i in range(1, 1 << bits)], np.uint64)
    rows = []
    for kind, keys, counts in kinds:
        cuts = [0, *np.searchsorted(keys, edges), len(keys)]
        rows += [
            (i, row["block"], kind, _keys_out(keys[a:b]), _shrink(np.concatenate([c[a:b] for c in counts])))
            for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a
        ]
    return _record(rows, _REQUEST_TYPES)


def _requests(bits: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            yield _block_requests(row, bits)

    return ask


def _answer(requests: pa.Table) -> pa.Table:
    """Add up the counts of a key range and answer each block that asked."""
    bucket, kind = requests.column("bucket")[0].as_py(), requests.column("kind")[0].as_py()
    keys = [_keys_in(data.as_py()) for data in requests.column("keys")]
    counts = [_grow(data.as_py()).reshape(2, -1) for data in requests.column("counts")]
    distinct, of = np.unique(np.concatenate(keys), return_inverse=True)
    sums = [
        np.bincount(of, np.concatenate([c[i] for c in counts]), len(distinct)).astype(np.uint64) for i in (0, 1)
    ]
    rows, at = [], 0
    types, tokens = int(np.count_nonzero(sums[0])), int(sums[0].sum())
    for block, own in zip(requests.column("block").to_pylist(), keys):
        mine = of[at : at + len(own)]
        at += len(own)
        rows.append((block, kind, bucket, _shrink(np.concatenate([s[mine] for s in sums])), types, tokens))
        types = tokens = 0
    return pa.Table.from_batches([_record(rows, _ANSWER_TYPES)])


def _distinct(rows: Iterator[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct column of a table of counts, and the number of each column's one."""
    code = np.zeros(size, np.int64)
    for row in rows:
        if (int(code.max(initial=0)) + 1) * (int(row.max(initial=0)) + 1) >= 1 << 62:
            code, row = (_groups(values)[1].astype(np.int64) for values in (code, row))
        code *= int(row.max(initial=0)) + 1
        code += row
    return _groups(code)


def _answered(answers: list[dict], kind: int) -> list[np.ndarray]:
    """Counts of all training and of deleted tokens, for a block's keys of one kind in order."""
    own = sorted((a for a in answers if a["kind"] == kind), key=lambda a: a["bucket"])
    pieces = [_grow(a["counts"]).view(np.int64).reshape(2, -1) for a in own]
    return [np.concatenate([piece[part] for piece in pieces]) for part in (0, 1)]


def _triples(before: np.ndarray, after: np.ndarray, word: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct counts of predecessor, token and pair, and the number of each pair's triple."""
    at, of = _distinct((pair if words is None else word[words] for words in (before, after, None)), len(pair))
    return np.stack([word[before[at]], word[after[at]], pair[at]]), of


def _block_cells(row: dict, schema: pa.Schema, types: int, tokens: int) -> pa.RecordBatch:
    block = _Block(row["tokens"], row["hashes"], row["lengths"])
    del block.pair_keys
    word, less = np.empty((2, len(block.word_keys)), np.int64)
    word[block.word_order], less[block.word_order] = _answered(row["answers"], 1)
    pair, pair_less = _answered(row["answers"], 2)
    before, after = block.pair_words
    held_of = block.pair_of[np.repeat(row["deleted"], row["lengths"])]
    times = np.bincount(held_of, minlength=len(pair))
    held = np.flatnonzero(times)
    kept, kept_of = _triples(before[held], after[held], word - less, pair[held] - pair_less[held])
    kept_times = np.bincount(kept_of, times[held], kept.shape[1]).astype(np.int64)
    deleted_cells = _shrink(np.concatenate([kept, kept_times[None]]).ravel())
    del pair_less, held_of, times, held, kept, kept_of
    cells, cell_of_pair = _triples(before, after, word, pair)
    cell_of = zstandard.compress(cell_of_pair.astype("<u4", copy=False)[block.pair_of].tobytes(), 1)
    starts = np.concatenate([[0], block.ends[:-1]])
    base = np.add.reduceat(np.log10((word + 1) / (tokens + types + 1))[block.tokens], starts)
    known = np.add.reduceat((word > 0)[block.tokens], starts, dtype=np.int64)
    return _record([(
        row["doc_ids"], block.ends.tolist(), known.tolist(), base.tolist(), cell_of, _shrink(cells.ravel()), deleted_cells,
    )], schema)


def _cells(schema: pa.Schema, types: int, tokens: int):
    """Per block, the distinct count triples (predecessor, token, pair) and where they occur."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            yield _block_cells(row, schema, types, tokens)

    return join


def context_bucket(seen: np.ndarray) -> np.ndarray:
    """The power of two of a context's frequency; 0 for an unseen one."""
    return np.ceil(np.log2(seen + 1.0)).astype(np.int64)


def estimates(cells: np.ndarray, types: int, tokens: int) -> np.ndarray:
    """Pair, token and uniform estimates of count triples (predecessor, token, pair)."""
    before, after, pair = cells.astype(float)
    return np.stack([
        np.divide(pair, before, out=np.zeros_like(pair), where=before > 0),
        after / max(tokens, 1),
        np.full_like(pair, 1 / (types + 1)),
    ])


def _expect(weights: dict[int, list[float]], types: int, tokens: int):
    """Expected uses of each estimate, by context bucket, over the deleted tokens."""
    schema = pa.schema([("bucket", pa.int64()), *((n, pa.float64()) for n in ("pair", "token", "floor", "gain", "n"))])

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for data in batch.column(0):
                table = _grow(data.as_py()).astype(np.int64).reshape(4, -1)
                cells, times = table[:3], table[3]
                buckets = context_bucket(cells[0])
                parts = estimates(cells, types, tokens)
                parts *= mixtures(weights)[:, buckets]
                total = parts.sum(axis=0)
                found = np.stack([*(parts / total * times), np.log10(total) * times, times.astype(float)])
                for bucket in np.unique(buckets):
                    sums[int(bucket)] = sums.get(int(bucket), 0) + found[:, buckets == bucket].sum(axis=1)
        yield _record([(bucket, *map(float, values)) for bucket, values in sums.items()], schema)

    return expect


START = [0.4, 0.3, 0.3]


def mixtures(weights: dict[int, list[float]]) -> np.ndarray:
    """The weights of the three estimates, a column for each context bucket of a 64-bit count."""
    return np.array([weights.get(bucket, START) for bucket in range(65)]).T


def learn_weights(scored: DataFrame, types: int, tokens: int, rounds: int = ROUNDS) -> dict[int, list[float]]:
    """Mixture weights per context bucket; one pass over the deleted counts per round."""
    weights: dict[int, list[float]] = {}
    last = -np.inf
    events = scored.select("deleted_cells")
    for _ in range(rounds):
        rows = events.mapInArrow(
            _expect(weights, types, tokens),
            "bucket long, pair double, token double, floor double, gain double, n double",
        )
        names = ("pair", "token", "floor", "gain", "n")
        sums = rows.groupBy("bucket").agg(*(F.sum(name).alias(name) for name in names)).collect()
        if not sums:
            break
        # One use is added to each estimate, so that no weight becomes zero.
        weights = {
            row["bucket"]: [(row[name] + 1) / (row["n"] + 3) for name in ("pair", "token", "floor")] for row in sums
        }
        gain = sum(row["gain"] for row in sums) / max(1.0, sum(row["n"] for row in sums))
        if gain - last < LEAST_GAIN:
            break
        last = gain
    return weights


def _scores(weights: dict[int, list[float]], types: int, tokens: int, id_type: pa.DataType):
    schema = pa.schema([
        ("doc_id", id_type), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()),
        ("score", pa.float64()),
    ])

    def of_block(row: dict) -> pa.RecordBatch:
        cells = _grow(row["cell_counts"]).astype(np.int64).reshape(3, -1)
        logs = np.zeros(cells.shape[1])
        if tokens:
            parts = estimates(cells, types, tokens)
            parts *= mixtures(weights)[:, context_bucket(cells[0])]
            logs = np.log10(parts.sum(axis=0))
        each = logs[np.frombuffer(zstandard.decompress(row["cells"]), "<u4")]
        ends = np.array(row["ends"])
        starts = np.concatenate([[0], ends[:-1]])
        return pa.RecordBatch.from_arrays([
            pa.array(row["doc_ids"], id_type), pa.array(ends - starts, pa.int64()),
            pa.array(row["known"], pa.int64()), pa.array(row["base"], pa.float64()),
            pa.array(np.add.reduceat(each, starts), pa.float64()),
        ], schema=schema)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            yield of_block(row)

    return score


def score(
    docs: DataFrame, train: Column, deleted: Column, doc_id: str = "doc_id", text: str = "text",
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    ``train`` marks the training documents; ``deleted`` those of them that the weights
    are learned on.
    """
    train, deleted = F.coalesce(train, F.lit(False)), F.coalesce(deleted, F.lit(False))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), train.alias("train"), (train & deleted).alias("deleted")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    id_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    block_schema = pa.schema([
        ("block", pa.int64()), ("doc_ids", pa.list_(id_type)), ("lengths", pa.list_(pa.int32())),
        ("train", pa.list_(pa.bool_())), ("deleted", pa.list_(pa.bool_())), ("tokens", pa.binary()), ("hashes", pa.binary()),
    ])
    blocks = materialize(rows.mapInArrow(_blocks(block_schema, block_tokens), _BLOCK.format(kind)), "blocks")
    bits = max(3, (blocks.count() - 1).bit_length())
    answers = blocks.mapInArrow(_requests(bits), _REQUEST).groupBy("kind", "bucket").applyInArrow(_answer, _ANSWER)
    by_block = materialize(
        answers.groupBy("block").agg(
            F.collect_list(F.struct("kind", "bucket", "counts")).alias("answers"),
            F.sum(F.when(F.col("kind") == 1, F.col("types"))).alias("types"),
            F.sum(F.when(F.col("kind") == 1, F.col("tokens"))).alias("tokens"),
        ),
        "answers",
    )
    totals = by_block.agg(F.sum("types").alias("types"), F.sum("tokens").alias("tokens")).first()
    types, tokens = totals["types"] or 0, totals["tokens"] or 0
    cell_schema = pa.schema([
        ("doc_ids", pa.list_(id_type)), ("ends", pa.list_(pa.int32())), ("known", pa.list_(pa.int32())),
        ("base", pa.list_(pa.float64())), ("cells", pa.binary()), ("cell_counts", pa.binary()),
        ("deleted_cells", pa.binary()),
    ])
    joined = blocks.join(by_block.select("block", "answers"), "block")
    scored = materialize(joined.mapInArrow(_cells(cell_schema, types, tokens), _SCORED.format(kind)), "cells")
    weights = learn_weights(scored, types, tokens) if tokens else {}
    result = scored.mapInArrow(
        _scores(weights, types, tokens, id_type),
        f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double",
    )
    return result.withColumn("train_tokens", F.lit(tokens).cast("long"))
