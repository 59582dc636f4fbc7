"""Byte-level BPE by prefix dynamic programming.

For every prefix of a byte string exactly one token can be the last of its encoding.
``Prefixes`` stores that token per prefix. A token may follow the last token of the
prefix before it when no merge would have joined the two across their border. Tokens
of a string are read by walking the stored last tokens backwards. Appending bytes only
adds entries; an edit recomputes entries from its place until they repeat the old ones.

Documents are cut by the public split pattern, and each piece is encoded alone.
Defined results: a null or empty text has no tokens and decodes to the empty text; a
vocabulary must hold all 256 bytes. A text that is no valid UTF-8 does not occur in
Spark strings; any byte string round-trips. Equal texts have equal ids, each row keeps its
own; an empty table gives an empty one; other columns are not touched, whatever their names.
A very long text is encoded whole, and a worker holds the ids of one Arrow batch.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, functions as F

from millrace.llm.common import PieceMemory, in_chunks, texts

#: Checked neighbours of tokens that a Python worker remembers.
MEMORY_BORDERS = 1 << 19
#: Ids that are decoded at a time.
DECODE_IDS = 1 << 20

INFINITE = 1 << 62


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Vocabulary:
    """Ranks, and what is derived from them: how each token was merged together."""

    def __init__(self, ranks: dict[bytes, int]):
        if any(bytes([value]) not in ranks for value in range(256)):
            raise ValueError("a byte-level vocabulary needs a token for each byte")
        self.ranks = ranks
        self.token_bytes = {rank: token for token, rank in ranks.items()}
        #: All tokens one after another, with the place and the size of each rank.
        ordered = sorted(self.token_bytes.items())
        self.blob = np.frombuffer(b"".join(token for _, token in ordered), np.uint8)
        self.sizes, self.places = np.zeros((2, max(self.token_bytes) + 1), np.int64)
        numbers = [rank for rank, _ in ordered]
        self.sizes[numbers] = [len(token) for _, token in ordered]
        self.places[numbers] = np.cumsum(self.sizes[numbers]) - self.sizes[numbers]
        self.halves: dict[int, tuple[int, int]] = {}
        self.pairs: dict[tuple[int, int], int] = {}
        self.reached: dict[bytes, int] = {}
        for rank, token in sorted(self.token_bytes.items()):
            halves = self._last_merge(token, rank)
            if len(token) == 1 or halves:
                self.reached[token] = rank
            if halves:
                self.halves[rank] = halves
                self.pairs[halves] = rank
        self.longest = max(map(len, self.reached))
        self.length = {rank: len(token) for token, rank in self.reached.items()}
        #: Finds all tokens that end at each byte; it knows text, so bytes are given as Latin-1.
        self.endings = ahocorasick.Automaton()
        for token, rank in self.reached.items():
            self.endings.add_word(token.decode("latin-1"), rank)
        self.endings.make_automaton()
        self._edges: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.borders: dict[tuple[int, int], bool] = {}

    def _last_merge(self, token: bytes, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge made ``token``; None when merges never make it."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            joined = [self.ranks.get(a + b, INFINITE) for a, b in zip(parts, parts[1:])]
            best = min(joined)
            if best >= rank:
                return None
            at = joined.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Tokens that stood at one edge while ``token`` was merged, each with the
        rank of the merge that took it in."""
        found = self._edges.get((token, side))
        if found is None:
            found, end = [], INFINITE
            at: int | None = token
            while at is not None:
                found.append((at, end))
                end = at
                halves = self.halves.get(at)
                at = halves[side] if halves else None
            self._edges[token, side] = found
        return found

    def may_follow(self, left: int, right: int) -> bool:
        """Whether merges leave ``left`` and ``right`` apart when they are neighbours.

        They are joined if some edge token of ``left`` and some of ``right`` merge
        before either is taken in. Merges of one rank go from left to right.
        """
        answer = not any(
            (rank := self.pairs.get((a, b))) is not None and rank < end_a and rank <= end_b
            for a, end_a in self._edge(left, 1)
            for b, end_b in self._edge(right, 0)
        )
        if len(self.borders) >= MEMORY_BORDERS:
            self.borders.clear()
        self.borders[left, right] = answer
        return answer


def add_last_tokens(
    vocabulary: Vocabulary, data: bytes, last: list[int], done: Callable[[int], bool] | None = None
) -> None:
    """Complete ``last``, the last token of every prefix of ``data``, from its end on.

    ``done`` sees each new entry and may end the work early.
    """
    length, known, check = vocabulary.length, vocabulary.borders.get, vocabulary.may_follow
    count = len(last)
    reach = max(0, count - vocabulary.longest)
    for at, token in vocabulary.endings.iter(data.decode("latin-1"), reach):
        if at < count:
            continue
        begin = at - length[token]
        if begin >= 0:
            left = last[begin]
            answer = known((left, token))
            if answer is None:
                answer = check(left, token)
            if not answer:
                continue
        last.append(token)
        count += 1
        if done and done(token):
            return


def read_back(vocabulary: Vocabulary, last: list[int]) -> list[int]:
    """The tokens of the whole string, from its stored last tokens."""
    length, found, end = vocabulary.length, [], len(last) - 1
    while end >= 0:
        token = last[end]
        found.append(token)
        end -= length[token]
    found.reverse()
    return found


class Prefixes:
    """The last token of every prefix of a byte string."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary = vocabulary
        self.data = b""
        self.last: list[int] = []
        self.append(data)

    def append(self, more: bytes) -> None:
        """Add bytes at the end; entries of the old prefixes stay as they are."""
        self.data += more
        add_last_tokens(self.vocabulary, self.data, self.last)

    def edit(self, start: int, stop: int, new: bytes) -> int:
        """Replace ``data[start:stop]``; returns how many entries were computed anew.

        An entry depends on the bytes and entries of the longest token before it, so
        after as many unchanged entries in a row the rest is the old one.
        """
        old_tail = self.last[stop:]
        tail = self.data[stop:]
        self.data = self.data[:start] + new + tail
        del self.last[start:]
        same = computed = 0

        def repeats(token: int) -> bool:
            nonlocal same, computed
            computed += 1
            place = computed - len(new) - 1
            same = same + 1 if place >= 0 and old_tail[place] == token else 0
            return same > self.vocabulary.longest

        add_last_tokens(self.vocabulary, self.data, self.last, repeats)
        self.last.extend(old_tail[computed - len(new) :] if computed >= len(new) else ())
        return computed

    def tokens(self) -> list[int]:
        return read_back(self.vocabulary, self.last)


class Codec:
    """Encodes and decodes whole texts; pickled as ranks and pattern alone."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern

    def __reduce__(self):
        return Codec, (self.ranks, self.pattern)

    def ready(self) -> Codec:
        """This codec with its tables; one per process for the same vocabulary."""
        if self in _READY.values():
            return self
        key = (hash(self.pattern), len(self.ranks), hash(frozenset(self.ranks.items())))
        if key not in _READY:
            _READY.clear()
            self.vocabulary = Vocabulary(self.ranks)
            self.split = regex.compile(self.pattern).findall
            self.memory = PieceMemory(self._encode_pieces)
            _READY[key] = self
        return _READY[key]

    def _encode_pieces(self, pieces: list[str]) -> Iterator[bytes]:
        """Codes of sorted pieces; a piece keeps the entries of the prefix it shares
        with the one before."""
        last: list[int] = []
        before = b""
        for piece in pieces:
            data = piece.encode()
            whole = self.vocabulary.ranks.get(data)
            if whole is not None:
                yield whole.to_bytes(4, "little")
                continue
            shared = 0
            for a, b in zip(before, data):
                if a != b:
                    break
                shared += 1
            del last[shared:]
            add_last_tokens(self.vocabulary, data, last)
            before = data
            tokens = read_back(self.vocabulary, last)
            yield struct.pack(f"<{len(tokens)}i", *tokens)

    def encode(self, values: list[str]) -> list[bytes]:
        """Token ids of each text as packed little-endian 32-bit integers."""
        return self.memory.encode([self.split(text) for text in values])

    def decode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of all ids, and the size of each id's token."""
        vocabulary, out = self.vocabulary, []
        sizes = vocabulary.sizes[ids]
        for at in range(0, len(ids), DECODE_IDS):
            size = sizes[at : at + DECODE_IDS]
            ends = np.cumsum(size)
            shift = vocabulary.places[ids[at : at + DECODE_IDS]] - (ends - size)
            out.append(vocabulary.blob[np.arange(ends[-1]) + np.repeat(shift, size)].tobytes())
        return b"".join(out), sizes


_READY: dict[tuple, Codec] = {}


def _encoded(codec: Codec, values: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The ids of each text, and all of them in one run."""
    packed = [ids for chunk in in_chunks(texts(values)) for ids in codec.encode(chunk)]
    ends = np.cumsum([0, *(len(ids) // 4 for ids in packed)])
    flat = np.frombuffer(b"".join(packed), "<i4")
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)), flat


def _decoded(codec: Codec, flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    """The bytes of each run of ``counts`` ids."""
    data, sizes = codec.decode(flat)
    ends = np.concatenate([[0], np.cumsum(counts)])
    offsets = np.concatenate([[0], np.cumsum(sizes)])[ends].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def encode(text: Column, codec: Codec) -> Column:
    """Token ids (array of int) of a text column."""
    return F.arrow_udf(lambda values: _encoded(codec.ready(), values)[0], "array<int>")(text)


def decode(ids: Column, codec: Codec) -> Column:
    """The bytes of an array of token ids; null stands for no tokens."""

    def batch(values: pa.Array) -> pa.Array:
        counts = values.value_lengths().fill_null(0).to_numpy()
        return _decoded(codec.ready(), values.flatten().to_numpy(zero_copy_only=False), counts)

    return F.arrow_udf(batch, "binary")(ids)


def round_trip(text: Column, codec: Codec) -> Column:
    """``ids`` and the bytes ``decoded`` from them. ``decode`` of an ``encode`` whose ids are
    used as well would encode every text twice; here texts and ids cross to Python once."""

    def batch(values: pa.Array) -> pa.Array:
        ready = codec.ready()
        ids, flat = _encoded(ready, values)
        decoded = _decoded(ready, flat, ids.value_lengths().to_numpy())
        return pa.StructArray.from_arrays([ids, decoded], ["ids", "decoded"])

    return F.arrow_udf(batch, "struct<ids: array<int>, decoded: binary>")(text)
