"""What several operators share: tables, Arrow helpers and stable row folds."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: White space between words, as bytes: exactly what ``bytes.split()`` splits on.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id's decimal text modulo ``parts``; a null id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def texts(values: pa.Array) -> Iterable[str]:
    """The strings of a column, one at a time; null is the empty text."""
    for value in values:
        yield value.as_py() or ""


#: Bytes to bytes: ASCII letters in lower case, digits, and all that is not ASCII; else a space.
_TERM_BYTES = bytes(
    c if c >= 128 else ord(chr(c).lower()) if chr(c).isalnum() else ord(" ") for c in range(256)
)


def terms(text: str) -> list[bytes]:
    """The runs of ASCII letters (in lower case), digits and characters beyond ASCII."""
    return text.encode().translate(_TERM_BYTES).split()


def structs(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.Array:
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    arrays = [pa.array(column, kind) for column, kind in zip(columns, types)]
    return pa.StructArray.from_arrays(arrays, names)


def row_struct(fields: dict[str, str], one: Callable[[str], tuple]):
    """An Arrow UDF that maps one text to one struct with ``fields`` (name to type)."""
    kinds = {"bigint": pa.int64(), "boolean": pa.bool_(), "double": pa.float64(),
             "string": pa.string(), "binary": pa.binary()}
    types = [kinds[kind] for kind in fields.values()]
    names = list(fields)

    def batch(values: pa.Array) -> pa.Array:
        return structs([one(text) for text in texts(values)], names, types)

    schema = ", ".join(f"{name}: {kind}" for name, kind in fields.items())
    return F.arrow_udf(batch, f"struct<{schema}>")


#: Pieces that a Python worker remembers: as many recent ones, and as many before them.
MEMORY_PIECES = 3 << 17
CHUNK_CHARS = 1_000_000


def in_chunks(values: Iterable[str], chars: int = CHUNK_CHARS) -> Iterator[list[str]]:
    """Lists of texts of about ``chars`` characters; a longer text is a list of its own."""
    chunk, size = [], 0
    for text in values:
        if chunk and size + len(text) > chars:
            yield chunk
            chunk, size = [], 0
        chunk.append(text)
        size += len(text)
    if chunk:
        yield chunk


class PieceMemory:
    """Encodes lists of pieces; a piece seen a short while ago is not encoded again."""

    def __init__(self, encode_new: Callable[[list], Iterable[bytes]], limit: int = MEMORY_PIECES):
        self.encode_new, self.limit = encode_new, limit
        self.recent: dict = {}
        self.older: dict = {}

    def encode(self, pieces: list[list]) -> list[bytes]:
        """The joined codes of each list."""
        if len(self.recent) >= self.limit:
            self.older, self.recent = self.recent, {}
        new = []
        for piece in set().union(*pieces).difference(self.recent):
            code = self.older.get(piece)
            if code is None:
                new.append(piece)
            else:
                self.recent[piece] = code
        new.sort()
        self.recent.update(zip(new, self.encode_new(new)))
        code_of = self.recent.__getitem__
        return [b"".join(map(code_of, own)) for own in pieces]
