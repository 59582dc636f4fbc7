"""Quality rules by line-first cleaning.

Every line with a word is judged alone (terminal punctuation, navigation,
boilerplate, symbols, shouting, stuttering); failing lines are taken out; a
document that loses more than a share of its word characters is rejected. Two base
rules on the whole text come first: too few words, too many repeated words.

Defined results: a null text is empty; a text without a word has zero counts and is
rejected; blank lines weigh nothing and stay. Everything is computed from one text,
so equal rows get equal results, other columns do not matter, and an empty table
gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from millrace.llm.common import SPACE, row_struct, texts

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
#: Share of word characters that a kept document may lose, in percent.
MAX_LOST_PERCENT = 30
#: A shorter line needs terminal punctuation.
LONG_LINE_WORDS = 8
#: A line of more words fails for boilerplate only if such phrases are half of it.
BOILERPLATE_LINE_WORDS = 20

SYMBOLS = "#*$%&|<>"
SEPARATORS = "|»›•·"
TERMINAL = ".!?…:;\"'”’)]»।॥。！？；：」』）؟۔"
BOILERPLATE = (
    "all rights reserved|copyright|cookie|privacy policy|terms of use|terms of service|subscribe"
    "|sign up|log in|sign in|click here|read more|share this|javascript|lorem ipsum"
    "|permission is hereby granted|without warranty|licensed under"
)

_WORD = re.compile(rf"[^{SPACE}]+")
_BOILERPLATE = re.compile(BOILERPLATE, re.IGNORECASE | re.ASCII)
_SPACES = b" \t\n\x0b\x0c\r"

FIELDS = {
    "n_words": "bigint",
    "word_chars": "bigint",
    "n_symbols": "bigint",
    "n_dup_lines": "bigint",
    "n_repeat_words": "bigint",
    "base_failed": "boolean",
    "n_failed_lines": "bigint",
    "lost_chars": "bigint",
    "kept": "boolean",
    "clean_text": "string",
}


def _count(text: str, characters: str) -> int:
    return sum(map(text.count, characters))


def line_failure(line: str, words: list[bytes]) -> str | None:
    """The first rule that a line with words fails, or None."""
    n = len(words)
    if 4 * _count(line, SEPARATORS) >= n and _count(line, SEPARATORS) >= 2:
        return "navigation"
    if 10 * _count(line, SYMBOLS) > len(line):
        return "symbols"
    if n >= 3 and 2 * line.count("!") >= n:
        return "shouting"
    if n >= 8 and 2 * sum(map(bytes.__eq__, words, words[1:])) >= n:
        return "stutter"
    phrases = [m.end() - m.start() for m in _BOILERPLATE.finditer(line)]
    if phrases and (n <= BOILERPLATE_LINE_WORDS or 2 * sum(phrases) >= len(line)):
        return "boilerplate"
    if n < LONG_LINE_WORDS and line.rstrip(" \t\x0b\x0c\r")[-1] not in TERMINAL:
        return "punctuation"
    return None


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more.

    Window identity is exact: ids of single words are paired into ids of 2, 4 and
    8 words, and only places whose shorter window repeats are carried on.
    """
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    if len(numbers) > len(words) - window:
        return 0
    width = 1
    while width < window:
        pairs = ids[:-width] * (int(ids.max()) + 1) + ids[width:]
        distinct, ids = np.unique(pairs, return_inverse=True)
        if len(distinct) == len(pairs):
            return 0
        width *= 2
    starts = np.flatnonzero(np.bincount(ids)[ids] > 1)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int(np.count_nonzero(np.cumsum(edge)[:-1]))


def assess(text: str) -> tuple:
    """One text to the values of FIELDS."""
    words = text.encode().split()
    word_chars = len(text) - _count(text, _SPACES.decode())
    kept_lines, seen = [], set()
    dup_lines = failed_lines = lost = 0
    for line in text.split("\n"):
        in_line = line.encode().split()
        if in_line:
            dup_lines += line in seen
            seen.add(line)
            if line_failure(line, in_line):
                failed_lines += 1
                lost += len(line) - _count(line, _SPACES.decode())
                continue
        kept_lines.append(line)
    repeats = repeated_words(words)
    base_failed = len(words) < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * len(words)
    kept = not base_failed and 100 * lost <= MAX_LOST_PERCENT * word_chars
    clean = "\n".join(kept_lines)
    return (len(words), word_chars, _count(text, SYMBOLS), dup_lines, repeats, base_failed,
            failed_lines, lost, kept, clean)


def quality(text: Column) -> Column:
    """The struct of FIELDS for a text column, ``clean_text`` included."""
    return row_struct(FIELDS, assess)(text)


#: Rows that a task cleans at a time.
SLICE_ROWS = 512


def filter_quality(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose text is kept, without its failing lines; other columns are unchanged."""
    place = docs.columns.index(text)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                found = [assess(value) for value in texts(part.column(place))]
                field = part.schema.field(place)
                cleaned = part.set_column(place, field, pa.array([f[9] for f in found], field.type))
                yield cleaned.filter(pa.array([f[8] for f in found], pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)
