"""Language identification by compression.

Training takes a bounded sample of labelled rows per language and turns their text
into one raw-content zstandard dictionary each. A text is cut into blocks, every
block is compressed with each dictionary, and the language with the smallest total
wins. A text is rejected when the margin to the second language is narrow.

Bounds of the sample (parameters): SAMPLE_ROWS rows per language, the ones with the
least hash, SAMPLE_CHARS characters of each from a hashed place, DICTIONARY_BYTES in
total. The driver holds the dictionaries alone: their number is that of the languages.

Defined results: null text or text without a letter is ``und`` with score 0 and is
rejected; without any labelled row everything is ``und``; a single learned language
wins with score 1; ties go to the language first in the alphabet and are rejected.
Equal texts get equal results; label, source and id are never used to predict.
"""

from __future__ import annotations

import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.common import row_struct

SAMPLE_ROWS = 64
SAMPLE_CHARS = 1024
DICTIONARY_BYTES = 32 << 10
LEVEL = 6
BLOCK_BYTES = 4096
#: Rejected below this share of the second-best size.
MIN_MARGIN = 0.003

FIELDS = {"lang_pred": "string", "score": "double", "margin": "double", "accepted": "boolean"}


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """Language to dictionary, from labelled rows with text.

    Texts are first thinned to about four times the sample by their hash and the
    number of distinct texts of their language, so a language with most of the rows
    costs no more than a rare one, and copies count once.
    """
    rows = docs.select(F.col(text).alias("t"), F.col(lang).alias("l")).where("t is not null and l is not null")
    distinct = F.approx_count_distinct(F.xxhash64("t")).alias("n")
    counts = {r["l"]: r["n"] for r in rows.groupBy("l").agg(distinct).collect()}
    if not counts:
        return {}
    share = F.create_map(*(F.lit(x) for l, n in counts.items() for x in (l, min(1.0, 4 * SAMPLE_ROWS / n))))
    place = F.xxhash64("t")
    thin = rows.withColumn("h", place).where(
        (F.pmod("h", F.lit(1 << 30)) / float(1 << 30)) < share[F.col("l")]
    )
    start = F.pmod(F.shiftright("h", 32), F.greatest(F.length("t") - SAMPLE_CHARS, F.lit(0)) + 1) + 1
    thin = thin.select("l", "h", F.substring("t", start.cast("int"), F.lit(SAMPLE_CHARS)).alias("t"))
    order = Window.partitionBy("l").orderBy("h", "t")
    picked = thin.distinct().withColumn("n", F.row_number().over(order)).where(F.col("n") <= SAMPLE_ROWS)
    parts: dict[str, list[bytes]] = {language: [] for language in counts}
    for row in sorted(picked.select("l", "h", "t").collect(), key=lambda r: (r["l"], r["h"], r["t"])):
        parts[row["l"]].append(row["t"].lower().encode())
    return {language: b"\n".join(found)[:DICTIONARY_BYTES] for language, found in sorted(parts.items())}


class Classifier:
    """Compressors of all languages; pickled as the dictionaries alone."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.dictionaries = dictionaries
        self._compressors: list[tuple[str, zstandard.ZstdCompressor]] | None = None

    def __getstate__(self):
        return {"dictionaries": self.dictionaries, "_compressors": None}

    def _ready(self):
        if self._compressors is None:
            self._compressors = []
            for language, content in sorted(self.dictionaries.items()):
                words = zstandard.ZstdCompressionDict(
                    content.ljust(8, b" "), dict_type=zstandard.DICT_TYPE_RAWCONTENT
                )
                words.precompute_compress(level=LEVEL)
                self._compressors.append((language, zstandard.ZstdCompressor(
                    dict_data=words, write_content_size=False, write_dict_id=False)))
        return self._compressors

    def classify(self, text: str) -> tuple:
        """The values of FIELDS for one whole text."""
        if not self.dictionaries or not any(map(str.isalpha, text)):
            return "und", 0.0, 0.0, False
        data = text.lower().encode()
        blocks = [data[i : i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)]
        sizes = sorted(
            (sum(len(c.compress(block)) for block in blocks), language) for language, c in self._ready()
        )
        best = sizes[0][0]
        second = sizes[1][0] if len(sizes) > 1 else 2 * best
        score = 1 / sum(2.0 ** max(-60, best - size) for size, _ in sizes)
        margin = (second - best) / second
        return sizes[0][1], score, margin, margin >= MIN_MARGIN


def identify(text: Column, dictionaries: dict[str, bytes]) -> Column:
    """The struct of FIELDS for a text column."""
    return row_struct(FIELDS, Classifier(dictionaries).classify)(text)


def filter_language(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text") -> DataFrame:
    """The rows whose language is certain, with their columns unchanged."""
    return docs.where(identify(F.col(text), dictionaries)["accepted"])
