"""Document fingerprints by I-Match, in DataFrame functions alone.

A term is kept when the share of documents that hold it lies in a band. The distinct
kept terms of a text are sorted and hashed once per lexicon; each lexicon but the first
leaves out a random part of the terms. The likeness of two fingerprints is the share of
lexicons on which they agree.

The lexicon is broadcast: at most (mean number of distinct terms of a document) / LOW
terms are held by a share of LOW or more, however many documents there are.

Defined results: a null text is empty; where a lexicon holds no term of a text, the hash of
all its terms stands instead, so texts without any term are alike; equal texts have equal fingerprints.
For ``with_neighbours`` documents are ordered by falling id, null ids last, then by a hash
of their text; repeated rows are neighbours of each other; a single document is its own
neighbour. An empty table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Band of the share of documents that hold a term.
LOW, HIGH = 0.001, 0.3
LEXICONS = 8
#: Percent of the terms that a randomised lexicon leaves out.
LEFT_OUT = 30
#: Documents in a slice of the order, and most slices.
SLICE_ROWS, MOST_SLICES = 2000, 1000

#: Stands for "no term" so that every text keeps a row; it is in no lexicon.
_NONE = 0

#: Layout of an entry: the high bits of the term's hash, then the variant, then the mask.
_MASK_BITS, _VARIANT_BITS = LEXICONS, 2
_LOW_BITS = _MASK_BITS + _VARIANT_BITS


def terms(text: Column) -> Column:
    """Hashes of the distinct terms: runs of letters and digits in lower case."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def lexicon(texts: DataFrame, text: str = "text") -> DataFrame:
    """``term`` and ``mask``: a bit for each lexicon that holds the term."""
    rows = texts.select(F.coalesce(F.col(text), F.lit("")).alias("t"))
    held = rows.select(F.explode(terms(F.col("t"))).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    total = rows.count()
    kept = held.where((F.col("n") >= LOW * total) & (F.col("n") <= HIGH * total))
    bits = [F.lit(1)] + [
        F.when(F.pmod(F.xxhash64("term", F.lit(k)), F.lit(100)) >= LEFT_OUT, 1 << k).otherwise(0)
        for k in range(1, LEXICONS)
    ]
    masked = kept.select("term", sum(bits[1:], bits[0]).alias("mask"))
    none = texts.sparkSession.range(1).select(F.lit(_NONE).cast("long").alias("term"), F.lit(0).alias("mask"))
    return masked.where(F.col("term") != _NONE).union(none)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _hashes(entries: Column, everything: Column) -> Column:
    """One hash per lexicon of the sorted entries of one text."""

    def of(ordered: Column, k: int) -> Column:
        chosen = F.filter(ordered, lambda e: e.bitwiseAND(F.lit(1 << k).cast("long")) != 0)
        return _once(chosen, lambda c: F.when(F.size(c) > 0, F.xxhash64(c)).otherwise(everything))

    return _once(F.sort_array(entries), lambda ordered: F.array(*(of(ordered, k) for k in range(LEXICONS))))


def likeness(a: Column, b: Column) -> Column:
    equal = F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)
    return F.size(equal).cast("double") / LEXICONS


def as_text(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, lambda h: F.lpad(F.hex(h), 16, "0")), "-")


def fingerprint_columns(rows: DataFrame, key: list[str], variants: list[str], held: DataFrame) -> DataFrame:
    """For each text column in ``variants`` the array ``<name>_hashes``.

    ``key`` names the rows; the other columns are kept. The terms are exploded, met
    with the broadcast lexicon and gathered again by ``key``; this needs no shuffle
    when the rows are already partitioned by one of the key columns. At most
    2**_VARIANT_BITS columns at a time. The first key column should tell rows apart,
    as it is what rows are sorted by.
    """
    rest = [c for c in rows.columns if c not in key and c not in variants]
    listed = rows.select(
        *key, *rest, *(terms(F.col(name)).alias(name) for name in variants)
    )

    def entry(i: int):
        return lambda t: F.struct(t.alias("term"), F.lit(i).cast("long").alias("variant"))

    none = F.array(F.lit(_NONE).cast("long"))
    entries = F.flatten(F.array(*(F.transform(F.concat(name, none), entry(i)) for i, name in enumerate(variants))))
    # The hash of all terms is taken before the terms become rows.
    hashed = listed.select("*", *(F.xxhash64(F.sort_array(name)).alias(f"{name}_all") for name in variants))
    exploded = hashed.select(
        *key, *rest, *(f"{name}_all" for name in variants), F.explode(entries).alias("e")
    ).select("*", "e.variant", "e.term").drop("e")
    met = exploded.join(F.broadcast(held), "term")
    carried = rest + [f"{name}_all" for name in variants]
    high = F.shiftleft(F.shiftright("term", _LOW_BITS), _LOW_BITS)
    packed = high.bitwiseOR(F.shiftleft("variant", _MASK_BITS)).bitwiseOR(F.col("mask").cast("long"))
    gathered = met.groupBy(*key).agg(
        F.collect_list(F.when(F.col("mask") > 0, packed)).alias("entries"),
        *(F.first(c).alias(c) for c in carried),
    )

    def one(i: int, name: str) -> Column:
        bits = F.lit(((1 << _VARIANT_BITS) - 1) << _MASK_BITS).cast("long")
        own = F.filter("entries", lambda e: e.bitwiseAND(bits) == i << _MASK_BITS)
        # Entries of one text differ in nothing but term and mask once the variant is cleared.
        return _hashes(F.transform(own, lambda e: e.bitwiseAND(F.bitwise_not(bits))), F.col(f"{name}_all"))

    return gathered.select(*key, *rest, *(one(i, name).alias(f"{name}_hashes") for i, name in enumerate(variants)))


def _slices(docs: DataFrame) -> tuple[list[int], int | None]:
    """Greatest ids of all slices but the first, falling, and the greatest id of all."""
    facts = docs.agg(F.count("*").alias("n"), F.max("doc_id").alias("top")).first()
    count = max(1, min(MOST_SLICES, facts["n"] // SLICE_ROWS))
    if count == 1 or facts["top"] is None:
        return [], facts["top"]
    shares = [i / count for i in range(1, count)]
    found = docs.agg(F.percentile_approx("doc_id", shares, 20_000).alias("p")).first()["p"]
    return sorted(set(found), reverse=True), facts["top"]


def with_neighbours(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``slice``, ``row`` (a number that grows along the order), ``doc_id``, ``text``, ``next_text`` and
    ``ghost``: documents by falling id with the text of the next one; the first one
    follows the last.

    The order is cut into slices at sampled ids. The first document of each slice is
    also put at the end of the slice before it, as a ghost, so one shuffle is enough.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    tops, top = _slices(docs.select(F.col(doc_id).alias("doc_id")))
    bounds = F.array(*map(F.lit, tops)) if tops else F.array().cast("array<bigint>")
    number = F.when(F.col("doc_id").isNull(), len(tops)).otherwise(
        F.size(F.filter(bounds, lambda v: F.col("doc_id") <= v))
    )
    ghost_of = F.when(F.array_contains(bounds, F.col("doc_id")), F.col("slice") - 1)
    first_of_all = F.when(F.col("doc_id").eqNullSafe(F.lit(top)), len(tops))
    places = F.filter(
        F.array(
            F.struct(F.col("slice").alias("slice"), F.lit(0).alias("ghost")),
            F.struct(ghost_of.alias("slice"), F.lit(1).alias("ghost")),
            F.struct(first_of_all.alias("slice"), F.lit(1).alias("ghost")),
        ),
        lambda p: p["slice"].isNotNull(),
    )
    placed = rows.withColumn("slice", number).select("doc_id", "text", F.explode(places).alias("p"))
    order = Window.partitionBy("slice").orderBy(
        "ghost", F.col("doc_id").desc_nulls_last(), F.xxhash64("text")
    )
    return placed.select("p.*", "doc_id", "text").select(
        "slice",
        (F.shiftleft(F.col("slice").cast("long"), 32) + F.row_number().over(order)).alias("row"),
        "doc_id",
        "text",
        F.lead("text").over(order).alias("next_text"), "ghost",
    )


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``fingerprint`` of every document."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    found = fingerprint_columns(numbered, ["row"], ["text"], lexicon(docs, text))
    return found.select("doc_id", as_text(F.col("text_hashes")).alias("fingerprint"))
