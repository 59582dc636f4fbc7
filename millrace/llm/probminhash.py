"""Near-duplicates by ProbMinHash, banding and verification.

Each distinct sequence of words is a set of five-word shingles weighted by their number. Every
shingle is a Poisson process whose rate is its weight: an arrival falls into a random
slot, and a slot keeps its earliest arrival. Arrivals later than the latest slot cannot
matter, so a process ends there. Slots of two texts agree with the probability Jaccard
of their weights. A text that repeats a shingle has a second signature in which all
weights are 1, whose slots agree with the plain Jaccard; it is in the buckets of both,
and counts by the one that agrees more. Bands of slots give buckets; buckets with the same texts count once.

A bucket is not expanded into pairs. Its greatest spanning tree by slot agreement names
the pairs to verify on whole texts: a tree joins what any threshold joins. (For the
trees alone, buckets above CHUNK texts are cut by a hash of text and band; what is not
linked in them is first compared with the text of the bucket that has most links.)
Then the rest: in a bucket that still holds several components, the signatures of every text
outside the largest one are compared with those of all texts of other components, in blocks of
bounded size. Each pair with the least slot agreement is a candidate, once, in the first
bucket it shares. Only texts that have one are fetched, for that bucket alone, and all
candidates are verified. Linked texts form classes.

A pair is linked when its plain or its probability Jaccard reaches the threshold.

Defined results: texts of equal words in equal order are one text (null is empty), so
repeated rows and copies with other spaces or line breaks share a class; texts of fewer than five words are one shingle; texts without a word match only
each other. The class id is the least document id of the class, null if all are null. An
empty table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.common import SPACE, texts
from millrace.llm.components import components
from millrace.llm.hashing import mix, shingles
from millrace.session import materialize

SHINGLE_WORDS = 5
THRESHOLD = 0.8
#: A pair at the threshold misses all bands with probability 5e-8.
BANDS, ROWS = 32, 4
#: Slots of a pair at the threshold agree less often than this with probability 3e-6.
LEAST_AGREEMENT = 0.64
#: Most texts of one tree; about how many texts and bytes of text a side of a block holds.
CHUNK = 1024
BLOCK, BLOCK_BYTES = 4096, 1 << 24
#: Candidates of a text that are verified at a time.
STEP = 64


def signature(weighted: np.ndarray, weights: np.ndarray, slots: int) -> np.ndarray:
    """The shingle that arrives first in each slot.

    Arrivals are drawn a few at a time for all shingles that can still come early;
    their times and slots depend on the shingle and the number of the arrival alone.
    """
    first = np.full(slots, np.inf)
    owner = np.zeros(slots, np.uint64)
    ids, rates, times, drawn = weighted, weights.astype(float), np.zeros(len(weighted)), 0
    while len(ids):
        count = min(64, -(-5 * slots // len(ids))) if drawn == 0 else 1 + 64 // len(ids)
        number = np.arange(drawn, drawn + count, dtype=np.uint64)
        with np.errstate(over="ignore"):
            bits = mix(ids[:, None] + number * np.uint64(0xD1342543DE82EF95))
        uniform = ((bits >> np.uint64(11)) + np.uint64(1)).astype(float) * 2.0**-53
        arrivals = times[:, None] + np.cumsum(-np.log(uniform), axis=1) / rates[:, None]
        place = (mix(bits) % np.uint64(slots)).astype(np.int64)
        early = np.flatnonzero((arrivals < first[place]).ravel())
        early = early[np.argsort(-arrivals.ravel()[early], kind="stable")]
        first[place.ravel()[early]] = arrivals.ravel()[early]
        owner[place.ravel()[early]] = ids[early // count]
        drawn += count
        active = arrivals[:, -1] < first.max()
        ids, rates, times = ids[active], rates[active], arrivals[active, -1]
    return owner


def sign(text: str) -> tuple[np.ndarray, bytes]:
    """The distinct bucket numbers of the bands (none for a text without a word), and a
    byte per slot. If a shingle repeats, the ones with all weights 1 are there as well."""
    found = shingles(text, SHINGLE_WORDS)
    if not len(found):
        return np.empty(0, np.int64), b""
    ids, counts = np.unique(found, return_counts=True)
    codes, slots = [], []
    for weights in [counts] if counts.max() == 1 else [counts, np.ones_like(counts)]:
        owner = signature(ids, weights, BANDS * ROWS)
        code = np.arange(BANDS, dtype=np.uint64)
        for row in range(ROWS):
            code = mix(code ^ owner.reshape(BANDS, ROWS)[:, row])
        codes.append(code)
        slots.append((mix(owner) & np.uint64(255)).astype(np.uint8).tobytes())
    return np.unique(np.concatenate(codes)).view(np.int64), b"".join(slots)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[float, float]:
    """Plain and probability Jaccard of two weighted sets (ids sorted, weights)."""
    shared, at_a, at_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    union = len(a[0]) + len(b[0]) - len(shared)
    if not union:
        return 1.0, 1.0
    plain = len(shared) / union
    wa, wb = a[1][at_a].astype(float), b[1][at_b].astype(float)
    if not len(shared) or ((a[1] == 1).all() and (b[1] == 1).all()):
        return plain, plain
    only_a, only_b = a[1].sum() - wa.sum(), b[1].sum() - wb.sum()
    # For a shared d the denominator is the sum of max(a[i] / a[d], b[i] / b[d]) over all i.
    order = np.argsort(wb / wa, kind="stable")
    wa, wb = wa[order], wb[order]
    ratio = wb / wa
    upto = np.searchsorted(ratio, ratio, side="right")
    below = np.concatenate([[0], np.cumsum(wa)])[upto] + only_a
    above = wb.sum() - np.concatenate([[0], np.cumsum(wb)])[upto] + only_b
    return plain, float((1 / (below / wa + above / wb)).sum())


def _weighted(text: str) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(shingles(text, SHINGLE_WORDS), return_counts=True)


def keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``text`` (null is empty), its ``digest``, and ``key``, which texts of
    the same words in the same order share."""
    whole = F.coalesce(F.col(text), F.lit(""))
    words = F.trim(F.regexp_replace(whole, f"[{SPACE}]+", " "))
    return docs.select(
        F.col(doc_id).alias("doc_id"), whole.alias("text"), F.unhex(F.md5(whole)).alias("digest"),
        F.unhex(F.md5(words)).alias("key"),
    )


def _signed(rows: DataFrame) -> DataFrame:
    """``key``, ``bytes``, ``bands`` and ``sketch`` of distinct texts."""

    def batch(values: pa.Array) -> pa.Array:
        found = [sign(text) for text in texts(values)]
        bands = pa.array([bands for bands, _ in found], pa.list_(pa.int64()))
        return pa.StructArray.from_arrays([bands, pa.array([s for _, s in found], pa.binary())], ["bands", "sketch"])

    kind = "struct<bands: array<bigint>, sketch: binary>"
    size = F.octet_length("text").alias("bytes")
    return rows.select("key", size, F.arrow_udf(batch, kind)("text").alias("s")).select("key", "bytes", "s.*")


def _members(signed: DataFrame) -> DataFrame:
    """``band``, ``n`` (texts of the bucket), ``chunk``, ``key``, ``sketch`` and ``bytes``
    (of the text) of all buckets with two texts or more."""
    banded = signed.select("key", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("key")).alias("content"))
    unique = buckets.where("n > 1").groupBy("content", "n").agg(F.min("band").alias("band"))
    chunk = F.pmod(F.xxhash64("key", "band"), F.ceil(F.col("n") / CHUNK))
    met = banded.join(unique.select("band", "n"), "band").select("band", "n", chunk.alias("chunk"), "key")
    return met.join(signed.drop("bands"), "key")


def _sketches(group: pa.Table) -> tuple[list[bytes], np.ndarray]:
    """Keys, and slots by text, weighting and place (equal ones if a text has one signature,
    one weighting if all have)."""
    keys, found = group.column("key").to_pylist(), group.column("sketch").to_pylist()
    most = max(map(len, found))
    slots = np.frombuffer(b"".join(s * (most // len(s)) for s in found), np.uint8)
    return keys, slots.reshape(len(keys), -1, BANDS * ROWS)


def _agreed(sketches: np.ndarray, one: np.ndarray) -> np.ndarray:
    return (sketches == one).sum(axis=2).max(axis=1)


def _pairs(pairs: set[tuple[bytes, bytes]]) -> pa.Table:
    return pa.table({
        "leader": pa.array([a for a, _ in pairs], pa.binary()), "key": pa.array([b for _, b in pairs], pa.binary())
    })


def _tree(group: pa.Table) -> pa.Table:
    """Edges of the greatest spanning forest by agreement, above the least one."""
    keys, sketches = _sketches(group)
    least = LEAST_AGREEMENT * sketches.shape[-1]
    best, parent = np.full(len(keys), -1), np.zeros(len(keys), np.int64)
    outside, at, pairs = np.ones(len(keys), bool), 0, set()
    for _ in range(len(keys) - 1):
        outside[at] = False
        agreed = _agreed(sketches, sketches[at])
        nearer = agreed > best
        best[nearer], parent[nearer] = agreed[nearer], at
        at = int(np.argmax(np.where(outside, best, -2)))
        if best[at] >= least:
            pairs.add((min(keys[at], keys[parent[at]]), max(keys[at], keys[parent[at]])))
    return _pairs(pairs)


def _linked(mine: tuple[np.ndarray, np.ndarray], others: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Which weighted sets reach the threshold with ``mine``, as ``similarity`` finds."""
    sizes = np.array([len(ids) for ids, _ in others])
    ids = np.concatenate([ids for ids, _ in others])
    place = np.minimum(np.searchsorted(mine[0], ids), len(mine[0]) - 1)
    shared = np.add.reduceat((mine[0][place] == ids).astype(np.int64), np.cumsum(sizes) - sizes)
    linked = shared / (len(mine[0]) + sizes - shared) >= THRESHOLD
    once = (mine[1] == 1).all()
    for j in np.flatnonzero(~linked & (shared > 0)):
        if not (once and (others[j][1] == 1).all()):
            linked[j] = similarity(mine, others[j])[1] >= THRESHOLD
    return linked


def _candidates(group: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Numbers of left texts, of their candidates on the right side of a block, most agreeing
    first, and of all components (which the caller may join meanwhile).

    A candidate is of another component, has the least agreement, and shares no earlier bucket.
    """
    keys, sketches = _sketches(group)
    least = LEAST_AGREEMENT * sketches.shape[-1]
    band, left, small = group.column("band")[0].as_py(), *(
        np.array(group.column(c).to_pylist(), bool) for c in ("left", "small")
    )
    numbers: dict[bytes, int] = {}
    comp = np.array([numbers.setdefault(r, len(numbers)) for r in group.column("root").to_pylist()])
    place = {key: n for n, key in enumerate(sorted(set(keys)))}
    rank = np.array([place[key] for key in keys])
    lists = [np.array(own) for own in group.column("bands").to_pylist()]
    bands = np.full((len(keys), max(map(len, lists))), band)  # filled up with what no text looks for
    for n, own in enumerate(lists):
        bands[n, : len(own)] = own
    right = np.flatnonzero(~left)
    for i in np.flatnonzero(left):
        # Two texts outside the largest component meet twice, as left and right.
        others = right[(comp[right] != comp[i]) & (~small[right] | (rank[right] > rank[i]))]
        agreed = _agreed(sketches[others], sketches[i])
        others, agreed = others[agreed >= least], agreed[agreed >= least]
        new = ~np.isin(bands[others], lists[i][lists[i] < band]).any(axis=1)
        yield i, others[new][np.argsort(-agreed[new], kind="stable")], comp


def _needed(group: pa.Table) -> pa.Table:
    """The members of a block that have a candidate or are one."""
    needed = np.zeros(len(group), bool)
    for i, others, _ in _candidates(group):
        needed[others] = True
        needed[i] |= len(others) > 0
    return group.select(["band", "a", "b", "key", "left"]).filter(pa.array(needed))


def _rest(group: pa.Table) -> pa.Table:
    """Links between the left and the right texts of a block that join components.

    Every candidate is verified, until its components are joined by another pair.
    """
    keys, text, known = group.column("key").to_pylist(), group.column("text"), {}

    def weighted(i: int) -> tuple[np.ndarray, np.ndarray]:
        if keys[i] not in known:
            known[keys[i]] = _weighted(text[int(i)].as_py())
        return known[keys[i]]

    pairs = set()
    for i, others, comp in _candidates(group):
        for at in range(0, len(others), STEP):
            some = others[at : at + STEP]
            some = some[comp[some] != comp[i]]
            for j in some[_linked(weighted(i), [weighted(j) for j in some])] if len(some) else ():
                if comp[j] != comp[i]:
                    pairs.add((min(keys[i], keys[j]), max(keys[i], keys[j])))
                    comp[comp == comp[j]] = comp[i]
    return _pairs(pairs)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, weighted = None, None
    for batch in batches:
        found = []
        for leader, key, mine, other in zip(*(batch.column(i) for i in range(4))):
            if leader != last:
                last, weighted = leader, _weighted(mine.as_py())
            plain, probable = similarity(weighted, _weighted(other.as_py()))
            found.append((leader.as_py(), key.as_py(), plain, probable))
        columns = list(zip(*found)) if found else [[]] * 4
        kinds = [pa.binary(), pa.binary(), pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["leader", "key", "plain", "probable"]
        )


def _check(pairs: DataFrame, involved: DataFrame) -> DataFrame:
    """Similarities of pairs, from the whole texts."""
    both = pairs.join(involved.withColumnRenamed("text", "other"), "key").join(
        involved.select(F.col("key").alias("leader"), F.col("text").alias("mine")), "leader"
    )
    checked = both.select("leader", "key", "mine", "other").mapInArrow(
        _verify, "leader binary, key binary, plain double, probable double"
    )
    return materialize(checked, "checked")


def _links(tested: DataFrame) -> DataFrame:
    return tested.where(F.greatest("plain", "probable") >= THRESHOLD).select("leader", "key")


def _components(links: DataFrame) -> DataFrame:
    return materialize(components(links.toDF("a", "b")), "roots")


def _with_roots(members: DataFrame, found: DataFrame) -> DataFrame:
    rooted = members.join(found.withColumnRenamed("node", "key"), "key", "left")
    return rooted.withColumn("root", F.coalesce("root", "key"))


def _hubs(members: DataFrame, links: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs of a text and the one with most links in a bucket of several trees, where
    they are of different components. They only leave less for the blocks."""
    degree = links.select("key").union(links.select("leader")).groupBy("key").agg(F.count("*").alias("degree"))
    rooted = _with_roots(members.where(F.col("n") > CHUNK), found).select("band", "key", "root")
    best = F.max(F.struct("degree", F.col("key").alias("hub"), F.col("root").alias("hub_root"))).alias("best")
    hubs = rooted.join(degree, "key").groupBy("band").agg(best).select("band", "best.*")
    met = rooted.join(hubs, "band").where("root != hub_root")
    return met.select(F.least("hub", "key").alias("leader"), F.greatest("hub", "key").alias("key")).distinct()


def _apart(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components, with the number of blocks
    per side; ``small`` is true outside the largest component. (The tree of a bucket of
    two texts has compared all there is.)"""
    rooted = _with_roots(members.where("n > 2"), found)
    sizes = rooted.groupBy("band", "root").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    buckets = sizes.groupBy("band").agg(
        F.count("*").alias("components"), F.max(F.struct("n", "bytes", "root")).alias("main"),
        F.sum("n").alias("n"), F.sum("bytes").alias("bytes"),
    ).where("components > 1")

    def blocks(n, size):
        return F.ceil(F.greatest(n / BLOCK, size / BLOCK_BYTES, F.lit(1)))

    several = buckets.select(
        "band", F.col("main.root").alias("main"), blocks(F.col("n"), F.col("bytes")).alias("rights"),
        blocks(F.col("n") - F.col("main.n"), F.col("bytes") - F.col("main.bytes")).alias("lefts"),
    )
    return rooted.drop("n").join(several, "band").withColumn("small", F.col("root") != F.col("main"))


def _joined_rest(apart: DataFrame, involved: DataFrame) -> DataFrame:
    """Links that join components, from ``_apart``: each text outside the largest
    component of its bucket against all texts of the bucket, block by block."""
    a, b = F.pmod(F.xxhash64("key"), "lefts"), F.pmod(F.xxhash64("key", F.lit(1)), "rights")
    own = apart.withColumn("bands", F.collect_list("band").over(Window.partitionBy("key")))
    columns = ["band", "key", "root", "sketch", "small", "bands"]
    left = own.where("small").select(
        *columns, F.lit(True).alias("left"), a.alias("a"), F.explode(F.sequence(F.lit(0), F.col("rights") - 1)).alias("b")
    )
    right = own.select(
        *columns, F.lit(False).alias("left"), F.explode(F.sequence(F.lit(0), F.col("lefts") - 1)).alias("a"), b.alias("b")
    )
    sides = left.union(right)
    met = sides.groupBy("band", "a", "b").applyInArrow(_needed, "band bigint, a bigint, b bigint, key binary, left boolean")
    needed = materialize(met, "needed")
    with_text = sides.join(needed, ["band", "a", "b", "key", "left"]).join(involved, "key")
    return with_text.groupBy("band", "a", "b").applyInArrow(_rest, "leader binary, key binary")


def roots(rows: DataFrame) -> DataFrame:
    """``node`` and ``root`` of every text that is linked, from ``keyed`` documents."""
    distinct = rows.select("key", "text").dropDuplicates(["key"])
    members = materialize(_members(materialize(_signed(distinct), "signed")), "members")
    involved = materialize(distinct.join(members.select("key").distinct(), "key", "left_semi"), "texts")
    named = members.groupBy("band", "chunk").applyInArrow(_tree, "leader binary, key binary")
    links = _links(_check(named.distinct(), involved))
    found = _components(links)
    if not members.where(F.col("n") > CHUNK).isEmpty():
        near = _links(_check(_hubs(members, links, found), involved))
        found = _components(found.select("node", "root").union(near))
    apart = materialize(_apart(members, found), "apart")
    if apart.isEmpty():
        return found
    rest = materialize(_joined_rest(apart, involved), "rest")
    return found if rest.isEmpty() else _components(found.select("node", "root").union(rest))


def _rooted(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id``, ``digest`` and ``root``, one row per document."""
    rows = keyed(docs, doc_id, text)
    found = roots(rows).withColumnRenamed("node", "key")
    rooted = rows.select("doc_id", "digest", "key").join(found, "key", "left")
    return materialize(rooted.select("doc_id", "digest", F.coalesce("root", "key").alias("root")), "rooted")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``class_id`` and ``class_size`` (documents), one row per document."""
    rooted = _rooted(docs, doc_id, text)
    found = rooted.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return rooted.join(found, "root").select("doc_id", "class_id", "class_size")


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of every class, with its columns: the one with the least id (null
    ids last), of repeated ids that with the least text hash."""
    first = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("digest"))
    chosen = _rooted(docs, doc_id, text).groupBy("root").agg(F.min(first).alias("m"))
    chosen = chosen.select(F.col("m.doc_id").alias("chosen_id"), F.col("m.digest").alias("digest"))
    rows = docs.select(
        F.struct("*").alias("row"),
        F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("digest"),
        F.col(doc_id).alias("id"),
    )
    same = (rows["digest"] == chosen["digest"]) & rows["id"].eqNullSafe(chosen["chosen_id"])
    return rows.join(chosen, same, "left_semi").dropDuplicates(["digest", "id"]).select("row.*")
