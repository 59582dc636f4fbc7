"""Toxicity by class-conditional Kneser-Ney models.

Toxic and ordinary texts each have a model of the characters inside a word: the chance
of the next character after the ORDER - 1 before it (a word is a run
of letters and digits in lower case, between ``^`` and ``$``). Only the highest order is counted per class. All lower orders are Kneser-Ney
continuation counts that both classes share, so a rare expression is judged by the
parts of it that the classes know, and what neither knows weighs nothing: there the
difference of the log-likelihoods is that of the backoff weights alone.

A text is scored by the difference of its log-likelihoods per word, over the whole text
and over its most toxic passage of PASSAGE_WORDS words, so that neither a short nor a
very long text is judged by its length. A logistic curve through both, fitted on
labelled texts that the counts did not see, gives the score (on all labelled texts where
those lack a class).

Bounds of the classifier (parameters): SAMPLE_ROWS distinct labelled texts per class, the
ones with the least hash, SAMPLE_CHARS characters of each from a hashed place for the
counts (the curve reads whole texts), and the MODEL_GRAMS most frequent character
sequences in the table that is broadcast. Counting is a Spark job; the driver holds that
table and two numbers for each text of the curve.

Defined results: a null text is empty; a text without a word has log-likelihoods of
difference 0 and the score that the curve gives them. Labels without an id, ids without a
text and null labels are ignored, of several labels of an id the greatest counts. Without a toxic label
all scores are 0, without an ordinary one all are 1. Equal texts get equal scores, so ties and repeated
rows matter to nobody; texts of any length are read whole, one at a time, and a worker
remembers at most MEMORY_WORDS words. An empty table gives an empty table. Other columns are
ignored, whatever their names; source, language and id are never used to score.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.common import row_struct, terms, texts
from millrace.session import materialize

ORDER = 5
DISCOUNT = 0.75
PASSAGE_WORDS = 2
SAMPLE_ROWS = 8192
SAMPLE_CHARS = 4096
MODEL_GRAMS = 1 << 20
#: One labelled text in so many is kept for the curve.
CURVE_SHARE = 4
#: Pulls the weights of the curve towards 0, as so many texts would.
RIDGE = 0.01
MEMORY_WORDS = 1 << 18

START, STOP = "^", "$"

FIELDS = {"whole": "double", "passage": "double"}


class Model(NamedTuple):
    """``grams``: log-ratio of the classes by context and next character; ``backoff``:
    log-ratio by context, for any other character; ``curve``: offset and two weights."""

    grams: dict[str, float]
    backoff: dict[str, float]
    curve: tuple[float, float, float]


class _Ratios(dict):
    """Log-ratio by word, remembered."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: bytes) -> float:
        marked = START + word.decode() + STOP
        grams, backoff = self.model.grams.get, self.model.backoff.get
        ratio = 0.0
        for at in range(1, len(marked)):
            known = grams(marked[max(0, at - ORDER + 1) : at + 1])
            ratio += backoff(marked[max(0, at - ORDER + 1) : at], 0.0) if known is None else known
        self[word] = ratio
        return ratio


def _features(ratios: _Ratios, text: str) -> tuple[float, float]:
    """Log-ratio per word, of the whole text and of its most toxic passage."""
    found = terms(text)
    if not found:
        return 0.0, 0.0
    if len(ratios) > MEMORY_WORDS:
        ratios.clear()
    values = np.fromiter(map(ratios.__getitem__, found), float, len(found))
    sums = np.concatenate([[0.0], np.cumsum(values)])
    size = min(PASSAGE_WORDS, len(values))
    return float(sums[-1]) / len(values), float((sums[size:] - sums[:-size]).max()) / size


def _features_of(text: Column, model: Broadcast) -> Column:
    known: list[_Ratios] = []

    def one(value: str) -> tuple[float, float]:
        if not known:
            known.append(_Ratios(model.value))
        return _features(known[0], value)

    return row_struct(FIELDS, one)(text)


def _sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``toxic``, ``text`` and ``hash`` of at most SAMPLE_ROWS distinct texts per class, and
    ``weight``, how many labelled ids of the class one of them stands for.

    Ids are thinned by their hash before any text moves, so what is broadcast has about
    four times the sample at most, however many labels there are.
    """
    labelled = labels.where("id is not null and label is not null").groupBy("id").agg(
        (F.max("label") == 1).alias("toxic")
    )
    counts = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = F.when(F.col("toxic"), min(1.0, 2 * SAMPLE_ROWS / counts.get(True, 1))).otherwise(
        min(1.0, 2 * SAMPLE_ROWS / counts.get(False, 1))
    )
    thin = labelled.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30) < share)
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).where("text is not null")
    found = rows.join(F.broadcast(thin), "id").select("toxic", "text", F.xxhash64("text").alias("hash"))
    order = Window.partitionBy("toxic").orderBy("hash")
    picked = found.dropDuplicates(["toxic", "hash"]).withColumn("n", F.row_number().over(order))
    picked = materialize(picked.where(F.col("n") <= SAMPLE_ROWS).drop("n"), "toxic-sample")
    taken = {r["toxic"]: r["n"] for r in picked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    weight = F.when(F.col("toxic"), counts.get(True, 0) / taken.get(True, 1)).otherwise(
        counts.get(False, 0) / taken.get(False, 1)
    )
    return picked.withColumn("weight", weight)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for toxic, text in zip(batch.column("toxic").to_pylist(), texts(batch.column("text"))):
            counts.update((toxic, word) for word in terms(text))
        yield pa.RecordBatch.from_pydict({
            "word": pa.array([word.decode() for _, word in counts], pa.string()),
            "toxic": pa.array([n if toxic else 0 for (toxic, _), n in counts.items()], pa.int64()),
            "ordinary": pa.array([0 if toxic else n for (toxic, _), n in counts.items()], pa.int64()),
        })


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[tuple[str, str], list[int]] = defaultdict(lambda: [0, 0])
        for word, toxic, ordinary in zip(*(batch.column(i).to_pylist() for i in range(3))):
            marked = START + word + STOP
            for at in range(1, len(marked)):
                both = counts[marked[max(0, at - ORDER + 1) : at], marked[at]]
                both[0] += toxic
                both[1] += ordinary
        yield pa.RecordBatch.from_pydict({
            "context": pa.array([context for context, _ in counts], pa.string()),
            "next": pa.array([following for _, following in counts], pa.string()),
            "toxic": pa.array([toxic for toxic, _ in counts.values()], pa.int64()),
            "ordinary": pa.array([ordinary for _, ordinary in counts.values()], pa.int64()),
        })


def _backed(count: Column, kinds: Column, total: Column, lower: Column) -> Column:
    return (F.greatest(count - DISCOUNT, F.lit(0.0)) + DISCOUNT * kinds * lower) / total


def _shared(grams: DataFrame) -> DataFrame:
    """``rest``, ``next`` and ``p``, the chance of a character after a shorter context, of all
    orders below the highest; counted are the different characters before a context."""
    shorter = F.expr("substring(context, 2)")
    levels, above = [], None
    for size in range(ORDER - 2, -1, -1):
        longer = grams.where(F.length("context") == size + 1).select("context", "next")
        longer = longer if above is None else longer.union(above.select("context", "next"))
        above = longer.select(shorter.alias("context"), "next").groupBy("context", "next").agg(F.count("*").alias("n"))
        levels.append(above)
    own = Window.partitionBy("context")
    even = 1.0 / (1 + grams.select("next").distinct().count())
    found, everything = None, None
    for level in reversed(levels):
        counted = level.select("*", F.sum("n").over(own).alias("total"), F.count("*").over(own).alias("kinds"))
        if found is None:
            lower, known = F.lit(even), counted
        else:
            below = found.withColumnRenamed("p", "lower")
            lower, known = F.col("lower"), counted.withColumn("rest", shorter).join(below, ["rest", "next"])
        p = _backed(F.col("n"), F.col("kinds"), F.col("total"), lower)
        found = materialize(known.select(F.col("context").alias("rest"), "next", p.alias("p")), "toxic-shared")
        everything = found if everything is None else everything.union(found)
    return everything


def log_ratios(grams: DataFrame) -> DataFrame:
    """``context``, ``next``, ``ratio`` (log-ratio of the classes) and ``other``, the ratio of
    a character that never follows the context; ``n`` is how often the sequence occurs."""
    own = Window.partitionBy("context")
    known = grams.withColumn("rest", F.expr("substring(context, 2)")).join(_shared(grams), ["rest", "next"])
    logs, others = [], []
    for side in ("toxic", "ordinary"):
        total = F.sum(side).over(own)
        kinds = F.sum((F.col(side) > 0).cast("long")).over(own)
        logs.append(F.log(F.when(total > 0, _backed(F.col(side), kinds, total, F.col("p"))).otherwise(F.col("p"))))
        others.append(F.log(F.when(total > 0, DISCOUNT * kinds / total).otherwise(1.0)))
    return known.select(
        "context", "next", (F.col("toxic") + F.col("ordinary")).alias("n"),
        (logs[0] - logs[1]).alias("ratio"), (others[0] - others[1]).alias("other"),
    )


def _fit(values: np.ndarray, toxic: np.ndarray, weights: np.ndarray) -> tuple[float, float, float]:
    """Offset and weights of a logistic curve, by Newton steps with a small ridge."""
    if not len(values) or toxic.all() or not toxic.any():
        return (np.inf if len(values) and toxic.all() else -np.inf, 0.0, 0.0)
    scale = np.maximum(values.std(axis=0), 1e-9)
    x = np.column_stack([np.ones(len(values)), values / scale])
    weights = weights / weights.mean()
    ridge = RIDGE * np.array([0.0, 1.0, 1.0])
    found = np.zeros(3)

    def loss(b: np.ndarray) -> float:
        z = x @ b
        return float(weights @ (np.logaddexp(0, z) - toxic * z) + (ridge * b) @ b / 2)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ found, -500, 500)))
        slope = x.T @ (weights * (toxic - p)) - ridge * found
        bend = (x.T * (weights * p * (1 - p))) @ x + np.diag(ridge + 1e-9)
        step = np.linalg.solve(bend, slope)
        while loss(found + step) > loss(found) and np.abs(step).max() > 1e-9:
            step /= 2
        found = found + step
        if np.abs(step).max() < 1e-9:
            break
    return float(found[0]), *(float(w) for w in found[1:] / scale)


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """A model from the documents that ``labels`` marks (1 is toxic, all else ordinary)."""
    marked = labels.select(F.col(doc_id).alias("id"), F.col(label).alias("label"))
    sample = _sample(docs, marked, doc_id, text)
    on_curve = F.pmod(F.xxhash64("hash"), F.lit(CURVE_SHARE)) == 0
    start = F.pmod(F.shiftright("hash", 32), F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1) + 1
    part = F.substring("text", start.cast("int"), F.lit(SAMPLE_CHARS)).alias("text")
    counted = sample.where(~on_curve).select("toxic", part).mapInArrow(
        _count_words, "word string, toxic bigint, ordinary bigint"
    )
    sums = F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")
    grams = counted.groupBy("word").agg(*sums).mapInArrow(
        _count_grams, "context string, next string, toxic bigint, ordinary bigint"
    )
    grams = materialize(grams.groupBy("context", "next").agg(*sums), "toxic-grams")
    ratios = log_ratios(grams).orderBy(F.desc("n"), "context", "next").limit(MODEL_GRAMS)
    table = ratios.select("context", "next", "ratio", "other").toArrow()
    contexts, following = table.column("context").to_pylist(), table.column("next").to_pylist()
    known = dict(zip(map(str.__add__, contexts, following), table.column("ratio").to_pylist()))
    other = dict(zip(contexts, table.column("other").to_pylist()))
    model = Model(known, other, (0.0, 0.0, 0.0))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    seen = sample.select("toxic", "weight", on_curve.alias("kept"), _features_of(F.col("text"), shared).alias("f"))
    rows = seen.where("kept").select("toxic", "weight", "f.*").toArrow().to_pydict()
    if len(set(rows["toxic"])) < 2:
        rows = seen.select("toxic", "weight", "f.*").toArrow().to_pydict()
    values = np.column_stack([rows["whole"], rows["passage"]]).astype(float).reshape(-1, 2)
    return model._replace(curve=_fit(values, np.array(rows["toxic"], bool), np.array(rows["weight"], float)))


def score(docs: DataFrame, model: Model, text: str = "text", into: str = "found") -> DataFrame:
    """``docs`` with a struct column ``into``: ``whole`` and ``passage`` (log-ratios per word),
    ``score`` (0 to 1, higher is more toxic)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    offset, whole, passage = model.curve
    f = F.col(into)
    rate = 1 / (1 + F.exp(-(F.lit(offset) + whole * f["whole"] + passage * f["passage"])))
    return docs.withColumn(into, _features_of(F.col(text), shared)).withColumn(
        into, F.struct(f["whole"].alias("whole"), f["passage"].alias("passage"), rate.alias("score"))
    )
