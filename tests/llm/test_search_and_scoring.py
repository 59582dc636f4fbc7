"""Toxicity, ranked search and hard negatives."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import connect, difference
from millrace.llm import ball_tree, hard_negatives, toxicity
from millrace.llm.common import terms
from millrace.llm.oracle import ORACLE
from millrace.llm.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", ["op12_ball_tree", "op13_hard_negatives"])
def test_query_equals_sql(spark, sf_dir, duck, name):
    problem = difference(QUERIES[name](spark, sf_dir), duck, ORACLE[name])
    assert problem is None, problem


# --- toxicity ---------------------------------------------------------------------------

PLAIN = "the small house stood near an old river where people walked every quiet evening".split()
STEMS = ("grubnak", "zolfer", "quibbert")


def invented(rows: int, seed: int = 1):
    """Texts with the label; toxic ones hold one to three words made of a stem and an ending."""
    draw = np.random.default_rng(seed)
    found = []
    for i in range(rows):
        text = [PLAIN[j] + draw.choice(["", "s", "ly", "ing"]) for j in draw.integers(0, len(PLAIN), draw.integers(5, 400))]
        toxic = i % 5 == 0
        for _ in range(draw.integers(1, 4) if toxic else 0):
            text.insert(draw.integers(0, len(text) + 1), draw.choice(STEMS) + draw.choice(["", "s", "ly", "ing", "ed"]))
        found.append((i, " ".join(text), int(toxic)))
    return found


def ratios_by_hand(counts):
    """Log-ratios by context and next character, from ``(context, next)`` to (toxic, ordinary)."""
    order, discount = toxicity.ORDER, toxicity.DISCOUNT
    shared, above = {}, {}
    for size in range(order - 2, -1, -1):
        longer = {k for k in counts if len(k[0]) == size + 1} | {k for k in above}
        above = Counter((context[1:], following) for context, following in longer)
        shared[size] = above
    even = 1 / (1 + len({following for _, following in counts}))

    def lower(context, following):
        size = len(context)
        own = {f: n for (c, f), n in shared[size].items() if c == context}
        below = lower(context[1:], following) if size else even
        return (max(own[following] - discount, 0) + discount * len(own) * below) / sum(own.values())

    def chance(side, context, following):
        own = {f: n[side] for (c, f), n in counts.items() if c == context and n[side]}
        below = lower(context[1:], following)
        if not own:
            return below
        return (max(own.get(following, 0) - discount, 0) + discount * len(own) * below) / sum(own.values())

    return {key: math.log(chance(0, *key) / chance(1, *key)) for key in counts}


def test_log_ratios_by_hand(spark):
    counts = defaultdict(lambda: [0, 0])
    for side, text in enumerate(["idiot idiots abba ab ab", "abba abbey baab abab abcabc ab"]):
        for word, n in Counter(text.split()).items():
            marked = "^" + word + "$"
            for at in range(1, len(marked)):
                counts[marked[max(0, at - toxicity.ORDER + 1) : at], marked[at]][side] += n
    rows = [(context, following, *n) for (context, following), n in counts.items()]
    grams = spark.createDataFrame(rows, "context string, next string, toxic bigint, ordinary bigint")
    found = {(r["context"], r["next"]): r["ratio"] for r in toxicity.log_ratios(grams).collect()}
    expected = ratios_by_hand(counts)
    assert found.keys() == expected.keys()
    for key, ratio in expected.items():
        assert found[key] == pytest.approx(ratio, abs=1e-9), key


def test_toxic_words_are_caught_in_texts_of_any_length(spark):
    rows = invented(1200)
    docs = spark.createDataFrame([(i, text) for i, text, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, toxic) for i, _, toxic in rows], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    clean = " ".join(PLAIN * 1500) + "."
    asked = [(0, "Grubnaking!"), (1, clean), (2, clean + " what a zolferish thing"), (3, ""), (4, None), (5, "?!"),
             (6, "the old house"), (7, "GRUBNAKS near the river")]
    asked += [(10 + i, text) for i, text, _ in invented(300, seed=2)]
    scored = toxicity.score(spark.createDataFrame(asked, "doc_id long, text string"), model)
    found = {r["doc_id"]: r["found"]["score"] for r in scored.collect()}
    assert all(0 <= s <= 1 for s in found.values())
    assert [found[i] >= 0.5 for i in range(8)] == [True, False, True, False, False, False, False, True]
    assert found[3] == found[4] == found[5]
    held = [found[10 + i] >= 0.5 for i, _, _ in invented(300, seed=2)]
    truth = [bool(toxic) for _, _, toxic in invented(300, seed=2)]
    assert sum(a != b for a, b in zip(held, truth)) <= 3


def test_toxicity_edge_cases(spark):
    docs = spark.createDataFrame(
        [(1, "a b", "x"), (1, "a b", "x"), (None, "c", "x"), (2, None, "y"), (3, "d e f", "z")],
        "doc_id long, text string, found string",
    ).withColumnsRenamed({"found": "score"})
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one = spark.createDataFrame([(1, 1), (1, 0), (3, None), (None, 1)], "doc_id long, toxic int")
    for labels, expected in ((none, 0.0), (one, 1.0)):
        scored = toxicity.score(docs, toxicity.learn(docs, labels)).collect()
        assert len(scored) == 5 and {r["found"]["score"] for r in scored} == {expected}
        assert {r["score"] for r in scored} == {"x", "y", "z"}
    model = toxicity.learn(docs, one.union(spark.createDataFrame([(3, 0)], one.schema)))
    again = {r["doc_id"]: r["found"] for r in toxicity.score(docs, model).where("doc_id = 1").collect()}
    assert len(again) == 1
    empty = toxicity.score(docs.limit(0), toxicity.learn(docs.limit(0), none))
    assert empty.collect() == [] and "found" in empty.columns


def test_toxicity_labels_of_the_held_out_fold_are_not_read(spark, sf_dir):
    scored = QUERIES["op11_toxicity"](spark, sf_dir)
    assert scored.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = scored.collect()
    assert len(rows) == 200
    assert all(r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in rows)


# --- ranked search -----------------------------------------------------------------------

def ranked_by_hand(docs, items):
    """Rows of ``search`` over (doc_id, text) and (item_id, text)."""
    held = [Counter(terms(text or "")) for _, text in docs]
    sizes = [sum(own.values()) for own in held]
    n, length = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(term for own in held for term in own)
    found = []
    for item_id, text in items:
        scored = []
        for place, (doc_id, _) in enumerate(docs):
            score = 0
            for term, repeats in Counter(terms(text or "")).items():
                if tf := held[place][term]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1)))
                    m = 25 + 75 * sizes[place] * n // length
                    score += repeats * w * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, place))
        for rank, (score, null, doc_id, _) in enumerate(sorted(scored)[: ball_tree.TOP], 1):
            found.append((item_id, rank, None if null else doc_id, -score))
    return sorted(found, key=str)


def searched(spark, docs, items):
    found = ball_tree.search(
        spark.createDataFrame(docs, "doc_id long, text string").withColumns({"row": F.lit(1), "score": F.lit("s")}),
        spark.createDataFrame(items, "item_id long, text string").withColumns({"item": F.lit(1), "rank": F.lit("r")}),
    )
    return sorted(map(tuple, found.collect()), key=str)


def invented_texts(rows, seed):
    draw = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["Élan", "naïve", "x2"]
    return [" ".join(draw.choice(vocabulary, draw.integers(0, 60), p=None)) + "." for _ in range(rows)]


@pytest.mark.parametrize("block", [3, 1000])
def test_search_by_hand(spark, monkeypatch, block):
    monkeypatch.setattr(ball_tree, "QUERY_ITEMS", block)
    texts = invented_texts(400, 3)
    docs = list(enumerate(texts[:200])) + [(500 - i, texts[0]) for i in range(150)] + [(None, texts[0]), (7, texts[7]), (3, None), (4, "")]
    items = list(enumerate(texts[200:212])) + [(0, texts[0]), (1, texts[1]), (1, texts[1]), (50, None), (51, "!?"), (52, "w1 W1 w1"), (None, "w5")]
    assert searched(spark, docs, items) == ranked_by_hand(docs, items)


def test_search_of_empty_tables_and_long_texts(spark):
    long = " ".join(f"t{i % 5000}" for i in range(60_000))
    assert searched(spark, [], [(1, "a")]) == []
    assert searched(spark, [(1, "a")], []) == []
    assert searched(spark, [(1, None)], [(1, "a")]) == []
    docs, items = [(1, long), (2, "t1 t2"), (3, "other")], [(1, long), (2, "t2")]
    assert searched(spark, docs, items) == ranked_by_hand(docs, items)


@pytest.mark.parametrize("groups, share", [(1, 1.0), (64, 1.0), (4096, 0.7)])
def test_bounds_hold_and_prune(monkeypatch, groups, share):
    monkeypatch.setattr(ball_tree, "GROUPS", groups)
    draw = np.random.default_rng(5)
    topics = [draw.integers(0, 200, 40) for _ in range(12)]
    rows = [np.unique(np.concatenate([draw.choice(topics[i % 12], 20), draw.integers(0, 200, 2)])) for i in range(1500)]
    starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    columns = np.concatenate(rows)
    values = draw.integers(0, 10**10, len(columns))
    tree = ball_tree.Tree(starts, columns, values, 200)
    dense = np.zeros((1500, 200), np.int64)
    dense[np.repeat(np.arange(1500), np.diff(starts)), columns] = values
    asked = [np.unique(draw.choice(topics[i % 12], 8)) for i in range(40)]
    items = ball_tree.Items(list(range(40)), np.concatenate([[0], np.cumsum([len(a) for a in asked])]),
                            np.concatenate(asked), np.ones(sum(map(len, asked)), np.int64), {i: i for i in range(200)})
    bounds = tree.bounds(items.starts, items.columns, items.counts, 201)
    exact = np.array([[dense[d][a].sum() for d in tree.order] for a in asked])
    for node, (low, high) in enumerate(tree.nodes):
        assert (bounds[:, node] >= exact[:, low:high].max(axis=1)).all()
    best = [ball_tree._Best() for _ in asked]
    leaves = ball_tree._search(tree, items, items.columns, 200, list(range(1500)), list(range(1500)), best)
    for a, mine in zip(asked, best):
        scores = dense[:, a].sum(axis=1)
        order = sorted(range(1500), key=lambda d: (-scores[d], d))[: ball_tree.TOP]
        assert [(f[3], -f[0]) for f in mine.found] == [(d, scores[d]) for d in order]
    assert leaves <= share * 40 * sum(c is None for c in tree.children)


# --- hard negatives ----------------------------------------------------------------------

def negatives_by_hand(rows):
    kept = [(place, i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, [math.floor(256 * x) for x in v])
            for place, (i, v, label) in enumerate(rows)
            if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    found = []

    def order(scored):
        return sorted(scored, key=lambda s: (-s[0], s[2] is None, s[2] or 0, s[1]))

    for place, i, label, v in kept:
        if i is None or i % 100:
            continue
        scored = [(sum(x * y for x, y in zip(v, w)), p, j, other) for p, j, other, w in kept if p != place]
        for score, _, positive, _ in order([s for s in scored if s[3] == label])[:5]:
            band = [s for s in scored if s[3] != label and 30 * score <= 100 * s[0] <= 90 * score]
            for rank, (negative, _, j, _) in enumerate(order(band)[:10], 1):
                found.append((i, positive, rank, j, score, negative))
    return sorted(found, key=str)


def mined(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(1)
    found = hard_negatives.mine(df.withColumns({"row": F.lit("r"), "planes": F.lit(1), "a": F.lit(0)}))
    return sorted(map(tuple, found.collect()), key=str)


@pytest.mark.parametrize("anchors, candidates", [(1024, 4096), (3, 50)])
def test_negatives_by_hand(spark, monkeypatch, anchors, candidates):
    monkeypatch.setattr(hard_negatives, "ANCHOR_ROWS", anchors)
    monkeypatch.setattr(hard_negatives, "CANDIDATE_ROWS", candidates)
    draw = np.random.default_rng(9)
    vectors = [list(map(float, np.float32(draw.normal(0.05, 0.15, 20)))) for _ in range(500)]
    rows = [(i, v, int(draw.integers(0, 3))) for i, v in enumerate(vectors)]
    rows += [(1000 + i, vectors[0], 1) for i in range(200)] + [(1000, vectors[0], 1), (100, vectors[5], 2)]
    rows += [(None, vectors[2], 0), (2000, None, 1), (2001, vectors[1], None), (2002, vectors[1][:7], 1), (2100, [], 2),
             (2003, [float("nan")] * 20, 1), (2004, [float("inf")] * 20, 1), (2005, [None, 1.0], 2)]
    assert mined(spark, rows) == negatives_by_hand(rows)


def test_negatives_edge_cases(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(100, [1.0], 1)]) == []
    assert mined(spark, [(100, [1.0], 1), (101, [1.0], 1), (103, [0.5], 2)]) == [(100, 101, 1, 103, 65536, 32768)]
    with pytest.raises(ValueError, match="63 bits"):
        mined(spark, [(100, [1e12], 1), (101, [1e12], 1)])


def test_products_are_exact():
    draw = np.random.default_rng(4)
    for size, most in ((8, 3), (64, 200), (72, 1 << 24)):
        a, c = draw.integers(-most, most, (5, size)), draw.integers(-most, most, (90, size))
        c[0], c[1] = -most, most - 1
        bits = int(most).bit_length() + 1
        planes = hard_negatives.packed_planes(c, bits).transpose(1, 2, 0)
        assert (hard_negatives.scores(a, planes, np.int64) == a @ c.T).all()
