"""LM scoring, suffix dedup, I-Match, ProbMinHash, and the pipeline."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import struct
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import regex
import xxhash
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from compare import connect
from millrace.llm import imatch, language_id, lm_scoring, probminhash, quality_rules, suffix_dedup
from millrace.llm.components import components
from millrace.llm.oracle import ORACLE
from millrace.llm.queries import QUERIES
from millrace.session import materialize
from packing_check import check_packing


def documents(spark, folder):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}


def test_lm_base_columns_and_held_out_score(spark, sf_dir):
    tokens = {i: (t or "").encode().lower().split() + [b""] for i, t in documents(spark, sf_dir).items()}
    train = [i for i in tokens if zlib.crc32(str(i).encode()) % 7 != 2]
    counts = collections.Counter(w for i in train for w in tokens[i])
    total, types = sum(counts.values()), len(counts)
    rows = QUERIES["op4_lm_scoring"](spark, sf_dir).collect()
    assert len(rows) == len(tokens)
    for row in rows:
        own = tokens[row["doc_id"]]
        base = sum(math.log10((counts[w] + 1) / (total + types + 1)) for w in own)
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (len(own), sum(w in counts for w in own), total)
        assert row["base_score"] == pytest.approx(base, rel=1e-9)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_lm_against_counts_by_hand(spark):
    texts = ["a b a b c", "a b", "b c a", "", None, "a b a b c", "z"] * 3
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").withColumn("train", F.lit("clash"))
    found = lm_scoring.score(docs, F.col("doc_id") < 15, F.col("doc_id") % 5 == 0, block_tokens=7).collect()
    tokens = [(t or "").split() + [""] for t in texts]
    word, pair = collections.Counter(), collections.Counter()
    for own in tokens[:15]:
        word.update(own)
        pair.update(zip([""] + own, own))
    total, types = sum(word.values()), len(word)
    kept_word, kept_pair, held = collections.Counter(), collections.Counter(), []
    for i, own in enumerate(tokens[:15]):
        if i % 5 == 0:
            held += zip([""] + own, own)
        else:
            kept_word.update(own)
            kept_pair.update(zip([""] + own, own))
    bucket = lambda c: math.ceil(math.log2(c + 1))

    def parts(w, p, u, v):
        return [p[u, v] / w[u] if w[u] else 0, w[v] / total, 1 / (types + 1)]

    weights, last = {}, -math.inf
    for _ in range(lm_scoring.ROUNDS):
        sums, gain = collections.defaultdict(lambda: [0.0] * 4), 0
        for u, v in held:
            b = bucket(kept_word[u])
            shares = [l * e for l, e in zip(weights.get(b, lm_scoring.START), parts(kept_word, kept_pair, u, v))]
            for k in range(3):
                sums[b][k] += shares[k] / sum(shares)
            sums[b][3] += 1
            gain += math.log10(sum(shares))
        weights = {b: [(s[k] + 1) / (s[3] + 3) for k in range(3)] for b, s in sums.items()}
        if gain / len(held) - last < lm_scoring.LEAST_GAIN:
            break
        last = gain / len(held)
    for row in found:
        own = tokens[row["doc_id"]]
        score = sum(
            math.log10(sum(l * e for l, e in zip(weights.get(bucket(word[u]), lm_scoring.START), parts(word, pair, u, v))))
            for u, v in zip([""] + own, own)
        )
        assert row["score"] == pytest.approx(score, rel=1e-9)
    none = lm_scoring.score(docs, F.lit(None).cast("boolean"), F.lit(True)).collect()
    assert all(r["score"] == 0 and r["train_tokens"] == 0 for r in none)
    assert lm_scoring.score(docs.limit(0), F.lit(True), F.lit(True)).count() == 0


def test_lm_blocks_are_worked_on_one_at_a_time_in_little_memory():
    rng, rows, of_text = np.random.default_rng(4), [], 100
    for block in range(3):
        builder = lm_scoring._BlockBuilder()
        for i in range(1000):
            words = (rng.zipf(1.3, of_text - 1) % 20_000).tolist()
            builder.add(block * 1000 + i, " ".join(map(str, words)), i % 7 != 2, i % 7 == 3)
        rows.append(builder.row(block))
    tokens = 1000 * of_text
    schema = pa.schema([
        ("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())),
        ("train", pa.list_(pa.bool_())), ("deleted", pa.list_(pa.bool_())), ("tokens", pa.binary()), ("hashes", pa.binary()),
    ])
    blocks = lm_scoring._record(rows, schema)

    def run(step, batch):
        """What a step gives, and the most bytes of Python and numpy that it held for a token of a block."""
        found = []
        tracemalloc.start()
        for record in step(iter([batch])):
            found.append(record)
            del record
        most = tracemalloc.get_traced_memory()[1] / tokens
        tracemalloc.stop()
        return pa.Table.from_batches(found), most

    requests, asking = run(lm_scoring._requests(2), blocks)
    groups = {(r["kind"], r["bucket"]) for r in requests.select(["kind", "bucket"]).to_pylist()}
    answers = pa.concat_tables(
        lm_scoring._answer(requests.filter((pc.field("kind") == kind) & (pc.field("bucket") == bucket)))
        for kind, bucket in sorted(groups)
    ).to_pylist()
    totals = [sum(a[name] for a in answers if a["kind"] == 1) for name in ("types", "tokens")]
    answered = pa.RecordBatch.from_pylist(
        [b | {"answers": [{k: a[k] for k in ("kind", "bucket", "counts")} for a in answers if a["block"] == b["block"]]}
         for b in blocks.to_pylist()]
    )
    cells, joining = run(lm_scoring._cells(pa.schema([
        ("doc_ids", pa.list_(pa.int64())), ("ends", pa.list_(pa.int32())), ("known", pa.list_(pa.int32())),
        ("base", pa.list_(pa.float64())), ("cells", pa.binary()), ("cell_counts", pa.binary()), ("deleted_cells", pa.binary()),
    ]), *totals), answered)
    assert cells.num_rows == 3 and [len(row) for row in cells["doc_ids"].to_pylist()] == [1000] * 3
    assert totals[1] == sum(i % 7 != 2 for i in range(1000)) * of_text * 3
    assert max(asking, joining) < 70, (asking, joining)


@pytest.mark.parametrize("alphabet", [b"ab", b"abc\xff", b"a"])
def test_suffix_array(alphabet):
    draw = random.Random(3)
    for _ in range(100):
        data = bytes(draw.choices(alphabet, k=draw.randint(1, 50)))
        order = suffix_dedup.suffix_array(np.frombuffer(data, np.uint8), len(data) + 1)
        assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:])


def removed_by_hand(texts, length=suffix_dedup.LENGTH):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(d[p : p + length] for d in data for p in range(len(d) - length + 1))
    marks = []
    for d in data:
        mark = np.zeros(len(d), bool)
        for p in range(len(d) - length + 1):
            if seen[d[p : p + length]] > 1:
                mark[p : p + length] = True
        marks.append(mark)
    return marks


def check_removed(rows, texts):
    marks = removed_by_hand(texts.values())
    for row, (doc_id, text), mark in zip(sorted(rows, key=lambda r: r["doc_id"]), sorted(texts.items()), marks):
        data = np.frombuffer((text or "").encode(), np.uint8)
        assert row["doc_id"] == doc_id and bytes(row["kept"]) == data[~mark].tobytes()
        assert len(row["removed"]) == int(np.count_nonzero(np.diff(np.concatenate([[0], mark.astype(np.int8)])) == 1))


@pytest.mark.parametrize("hot", [False, True])
def test_suffix_dedup_edge_cases(spark, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(suffix_dedup, "HOT_FRAGMENTS", 1)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 700)
    draw = random.Random(4)
    words = lambda n: " ".join("".join(draw.choices("abcdefgé", k=draw.randint(1, 8))) for _ in range(n))
    passage = words(60)
    texts = {0: None, 1: "", 2: "short", 3: words(300), 4: words(50) + passage + words(40), 5: words(20) + passage,
             6: passage[:260] + words(30), 7: "ab" * 400, 8: "xy " * 300 + words(10), 9: words(10) + passage[5:230] + words(9)}
    texts[10] = texts[3]
    texts[11] = texts[3][:500] + "!" + texts[3][500:]
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("key", F.lit("clash"))
    check_removed(suffix_dedup.remove_repeated(docs).collect(), texts)
    short = suffix_dedup.shorten(docs)
    assert short.columns == docs.columns
    by_id = {r["doc_id"]: r["text"] for r in short.collect()}
    assert by_id[0] is None and by_id[2] == "short" and by_id[3] == ""
    assert suffix_dedup.remove_repeated(docs.limit(0)).count() == 0


def test_suffix_dedup_query(spark, sf_dir):
    texts = documents(spark, sf_dir)
    rows = {r["doc_id"]: r for r in QUERIES["op7_suffix_dedup"](spark, sf_dir).collect()}
    for (doc_id, text), mark in zip(texts.items(), removed_by_hand(texts.values())):
        data = np.frombuffer(text.encode(), np.uint8)
        row = rows[doc_id]
        assert (row["n_bytes"], row["n_removed"]) == (len(data), int(mark.sum()))
        assert row["kept_sha256"] == hashlib.sha256(data[~mark].tobytes()).hexdigest()


def test_imatch_query(spark, sf_dir):
    docs = sorted(documents(spark, sf_dir).items(), reverse=True)
    rows = {r["doc_id"]: r for r in QUERIES["op8_imatch"](spark, sf_dir).collect()}
    assert len(rows) == len(docs)
    same = collections.defaultdict(set)
    for k, (doc_id, text) in enumerate(docs):
        follower, other = docs[(k + 1) % len(docs)]
        half, row = len(text) // 2, rows[doc_id]
        edited = text[: len(text) - half] + other[:half]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        mine, theirs, own = (x.split("-") for x in (row["fingerprint"], rows[follower]["fingerprint"], row["edited_fingerprint"]))
        assert row["near_next"] == sum(map(str.__eq__, mine, theirs)) / len(mine)
        assert row["near_edited"] == sum(map(str.__eq__, mine, own)) / len(mine)
        same[text].add(row["fingerprint"])
    assert all(len(found) == 1 for found in same.values())


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def chained(values, form="<q", seed=42):
    """Spark's xxhash64 of numbers one after another: each hash is the seed of the next."""
    for value in values:
        seed = xxhash.xxh64(struct.pack(form, value), seed=seed).intdigest()
    return signed(seed)


def test_imatch_fingerprints_by_hand(spark, sf_dir):
    texts = documents(spark, sf_dir)
    numbers = sorted(texts, reverse=True)

    def terms_of(text):
        words = set(regex.split(r"[^\p{L}\p{N}]+", text.lower())) - {""}
        return sorted(signed(xxhash.xxh64(w.encode(), seed=42).intdigest()) for w in words)

    held = collections.Counter(t for text in texts.values() for t in terms_of(text))
    kept = {t for t, n in held.items() if imatch.LOW * len(texts) <= n <= imatch.HIGH * len(texts)}

    def in_lexicon(term, k):
        if k == 0:
            return True
        seed = xxhash.xxh64(struct.pack("<q", term), seed=42).intdigest()
        return signed(xxhash.xxh64(struct.pack("<i", k), seed=seed).intdigest()) % 100 >= imatch.LEFT_OUT

    masks = {t: sum(1 << k for k in range(imatch.LEXICONS) if in_lexicon(t, k)) for t in kept}

    def fingerprint(text):
        own = terms_of(text)
        # High bits of the term above, the lexicons that hold it below.
        entries = sorted(((t >> 10) << 10) | masks[t] for t in own if t in kept)
        hashes = []
        for k in range(imatch.LEXICONS):
            chosen = [e for e in entries if e >> k & 1]
            hashes.append(chained(chosen) if chosen else chained(own))
        return "-".join(f"{h % (1 << 64):016X}" for h in hashes)

    rows = {r["doc_id"]: r for r in QUERIES["op8_imatch"](spark, sf_dir).collect()}
    for place, number in enumerate(numbers):
        text, other = texts[number], texts[numbers[(place + 1) % len(numbers)]]
        half = len(text) // 2
        assert rows[number]["fingerprint"] == fingerprint(text)
        assert rows[number]["edited_fingerprint"] == fingerprint(text[: len(text) - half] + other[:half])


def test_imatch_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(imatch, "SLICE_ROWS", 2)
    rows = [(9, "alpha beta gamma"), (7, "Gamma, beta; ALPHA!"), (7, None), (5, ""), (None, "delta " * 30_000), (3, "x"), (3, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit("clash"))
    prints = [r["fingerprint"] for r in imatch.fingerprints(docs).collect()]
    assert len(prints) == len(rows)
    by_text = collections.defaultdict(set)
    placed = imatch.with_neighbours(docs).where("ghost = 0").collect()
    order = sorted(placed, key=lambda r: (r["slice"], r["row"]))
    assert [r["doc_id"] for r in order] == [9, 7, 7, 5, 3, 3, None]
    assert [r["next_text"] for r in order] == [r["text"] for r in order[1:] + order[:1]]
    for row, text in zip(imatch.fingerprints(docs.where("doc_id = 9 or (doc_id = 7 and text is not null)")).collect(), rows):
        by_text["same"].add(row["fingerprint"])
    assert len(by_text["same"]) == 1
    assert imatch.fingerprints(docs.limit(0)).count() == 0
    assert imatch.with_neighbours(docs.limit(0)).count() == 0


def by_hand(texts, size=5, threshold=0.8):
    sets = {}
    for i, text in texts.items():
        words = (text or "").split()
        sets[i] = frozenset(tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))) if words else frozenset()
    shared, holders = collections.Counter(), collections.defaultdict(list)
    for i, own in sets.items():
        for shingle in own:
            for other in holders[shingle]:
                shared[other, i] += 1
            holders[shingle].append(i)
    parent = {i: i for i in texts}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (a, b), count in shared.items():
        if count >= threshold * (len(sets[a]) + len(sets[b]) - count):
            parent[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in texts}


def test_probminhash_query(spark, sf_dir):
    expected = by_hand(documents(spark, sf_dir))
    assert {r["doc_id"]: r["class_id"] for r in QUERIES["op9_probminhash"](spark, sf_dir).collect()} == expected


def test_probminhash_groups(spark, monkeypatch):
    monkeypatch.setattr(probminhash, "CHUNK", 8)
    draw = random.Random(5)
    words = lambda n: ["".join(draw.choices("abcdefg", k=6)) for _ in range(n)]
    texts, base = {}, words(200)
    for i in range(30):  # a star: copies are near the first text, and less near to each other
        copy = list(base)
        for place in draw.sample(range(200), 2 if i else 0):
            copy[place] = "edit%d" % i
        texts[i] = " ".join(copy)
    for i in range(30, 40):
        texts[i] = " ".join(words(150) + base[:40])
    texts.update({40: texts[31], 41: "two words", 42: "two words", 43: "a b c d e", 44: "other small text"})
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("key", F.lit("clash"))
    assert {r["doc_id"]: r["class_id"] for r in probminhash.classes(docs).collect()} == by_hand(texts)
    kept = probminhash.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(by_hand(texts).values()))


def star(leaves, edits, seed, size=400):
    """A text and copies of it with other edits each: near to it, and less near to each other."""
    draw = random.Random(seed)
    base = ["".join(draw.choices("abcdefg", k=8)) for _ in range(size)]
    texts = {0: " ".join(base)}
    for i in range(1, leaves + 1):
        copy = list(base)
        for place in draw.sample(range(size // 5), edits):
            copy[5 * place + 2] = "edit%d" % i
        texts[i] = " ".join(copy)
    return texts


def classes_of(spark, texts):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    return {r["doc_id"]: r["class_id"] for r in probminhash.classes(docs).collect()}


def test_probminhash_rest_reaches_a_partner_that_ranks_behind_others():
    """Copies at 0.816 to the first text and 0.796 to each other, the first one agreeing least in its slots."""
    base = star(0, 0, 11)[0].split()
    texts = [" ".join(base)]
    for i in range(1, 41):
        copy = list(base)
        for place in [*range(1, 8), 7 + i]:
            copy[5 * place + 2] = "edit%d" % i
        texts.append(" ".join(copy))
    first, second, third = map(probminhash._weighted, texts[:3])
    assert max(probminhash.similarity(second, third)) < 0.8 <= max(probminhash.similarity(first, second))
    size = len(texts)
    slots = [b"\0" * 38 + b"\1" * 90] + [b"\1" * 128] * (size - 1)
    keys = [b"%02d" % i for i in range(size)]
    table = pa.table({
        "key": [keys[1], *keys], "root": [keys[1], *keys], "sketch": [slots[1], *slots], "text": [texts[1], *texts],
        "band": [7] * (size + 1), "bands": [[7]] * (size + 1), "left": [True] + [False] * size,
        "small": [True] + [False] * size,
    })
    assert probminhash._rest(table).to_pylist() == [{"leader": keys[0], "key": keys[1]}]


def test_probminhash_star_in_a_bucket_of_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(probminhash, "CHUNK", 4)
    monkeypatch.setattr(probminhash, "BLOCK", 16)
    texts = star(120, 8, 12)
    assert classes_of(spark, texts) == by_hand(texts) == dict.fromkeys(texts, 0)


def test_probminhash_copies_with_other_spaces(spark, monkeypatch):
    monkeypatch.setattr(probminhash, "CHUNK", 4)
    words = star(0, 0, 13)[0].split()
    texts = {i: " ".join(words[:i]) + "\n" * i + " \t".join(words[i:]) for i in range(1, 30)}
    assert classes_of(spark, texts) == dict.fromkeys(texts, 1)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert [tuple(r) for r in probminhash.deduplicate(docs).collect()] == [(1, texts[1])]


def test_probminhash_repeated_lines_count_once_for_the_plain_similarity(spark):
    texts = {}
    for i in range(0, 24, 2):
        words = star(0, 0, 20 + i, 300)[0].split()
        texts[i], texts[i + 1] = " ".join(words), " ".join(words + words[-15:] * 40)
    assert classes_of(spark, texts) == by_hand(texts) == {i: i - i % 2 for i in texts}


def test_probminhash_edge_cases(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "one text of some words here"), (None, "one text of some words here"), (3, "x " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r["class_size"], r["class_id"] or 0) for r in probminhash.classes(docs).collect())
    assert found == [(1, 3), (2, 0), (2, 0), (3, 1), (3, 1), (3, 1)]
    assert sorted(r["doc_id"] or 0 for r in probminhash.deduplicate(docs).collect()) == [0, 1, 3]
    assert probminhash.classes(docs.limit(0)).count() == 0


def test_probability_jaccard():
    draw = np.random.default_rng(6)
    for _ in range(20):
        ids = [np.unique(draw.integers(0, 30, 15)).astype(np.uint64) for _ in range(2)]
        a, b = ((i, draw.integers(1, 5, len(i))) for i in ids)
        wa, wb = (dict(zip(x[0].tolist(), x[1].tolist())) for x in (a, b))
        exact = sum(
            1 / sum(max(wa.get(e, 0) / wa[d], wb.get(e, 0) / wb[d]) for e in {*wa, *wb}) for d in wa.keys() & wb.keys()
        )
        assert probminhash.similarity(a, b)[1] == pytest.approx(exact)
        agreed = np.mean(probminhash.signature(*a, 4096) == probminhash.signature(*b, 4096))
        assert agreed == pytest.approx(exact, abs=0.05)


def test_components(spark):
    draw = random.Random(7)
    links = [(draw.randrange(60), draw.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)]
    parent = {n: n for pair in links for n in pair}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {n: find(n) for a, b in links if a != b for n in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def language_by_hand(text, dictionaries):
    """Whether the smallest compressed size is clear of the second one."""
    if not any(c.isalpha() for c in text):
        return False
    data, sizes = text.lower().encode(), []
    for content in dictionaries.values():
        words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        one = zstandard.ZstdCompressor(
            level=language_id.LEVEL, dict_data=words, write_content_size=False, write_dict_id=False
        )
        sizes.append(sum(len(one.compress(data[i : i + 4096])) for i in range(0, len(data), 4096)))
    best, second = sorted(sizes)[:2]
    return (second - best) / second >= language_id.MIN_MARGIN


def cleaned_by_hand(text):
    """The lines that no rule fails."""

    def fails(line):
        words = re.findall(r"[^\x20\x09-\x0D]+", line)
        if not words:
            return False
        marks = len(re.findall("[|»›•·]", line))
        phrases = "".join(m.group() for m in re.finditer(quality_rules.BOILERPLATE, line, re.I | re.A))
        return (
            marks >= max(2, len(words) / 4)
            or len(re.findall(r"[#*$%&|<>]", line)) > len(line) / 10
            or len(words) >= 3 and line.count("!") >= len(words) / 2
            or len(words) >= 8 and sum(a == b for a, b in zip(words, words[1:])) >= len(words) / 2
            or phrases and (len(words) <= 20 or len(phrases) >= len(line) / 2)
            or len(words) < 8 and words[-1][-1] not in quality_rules.TERMINAL
        )

    return "\n".join(line for line in text.split("\n") if not fails(line))


def test_pipeline_equals_brute_force(spark, sf_dir):
    """Each stage against a plain version on the rows that the stage before it left."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, sql = docs.columns, connect(sf_dir).execute(ORACLE["op6_quality_rules"])
    place = [d[0] for d in sql.description]
    kept = {row[place.index("doc_id")] for row in sql.fetchall() if row[place.index("kept")]}
    texts = {i: cleaned_by_hand(t) for i, t in documents(spark, sf_dir).items() if i in kept}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialize(stage(spark, docs, sf_dir), f"test-{name}")
        if name == "language":
            learned = language_id.train(before)
            texts = {i: t for i, t in texts.items() if language_by_hand(t, learned)}
        elif name == "near_duplicates":
            first = by_hand(texts)
            texts = {i: t for i, t in texts.items() if first[i] == i}
        elif name == "repeated_passages":
            marks = dict(zip(texts, removed_by_hand(texts.values())))
            for i, mark in marks.items():
                data = np.frombuffer(texts[i].encode(), np.uint8)
                texts[i] = data[~mark].tobytes().decode(errors="ignore")
        rows = docs.collect()
        if name == "packing":
            check_packing(rows, texts)
        else:
            assert docs.columns == columns
            assert {r["doc_id"]: r["text"] for r in rows} == texts and len(rows) == len(texts)
            assert all(r["n_chars"] == len(r["text"]) for r in rows)
    whole = corpus_pipeline.run(spark, sf_dir).drop("sequence_id", "offset", "padding")
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, docs.select(whole.columns).collect()))


def test_pipeline_stages_take_empty_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0
