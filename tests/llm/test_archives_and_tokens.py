"""WARC index, byte-level BPE and packing."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import byte_bpe, packing, warc_index
from millrace.llm.queries import QUERIES, word_tokenizer
from packing_check import check_packing


@pytest.mark.parametrize("seed", range(5))
def test_loser_tree_merges(seed):
    draw = random.Random(seed)
    runs = [sorted(draw.choices(range(20), k=draw.randint(0, 9))) for _ in range(draw.randint(0, 9))]
    assert list(warc_index.LoserTree(runs)) == sorted(x for run in runs for x in run)


def test_url_keys():
    assert warc_index.url_key("HTTP://www.Example.org:80/A?b=2&a=1#x") == "org,example)/a?a=1&b=2"
    assert warc_index.url_key("") == ")/" and warc_index.url_key("http://[bad") == "http://[bad"


def test_warc_edge_cases(spark):
    big = "é" * 600 + "\r\n\r\nWARC/1.1\r\n"
    rows = [(1, "http://b.org/", big), (2, "http://a.org/\r\nx", big), (3, "http://a.org/", big), (3, "http://a.org/", big),
            (4, None, None), (5, "http://a.org/", ""), (6, "http://c.org", "short"), (7, "http://c.org", "short"),
            (None, "http://d.org", "none"), (8, "http://e.org", "y" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("record", F.lit("clash"))
    index = warc_index.archive_index(pages).collect()
    keys = [(r["url_key"], r["captured"], r["record"]) for r in index]
    assert keys == sorted(keys) and len(index) == len(rows)
    by_id = {r["record"]: r for r in index}
    assert [by_id[str(i)]["record_type"] for i in (1, 2, 3, 6, 7)] == ["revisit", "revisit", "response", "response", "response"]
    assert by_id["1"]["refers_to"] == "3" and by_id["1"]["payload_bytes"] == len(big.encode())
    assert by_id["1"]["payload_digest"] == hashlib.sha1(big.encode()).hexdigest()
    assert by_id["4"]["payload_bytes"] == 0 and by_id[""]["payload_bytes"] == 4
    assert warc_index.archive_index(pages.limit(0)).count() == 0
    merged = warc_index.merge_runs(spark.createDataFrame([r.asDict() for r in index], warc_index._RUN), 2).collect()
    assert [(r["url_key"], r["captured"], r["record"]) for r in merged] == keys
    assert {r["url_key"]: r["captures"] for r in warc_index.histories(spark.createDataFrame(index)).collect()}["org,c)/"] == 2


@pytest.fixture(scope="module")
def codec():
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return byte_bpe.Codec(ranks, public_tokenizers.PATTERN)


def reference(codec):
    return tiktoken.Encoding("own", pat_str=codec.pattern, mergeable_ranks=codec.ranks, special_tokens={})


def test_bpe_equals_tiktoken(spark, codec):
    draw = random.Random(1)
    texts = ["", None, " " * 5000, "a" * 3000, "日本語 <|endoftext|>\n\n\n x", "long word " * 20_000]
    texts += ["".join(draw.choices("abe 'll\n\t12étheingIN!", k=60)) for _ in range(200)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("ids", F.lit(1))
    found = table.select("doc_id", byte_bpe.encode(F.col("text"), codec).alias("ids"))
    found = found.select("doc_id", "ids", byte_bpe.decode(F.col("ids"), codec).alias("bytes")).collect()
    theirs = reference(codec)
    for row in found:
        text = texts[row["doc_id"]] or ""
        assert row["ids"] == theirs.encode_ordinary(text) and bytes(row["bytes"]) == text.encode()
    assert table.limit(0).select(byte_bpe.encode(F.col("text"), codec)).count() == 0


def test_bpe_round_trip_in_one_crossing(spark, codec):
    texts = [None, "", "twice", "twice", "日本語 ñ", "long word " * 50_000]
    table = spark.createDataFrame(list(enumerate(texts)), "ids long, text string").withColumn("decoded", F.lit("x"))
    both = table.select("ids", "decoded", byte_bpe.round_trip(F.col("text"), codec).alias("both"))
    for row in both.collect():
        text = texts[row["ids"]] or ""
        assert row["both"]["ids"] == reference(codec).encode_ordinary(text)
        assert bytes(row["both"]["decoded"]) == text.encode() and row["decoded"] == "x"
    assert both.limit(0).count() == 0


def test_bpe_appends_and_edits(codec):
    vocabulary = codec.ready().vocabulary
    draw = random.Random(2)
    for _ in range(50):
        data = bytes(draw.choices(b"the and ing on", k=400))
        prefixes = byte_bpe.Prefixes(vocabulary, data[:100])
        prefixes.append(data[100:])
        assert prefixes.last == byte_bpe.Prefixes(vocabulary, data).last
        a, b = sorted(draw.choices(range(len(data)), k=2))
        b = min(b, a + 5)
        new = bytes(draw.choices(b"xyz the", k=draw.randint(0, 6)))
        computed = prefixes.edit(a, b, new)
        assert prefixes.last == byte_bpe.Prefixes(vocabulary, data[:a] + new + data[b:]).last
        assert computed <= len(prefixes.data) - a


def test_bpe_query(spark, sf_dir, codec):
    theirs = reference(codec)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op5_byte_bpe"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = theirs.encode_ordinary(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()


def test_word_tokenizer_equals_library():
    ours, theirs = packing.WordTokenizer(word_tokenizer()).ready(), Tokenizer.from_str(word_tokenizer())
    texts = ["", "a<|endoftext|>b  <|startoftext|> Σς ΑΣ", "\x01 x\x01y \x01", "é é İ\x1c x 's don't 12", "\t\n"]
    for text, ids in zip(texts, ours.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == theirs.encode(text, add_special_tokens=False).ids


def best_price(sizes, prices, capacity):
    best = [0.0] * (capacity + 1)
    for room in range(1, capacity + 1):
        best[room] = max([best[room - 1]] + [best[room - s] + p for s, p in zip(sizes, prices) if s <= room])
    return best[capacity]


@pytest.mark.parametrize("seed", range(5))
def test_knapsack_and_program(seed):
    draw = np.random.default_rng(seed)
    sizes = np.unique(draw.integers(1, 200, 20))
    prices = draw.random(len(sizes))
    taken = packing.knapsack(sizes, prices, 200)
    assert taken @ sizes <= 200 and abs(taken @ prices - best_price(sizes, prices, 200)) < 1e-9
    demand = draw.integers(1, 500, len(sizes))
    plan = packing.solve(sizes, demand, 200)
    assert all(pattern @ sizes <= 200 for pattern, _ in plan)
    assert (sum(pattern * copies for pattern, copies in plan) == demand).all()


def test_program_generates_columns():
    # Greedy patterns pair 60 with 40 at a loss; the best plan is 60 + 40 and 50 + 50.
    sizes, demand = np.array([24, 28, 36, 44, 52]), np.array([300, 210, 400, 350, 120])
    bound = -(-int(sizes @ demand) // 100)
    sequences = sum(copies for _, copies in packing.solve(sizes, demand, 100))
    greedy = float(packing.greedy_basis(sizes, demand, 100)[1].sum())
    assert bound <= sequences <= greedy + len(sizes)


def test_pricing_finds_what_greedy_patterns_miss(monkeypatch):
    """Six of 51 and 26 and 23, and three of 27, 27, 23, 23, fill sequences of 100; greedy
    patterns put 51 beside 27 and need two more of eleven."""
    sizes, demand = np.array([23, 26, 27, 51]), np.array([1200, 600, 600, 600])
    calls, knapsack = [], packing.knapsack
    monkeypatch.setattr(packing, "knapsack", lambda *a: calls.append(1) or knapsack(*a))
    plan = packing.solve(sizes, demand, 100)
    assert calls and sum(copies for _, copies in plan) == 900
    assert (sum(copies * pattern for pattern, copies in plan) == demand).all()
    monkeypatch.setattr(packing, "knapsack", lambda sizes, prices, capacity: np.eye(len(sizes), dtype=np.int64)[0])
    assert sum(copies for _, copies in packing.solve(sizes, demand, 100)) == 1100


def test_words_are_lowered_as_the_tokenizer_does():
    ours, theirs = packing.WordTokenizer(word_tokenizer()).ready(), Tokenizer.from_str(word_tokenizer())
    assert ours.lowers
    for text in ("I İI ıI ΣΑΣ A\u0301 K\u212a ǅ ﬁ ẞ STRASSE", "Ab'S AB'Ll x'RE", "ÀB A\u0300B \u0130\u0307I"):
        (code,) = ours.encode([text])
        assert np.frombuffer(code, "<u4").tolist() == theirs.encode(text, add_special_tokens=False).ids


def test_packing_query(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    tokens, sequences = check_packing(QUERIES["op10_packing"](spark, sf_dir).collect(), texts)
    assert sequences * 4096 < 1.05 * tokens


def test_packing_edge_cases(spark):
    texts = {1: None, 2: "", 3: "word " * 20_000, 4: "same text", 5: "same text", None: "no id"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("size", F.lit("clash"))
    found = packing.pack(docs, word_tokenizer(), keep_ids=True).collect()
    check_packing(found, texts)
    assert all(len(p["ids"]) == 4 * p["length"] for p in found)
    assert packing.pack(docs.limit(0), word_tokenizer()).count() == 0
    twice = packing.pack(docs.where("doc_id = 4").union(docs.where("doc_id = 4")), word_tokenizer()).collect()
    assert len({(p["sequence_id"], p["offset"]) for p in twice}) == 2
