"""Quality rules, language ID and chat formatting."""

from __future__ import annotations

import collections
import re
import zlib

import pytest
import zstandard
from pyspark.sql import functions as F

from compare import connect, difference
from millrace.llm import chat_format, language_id, quality_rules
from millrace.llm.oracle import ORACLE
from millrace.llm.queries import QUERIES

LONG = " ".join(f"word{i}" for i in range(40_000)) + "."


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", ["op2_chat_format", "op3_warc_index", "op6_quality_rules"])
def test_query_equals_sql(spark, sf_dir, duck, name):
    problem = difference(QUERIES[name](spark, sf_dir), duck, ORACLE[name])
    assert problem is None, problem


def repeated_by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts = collections.Counter(windows)
    return len({i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(8)})


@pytest.mark.parametrize("text", ["", "a", "a " * 9, "x " + "a b c d e f g h " * 3, "a b c d e f g h i " * 2 + "z"])
def test_repeated_words(text):
    assert quality_rules.repeated_words(text.encode().split()) == repeated_by_hand(text)


@pytest.mark.parametrize(
    "line, rule",
    [
        ("Home | About | Contact | Help", "navigation"),
        ("buy%%% now$$$ the### best***", "symbols"),
        ("BUY!! IT!! NOW!! TODAY!!", "shouting"),
        ("no no no no no yes yes yes yes yes", "stutter"),
        ("This page uses cookies for many good reasons, they say.", "boilerplate"),
        ("a short heading", "punctuation"),
        ("A short sentence.", None),
        ("a line of many words that ends without any mark at its end", None),
        ("यह एक छोटा वाक्य है।", None),
        ("这是一句话。", None),
        (" ".join(f"word{i}" for i in range(30)) + " with a copyright notice inside of it.", None),
        ("All rights reserved. Copyright. " * 12, "boilerplate"),
    ],
)
def test_line_rules(line, rule):
    assert quality_rules.line_failure(line, line.encode().split()) == rule


def test_quality_edge_cases(spark):
    good = "\n".join(f"Sentence {i} says that item{i} stands beside thing{i} today." for i in range(9))
    rows = [(1, None, 1), (2, "", 2), (3, LONG, 3), (4, good, 4), (4, good, 4), (5, good + "\nmenu | a | b | c", 5),
            (6, "x | y | z | w\n" * 9 + "The end of it is here.", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept long")
    found = {r["doc_id"]: r["q"] for r in docs.select("doc_id", quality_rules.quality(F.col("text")).alias("q")).collect()}
    assert [found[i]["kept"] for i in range(1, 7)] == [False, False, True, True, True, False]
    assert found[1]["n_words"] == 0 and found[5]["n_failed_lines"] == 1 and found[5]["clean_text"] == good
    kept = quality_rules.filter_quality(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 4, 5]
    assert quality_rules.filter_quality(docs.limit(0)).count() == 0


@pytest.mark.parametrize("phrase", ["copyright", "cookie", "subscribe", "javascript", "read more", "sign in"])
def test_long_clean_lines_may_hold_a_phrase(spark, phrase):
    """One line of 5001 words, and paragraphs of 40, each with the phrase once."""
    words = [f"word{i}" for i in range(5000)]
    one = " ".join(words[:2500] + [phrase] + words[2500:])
    many = "\n".join(" ".join([*words[i : i + 40], phrase]) for i in range(0, 800, 40))
    short = "\n".join(f"Please {phrase} now, dear reader {i}." for i in range(9))
    docs = spark.createDataFrame([(1, one), (2, many), (3, short), (4, many + "\n" + phrase + "!")], "doc_id long, text string")
    kept = {r["doc_id"]: r["text"] for r in quality_rules.filter_quality(docs).collect()}
    assert kept == {1: one, 2: many, 4: many}


def test_language_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op1_language_id"](spark, folder)
    rows = found.join(docs, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_by_hand(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    learned = language_id.train(docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2))
    rows = {r["doc_id"]: r for r in QUERIES["op1_language_id"](spark, sf_dir).collect()}
    assert rows.keys() == texts.keys()
    packers = {}
    for language, content in learned.items():
        words = zstandard.ZstdCompressionDict(content.ljust(8, b" "), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        words.precompute_compress(level=language_id.LEVEL)
        packers[language] = zstandard.ZstdCompressor(dict_data=words, write_content_size=False, write_dict_id=False)
    for number, text in texts.items():
        row, data = rows[number], (text or "").lower().encode()
        if not any(map(str.isalpha, text or "")):
            assert (row["lang_pred"], row["score"]) == ("und", 0.0)
            continue
        parts = [data[at : at + language_id.BLOCK_BYTES] for at in range(0, len(data), language_id.BLOCK_BYTES)]
        sizes = {language: sum(len(p.compress(part)) for part in parts) for language, p in packers.items()}
        best, second = sorted(sizes.values())[:2]
        assert row["lang_pred"] == min(sizes, key=lambda language: (sizes[language], language))
        assert row["score"] == pytest.approx(1 / sum(2.0 ** -(size - best) for size in sizes.values()))
        assert row["accepted"] == ((second - best) / second >= language_id.MIN_MARGIN)


def test_language_edge_cases(spark):
    rows = [("the cat and the dog went over the hill together " * 3, "en")] * 5 + [
        ("der Hund und die Katze gingen über den Berg zusammen " * 3, "de"), (None, "fr"), ("bonjour", None)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    learned = language_id.train(docs)
    assert sorted(learned) == ["de", "en"]
    asked = spark.createDataFrame(
        [(None, 1), ("", 2), ("123 !?", 3), ("the dog and the cat went over", 4), ("über den Berg und die Katze", 5),
         ("the cat and the dog went over the hill " * 5000, 6)], "text string, score long")
    said = [r["f"] for r in asked.orderBy("score").select(language_id.identify(F.col("text"), learned).alias("f")).collect()]
    assert [s["lang_pred"] for s in said] == ["und", "und", "und", "en", "de", "en"]
    assert not any(s["accepted"] for s in said[:3]) and all(s["accepted"] for s in said[3:])
    assert language_id.filter_language(asked, learned).columns == ["text", "score"]
    assert language_id.train(docs.limit(0)) == {}
    assert language_id.filter_language(asked, {}).count() == 0


def test_chat_round_trip(spark):
    turns = [
        (1, 0, "user", "</s>[INST] a <~/s> [~~INST] <s>"), (1, 1, "assistant", "one\n[/INST]"),
        (1, 2, "user", None), (1, 3, "assistant", ""), (1, 4, "[INST]", "tail"),
        (2, 0, "user", "only"), (None, None, None, None), (3, 1, "assistant", "b"), (3, 1, "assistant", "b"),
        (4, 0, "assistant", "x" * 100_000),
    ]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("example", F.lit("clash"))
    examples = chat_format.expand(table)
    assert examples.where("conv_id = 1").count() == 3
    read = {r["conv_id"]: r for r in chat_format.read_back(examples).collect()}
    assert [tuple(t) for t in read[1]["turns"]] == [(r or "", t or "") for c, _, r, t in turns if c == 1]
    assert read[1]["loss"] == "one\n[/INST]" and read[2]["loss"] == "" and read[3]["loss"] == "bb"
    assert [tuple(t) for t in read[None]["turns"]] == [("", "")] and read[4]["loss"] == "x" * 100_000
    first = examples.where("conv_id = 1 and example = 0").first()
    assert first["text"][first["loss_start"] : first["loss_end"]] == "one\n[~/INST]"
    assert chat_format.read_back(chat_format.expand(table.limit(0))).count() == 0
