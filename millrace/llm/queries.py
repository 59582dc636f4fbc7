"""The registered queries of the operators, one per operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from millrace.llm import (
    ball_tree, byte_bpe, chat_format, hard_negatives, imatch, language_id, lm_scoring, packing, probminhash, quality_rules,
    suffix_dedup, toxicity, warc_index,
)
from millrace.llm.common import fold, table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learned = language_id.train(docs.where(fold(F.col("doc_id"), 4) != 2))
    return docs.select(
        "doc_id",
        (fold(F.col("doc_id"), 4) == 2).alias("held_out"),
        language_id.identify(F.col("text"), learned).alias("found"),
    ).select("doc_id", "held_out", "found.*")


#: A conversation of control strings, beside those of the table.
CONTROL = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = spark.createDataFrame(CONTROL, "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(control)
    read = chat_format.read_back(chat_format.expand(turns))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )


def op3_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc_index.archive_index(table(spark, sf_dir, "pages"))
    return index.select(
        F.expr("try_cast(record as bigint)").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.expr("try_cast(refers_to as bigint)").alias("refers_to"),
    )


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    part = fold(F.col("doc_id"), 7)
    scored = lm_scoring.score(docs, train=part != 2, deleted=part == 3)
    return scored.select(
        "doc_id", (part == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    codec = byte_bpe.Codec(ranks, public_tokenizers.PATTERN)
    both = table(spark, sf_dir, "documents").select("doc_id", byte_bpe.round_trip(F.col("text"), codec).alias("both"))
    return both.select(
        "doc_id",
        F.size("both.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("both.ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("both.decoded", 256).alias("decoded_sha256"),
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    checked = docs.select("doc_id", quality_rules.quality(F.col("text")).alias("q")).select("doc_id", "q.*")
    return checked.drop("clean_text")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeated(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op8_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    half = F.expr("n_chars div 2").cast("int")
    kept = F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int"))
    taken = F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half)
    rows = imatch.with_neighbours(docs).withColumn("n_chars", F.length("text").cast("long"))
    rows = rows.withColumn("edited", F.concat(kept, taken)).drop("next_text")
    rows = rows.withColumn("edited_sha256", F.unhex(F.sha2("edited", 256)))
    found = imatch.fingerprint_columns(rows, ["row", "slice"], ["text", "edited"], imatch.lexicon(docs))
    following = F.lead("text_hashes").over(Window.partitionBy("slice").orderBy("row"))
    return (
        found.withColumn("next_hashes", following)
        .where("ghost = 0")
        .select(
            "doc_id",
            "n_chars",
            F.lower(F.hex("edited_sha256")).alias("edited_sha256"),
            imatch.as_text(F.col("text_hashes")).alias("fingerprint"),
            imatch.as_text(F.col("edited_hashes")).alias("edited_fingerprint"),
            imatch.likeness(F.col("text_hashes"), F.col("edited_hashes")).alias("near_edited"),
            imatch.likeness(F.col("text_hashes"), F.col("next_hashes")).alias("near_next"),
        )
    )


def op9_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probminhash.classes(table(spark, sf_dir, "documents"))


def word_tokenizer() -> str:
    with open(public_tokenizers.path("word_bpe_49k.json")) as definition:
        return definition.read()


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), word_tokenizer())


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.learn(docs, labels.where(fold(F.col("doc_id"), 5) != 0))
    scored = toxicity.score(docs, model).withColumn("score", F.col("found.score"))
    held_out = (fold(F.col("doc_id"), 5) == 0).alias("held_out")
    return scored.select("doc_id", held_out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op12_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_chat_format": op2_chat_format,
    "op3_warc_index": op3_warc_index,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_quality_rules": op6_quality_rules,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_imatch": op8_imatch,
    "op9_probminhash": op9_probminhash,
    "op10_packing": op10_packing,
    "op11_toxicity": op11_toxicity,
    "op12_ball_tree": op12_ball_tree,
    "op13_hard_negatives": op13_hard_negatives,
}
