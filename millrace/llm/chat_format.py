"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as context,
and its text alone under the loss mask. Turns after the last assistant turn, and
conversations without one, leave one example without a target, so that nothing of a
conversation is lost.

A turn is ``<s>[INST]role[/INST]text</s>``. Control strings inside roles and texts are
escaped by one more tilde (``</s>`` becomes ``<~/s>``, ``<~/s>`` becomes ``<~~/s>``),
which unescaping takes away again, so every text comes back as it was.

Defined results: null roles and texts are empty; turns are ordered by turn, then role
and text, null turns first, and repeated rows stay repeated turns; rows with a null
conversation id form one conversation; an empty table gives no example. A conversation
is one record, so its turns meet in one task; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

OPEN, MIDDLE, CLOSE = "<s>[INST]", "[/INST]", "</s>"
TARGET_ROLE = "assistant"


def escape(text: Column) -> Column:
    text = F.regexp_replace(text, r"<(~*/?s)>", r"<~$1>")
    return F.regexp_replace(text, r"\[(~*/?INST)\]", r"[~$1]")


def unescape(text: Column) -> Column:
    text = F.regexp_replace(text, r"<~(~*/?s)>", r"<$1>")
    return F.regexp_replace(text, r"\[~(~*/?INST)\]", r"[$1]")


def format_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), escape(role), F.lit(MIDDLE), escape(text), F.lit(CLOSE))


def expand(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Examples: ``conv_id``, ``example`` (0, 1, ... in a conversation), ``n_turns``,
    ``text``, and the loss span ``[loss_start, loss_end)`` in characters (empty without
    a target)."""
    rows = turns.select(
        F.col(conv).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("t"),
    )
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    numbered = F.transform(
        "turns",
        lambda t, i: F.struct(
            i.alias("at"),
            (t["role"] == TARGET_ROLE).alias("target"),
            F.length(escape(t["text"])).alias("chars"),
        ),
    )
    ends = F.filter(numbered, lambda t: t["target"] | (t["at"] == F.size("turns") - 1))
    examples = grouped.select(
        "conv_id",
        F.transform("turns", lambda t: format_turn(t["role"], t["text"])).alias("formatted"),
        F.posexplode(ends).alias("example", "end"),
    )
    whole = F.array_join(F.slice("formatted", F.lit(1), F.col("end.at") + 1), "")
    stop = F.length("text") - len(CLOSE)
    return examples.select(
        "conv_id", "example", (F.col("end.at") + 1).alias("n_turns"), "end", whole.alias("text")
    ).select(
        "conv_id",
        "example",
        "n_turns",
        "text",
        F.when(F.col("end.target"), stop - F.col("end.chars")).otherwise(0).cast("long").alias("loss_start"),
        F.when(F.col("end.target"), stop).otherwise(0).cast("long").alias("loss_end"),
    )


def loss_text(examples: DataFrame) -> Column:
    """The unescaped text under the loss mask of an example."""
    start, end = examples["loss_start"], examples["loss_end"]
    return unescape(F.substring(examples["text"], (start + 1).cast("int"), (end - start).cast("int")))


def parse_turns(text: Column) -> Column:
    """The turns (role, text) of an example, read back from its text."""
    pieces = F.filter(F.split(text, CLOSE), lambda p: p != "")

    def turn(piece: Column) -> Column:
        role = F.substring_index(F.substring(piece, F.lit(len(OPEN) + 1), F.length(piece)), MIDDLE, 1)
        body = F.substring(piece, F.length(role) + len(OPEN) + len(MIDDLE) + 1, F.length(piece))
        return F.struct(unescape(role).alias("role"), unescape(body).alias("text"))

    return F.transform(pieces, turn)


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation: its ``turns``, the whole ``loss`` text in order, and
    ``formatted_chars``, the characters of all its examples."""
    targets = F.sort_array(F.collect_list(F.struct("example", loss_text(examples).alias("loss"))))
    return examples.groupBy("conv_id").agg(
        parse_turns(F.max_by("text", "example")).alias("turns"),
        F.array_join(F.transform(targets, lambda t: t["loss"]), "").alias("loss"),
        F.sum(F.length("text")).alias("formatted_chars"),
    )
