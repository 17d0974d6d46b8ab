"""Conversations as marked text with a loss mask, in Spark expressions only.

    <|im_start|>role<|im_sep|>text<|im_cont|>next text of the same role<|im_end|>\\n

Turns are collected and sorted in blocks of turn numbers and merged there into one turn with the
array of their texts; the blocks of a conversation are then joined. All but the sorting takes time
linear in the number of turns, also where very many turns have one number or none and so
stand in one block.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

OPEN, SEP, CONT, CLOSE = "<|im_start|>", "<|im_sep|>", "<|im_cont|>", "<|im_end|>\n"
#: Strings that steer common chat models; inside a text they are broken up by a backslash.
CONTROL = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
#: Turn numbers that one sorted array may span.
BLOCK = 256


def escape(text: Column) -> Column:
    """No control string is left: ``\\`` is doubled, and ``\\`` follows a control string's first character."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return reduce(
        lambda out, control: F.replace(out, F.lit(control), F.lit(f"{control[0]}\\{control[1:]}")),
        CONTROL,
        doubled,
    )


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _run(text: Column, loss: bool | Column = False) -> Column:
    return F.struct(text.alias("text"), (F.lit(loss) if isinstance(loss, bool) else loss).alias("loss"))


def _opening(role: Column) -> Column:
    return F.concat(F.lit(OPEN), escape(role), F.lit(SEP))


def _merge(said: str, starts: str) -> Column:
    """Adjacent turns of one role as one, with the list of their texts: a slice of ``said`` from start to start."""

    def turn(start: Column, i: Column) -> Column:
        after = F.coalesce(F.get(starts, i + 1), F.size(said))
        texts = F.transform(F.slice(said, start + 1, after - start), lambda turn: turn["text"])
        return F.struct(F.get(said, start)["role"].alias("role"), texts.alias("texts"))

    return F.transform(starts, turn)


def _starts(said: str) -> Column:
    """Places, from 0, of the turns whose role is not that of the turn before."""
    places = F.transform(said, lambda turn, i: F.when((i == 0) | (turn["role"] != F.get(said, i - 1)["role"]), i))
    return F.array_compact(places)


def _runs(merged: Column, learned: str) -> Column:
    """Runs of a block, without the opening of its first turn and the closing of its last."""

    def texts(turn: Column) -> Column:
        pieces = F.transform(turn["texts"], escape)
        loss = turn["role"] == learned
        return F.flatten(
            F.transform(
                pieces,
                lambda piece, i: F.when(i == 0, F.array(_run(piece, loss))).otherwise(
                    F.array(_run(F.lit(CONT)), _run(piece, loss))
                ),
            )
        )

    return F.flatten(
        F.transform(
            merged,
            lambda turn, i: F.when(i == 0, texts(turn)).otherwise(
                F.concat(F.array(_run(F.concat(F.lit(CLOSE), _opening(turn["role"])))), texts(turn))
            ),
        )
    )


def format_conversations(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    learned: str = "assistant",
) -> DataFrame:
    """``conversation``, ``formatted`` and ``runs``: the same text cut into runs (text, loss).

    Turns are in the order of their numbers, null numbers last, ties by role and text; rows
    that repeat are turns that repeat. A null role or text is an empty one; rows without
    a conversation are one conversation of their own. Texts of the role ``learned`` are under the
    loss mask, each as one run. Other columns are ignored, whatever their names. No rows give
    no conversations.
    """
    rows = turns.select(
        F.col(conversation).alias("key"),
        F.floor(F.col(turn) / BLOCK).alias("block"),
        F.struct(
            F.col(turn).isNull().alias("missing"),
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        ).alias("said"),
    )
    merged = (
        rows.groupBy("key", "block")
        .agg(F.sort_array(F.collect_list("said")).alias("said"))
        .select("key", "block", "said", _starts("said").alias("starts"))
        .select("key", "block", _merge("said", "starts").alias("merged"))
    )
    blocks = merged.select(
        "key",
        F.struct(
            F.col("block").isNull().alias("missing"),
            F.col("block"),
            F.element_at("merged", 1)["role"].alias("first"),
            F.element_at("merged", -1)["role"].alias("last"),
            _runs(F.col("merged"), learned).alias("runs"),
        ).alias("part"),
    )
    parts = blocks.groupBy("key").agg(F.sort_array(F.collect_list("part")).alias("parts"))

    def joint(part: Column, i: Column) -> Column:
        before = F.get(F.col("parts"), i - 1)["last"]
        return (
            F.when(i == 0, _opening(part["first"]))
            .when(before == part["first"], F.lit(CONT))
            .otherwise(F.concat(F.lit(CLOSE), _opening(part["first"])))
        )

    runs = F.concat(
        F.flatten(
            F.transform(
                "parts", lambda part, i: F.concat(F.array(_run(joint(part, i))), part["runs"])
            )
        ),
        F.array(_run(F.lit(CLOSE))),
    )
    return parts.select(F.col("key").alias(conversation), runs.alias("runs")).withColumn(
        "formatted", F.array_join(F.transform("runs", lambda run: run["text"]), "")
    )


def read_turns(formatted: Column) -> Column:
    """Turns (role, text) as they were before formatting, read from the marked text."""

    def turns(block: Column) -> Column:
        head = F.substring_index(block, SEP, 1)
        role = unescape(F.substring(head, F.lit(len(OPEN) + 1), F.length(head)))
        body = F.substring(block, F.length(head) + len(SEP) + 1, F.length(block))
        return F.transform(
            F.split(body, r"<\|im_cont\|>"),
            lambda piece: F.struct(role.alias("role"), unescape(piece).alias("text")),
        )

    blocks = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda block: block != "")
    return F.flatten(F.transform(blocks, turns))


def read_learned(runs: Column) -> Column:
    """All text under the loss mask, unescaped."""
    learned = F.filter(runs, lambda run: run["loss"])
    return F.array_join(F.transform(learned, lambda run: unescape(run["text"])), "")


def digests(formatted: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """Counts and hashes of the turns and of the learned text, read back from the output."""
    read = formatted.select(
        conversation,
        F.col("formatted"),
        read_turns(F.col("formatted")).alias("turns"),
        read_learned(F.col("runs")).alias("learned"),
    )
    said = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return read.select(
        conversation,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
