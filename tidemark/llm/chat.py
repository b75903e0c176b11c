"""Chat formatting: one training string per conversation, and the turns read back from it.

Turns are collected per conversation and sorted; adjacent turns of one role share a header. Control strings inside
texts are escaped, so a text can never open or close a turn:

    <|im_start|>ROLE\\nTEXT<|im_next|>TEXT<|im_end|>\\n

``<``, any number of backslashes and ``|`` get one backslash more, and one less when read back; in roles ``%`` and the
line feed become ``%25`` and ``%0A``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, NEXT, END = "<|im_start|>", "<|im_next|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def format_conversations(
    turns: DataFrame, conversation: str = "conv_id", position: str = "turn", role: str = "role", text: str = "text",
    learn: str = "assistant",
) -> DataFrame:
    """One row per conversation: ``conversation, formatted, segments``.

    ``segments`` is the formatted string in pieces of ``(text, loss)``; ``loss`` marks the texts of the role to learn.
    A null role or text is empty; rows of the same position are ordered by role and text, null positions come first;
    rows without a conversation form one conversation. Other columns are ignored. No rows give no rows.
    """
    rows = turns.select(
        F.col(conversation),
        F.struct(
            F.col(position).alias("position"), F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("_turn"),
    )
    grouped = rows.groupBy(conversation).agg(F.sort_array(F.collect_list("_turn")).alias("_turns"))
    every = F.col("_turns")

    def pieces(turn: Column, i: Column) -> Column:
        """What one turn adds; a header only where the role changes, an end only where the next role differs."""
        opens = (i == 0) | (F.get(every, i - 1)["role"] != turn["role"])
        closes = (i == F.size(every) - 1) | (F.get(every, i + 1)["role"] != turn["role"])
        head = F.when(opens, F.concat(F.lit(START), _escape_role(turn["role"]), F.lit("\n"))).otherwise(F.lit(NEXT))

        def piece(value: Column, loss: Column) -> Column:
            return F.struct(value.alias("text"), loss.alias("loss"))

        return F.array(
            piece(head, F.lit(False)), piece(escape(turn["text"]), turn["role"] == learn),
            piece(F.when(closes, F.lit(END)).otherwise(F.lit("")), F.lit(False)),
        )

    segments = F.flatten(F.transform(every, pieces))
    return grouped.select(conversation, segments.alias("segments")).select(
        conversation, F.array_join(F.col("segments.text"), "").alias("formatted"), "segments"
    )


def read_turns(formatted: Column) -> Column:
    """The turns ``(role, text)`` in a formatted string, texts unescaped."""
    split = F.split(formatted, r"<\|im_start\|>")
    blocks = F.slice(split, F.lit(2), F.size(split) - 1)

    def turns(block: Column) -> Column:
        role = F.substring_index(block, "\n", 1)
        body = F.substr(block, F.length(role) + 2, F.length(block) - F.length(role) - 1 - len(END))
        return F.transform(
            F.split(body, r"<\|im_next\|>"),
            lambda t: F.struct(_unescape_role(role).alias("role"), unescape(t).alias("text")),
        )

    return F.flatten(F.transform(blocks, turns))


def learned_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order, with nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
