"""Chat-format examples for the two tasks, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.split import stratified_split
from tidemark.sources.sinks import write_jsonl

# The prompt contract of each task, the same in training, scoring and serving.
PROMPTS = {
    "classify": {
        "system": "You are a financial sentiment classifier.",
        "instruction": (
            "Classify the financial sentiment of the following statement as exactly one "
            "of bullish, bearish, or neutral.\n\nStatement: "
        ),
    },
    "summarize": {
        "system": "You are an earnings-call summarizer.",
        "instruction": "Summarize the following earnings call as concise bullet points.\n\nTranscript: ",
    },
}


def turn(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def messages(text: Column, task: str, answer: Column | None = None) -> Column:
    """System and user turn, and the assistant turn when there is an answer."""
    prompt = PROMPTS[task]
    turns = [
        turn("system", F.lit(prompt["system"])),
        turn("user", F.concat(F.lit(prompt["instruction"]), text)),
    ]
    return F.array(*turns, *([turn("assistant", answer)] if answer is not None else []))


def prompt_text(chat: Column, task: str) -> Column:
    """The bare text the last user turn asks about; the instruction is stripped where it is there."""
    instruction = PROMPTS[task]["instruction"]
    users = F.filter(chat, lambda m: m["role"] == "user")
    content = F.element_at(users, -1)["content"]
    return F.when(
        content.startswith(instruction), F.substr(content, F.lit(len(instruction) + 1))
    ).otherwise(content)


def gold_answer(chat: Column) -> Column:
    return F.element_at(chat, -1)["content"]


def write_examples(df: DataFrame, path: str, key: str, text: str, label: str, task: str = "classify") -> None:
    """Splits the rows, formats them and writes JSON lines, one folder per split."""
    split = stratified_split(df, key, label)
    write_jsonl(split.select("split", messages(F.col(text), task, F.col(label)).alias("messages")), path, "split")


def conversations(turns: DataFrame, conversation: str, position: str, role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: all its turns in order as ``messages``, and their number.

    A conversation is one example, so its turns come together in one row; turns of equal position stand in the order of
    role and text. Turns without a conversation belong to none.
    """
    turn_ = F.struct(F.col(position).alias("at"), F.col(role).alias("role"), F.col(text).alias("content"))
    grouped = turns.where(F.col(conversation).isNotNull()).groupBy(conversation).agg(
        F.array_sort(F.collect_list(turn_)).alias("_turns")
    )
    chat = F.transform("_turns", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))
    return grouped.select(conversation, chat.alias("messages"), F.size("_turns").cast("bigint").alias("n_turns"))


def reply_examples(turns: DataFrame, conversation: str, position: str) -> DataFrame:
    """One example per assistant turn: the turn before it and the reply.

    Turns meet on (conversation, position), so a long conversation needs no group of its own.
    """
    before = turns.select(
        conversation, (F.col(position) + 1).alias(position), F.col("role").alias("_role"), F.col("text").alias("_text")
    )
    pairs = turns.where("role = 'assistant'").join(before, [conversation, position])
    chat = F.array(
        F.struct(F.col("_role").alias("role"), F.col("_text").alias("content")), turn("assistant", F.col("text"))
    )
    return pairs.select(conversation, position, chat.alias("messages"))
