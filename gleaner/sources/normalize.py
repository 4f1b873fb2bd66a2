"""Bring source rows to the canonical ``messages`` array."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MESSAGE = T.StructType(
    [T.StructField("role", T.StringType()), T.StructField("content", T.StringType())]
)
MESSAGES = T.ArrayType(MESSAGE)


def _is_message_list(kind: T.DataType) -> bool:
    if not isinstance(kind, T.ArrayType) or not isinstance(kind.elementType, T.StructType):
        return False
    return {"role", "content"} <= set(kind.elementType.names)


def detect_format(schema: T.StructType) -> str:
    """``messages`` or ``alpaca``; a message list wins when both are there."""
    names = set(schema.names)
    if "messages" in names and _is_message_list(schema["messages"].dataType):
        return "messages"
    if "instruction" in names and names & {"output", "response"}:
        return "alpaca"
    raise ValueError(
        "unsupported dataset: need a 'messages' list of role/content, "
        "or 'instruction' with 'output' or 'response'"
    )


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.cast("string").alias("content"))


def alpaca_messages(instruction: Column, extra: Column | None, answer: Column) -> Column:
    """A user message (with the extra input on its own line, if any) and the answer to it."""
    question = instruction
    if extra is not None:
        question = F.when(F.length(extra) > 0, F.concat(instruction, F.lit("\n"), extra)).otherwise(
            instruction
        )
    return F.array(message("user", question), message("assistant", answer))


def canonical_messages(messages: Column) -> Column:
    return F.transform(
        messages,
        lambda m: F.struct(
            m["role"].cast("string").alias("role"), m["content"].cast("string").alias("content")
        ),
    )


def to_messages(df: DataFrame, id_col: str | None = None) -> DataFrame:
    """Detect the layout from the columns and convert.

    Conversations keep their other columns. Instruction rows keep only the messages, and the id
    column if one is named.
    """
    if detect_format(df.schema) == "messages":
        return df.withColumn("messages", canonical_messages(F.col("messages")))
    answer = "output" if "output" in df.columns else "response"
    extra = F.col("input") if "input" in df.columns else None
    built = alpaca_messages(F.col("instruction"), extra, F.col(answer)).alias("messages")
    return df.select(*([id_col] if id_col else []), built)


def _gather(turn: str, role: str, text: str) -> Column:
    rows = F.collect_list(
        F.struct(
            F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("content")
        )
    )
    return F.transform(
        F.array_sort(rows),
        lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")),
    )


def assemble_turns(
    turns: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Flat turn rows to ``messages``, one row per conversation whatever its turn numbers are.

    A conversation is one row, so its turns meet in one task. ``curate_turns`` judges conversations
    first and assembles only those that pass, which the filter keeps short.
    """
    return turns.groupBy(id_col).agg(_gather(turn_col, role_col, text_col).alias("messages"))
