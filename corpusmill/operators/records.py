"""Raw lines to text records, chunks, and chat records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.chat import SYSTEM_PROMPT, chat_messages, render_any, render_chat
from corpusmill.functions.strict_json import (
    beyond_limits,
    kind,
    large_string,
    member,
    parse_line,
    string_member,
)
from corpusmill.functions.text import CHUNK_SIZE, chunks, nonblank, strip
from corpusmill.operators.steps import once

# Watches a table by the column that says what became of each row, and gives it back.
Observe = Callable[[DataFrame, str], DataFrame]


def parse_json_strict(
    df: DataFrame, col: str = "value", out: str = "v", keep_malformed: bool = False
) -> DataFrame:
    """Parse one JSON value per row; malformed rows are dropped, or kept with a null value."""
    parsed = once(df, out, parse_line(F.col(col)))
    return parsed if keep_malformed else parsed.filter(F.col(out).isNotNull())


def text_of(record: Column) -> Column:
    """The ``text`` string of a record, null when it is missing, empty or no string."""
    text = string_member(record, "text")
    return F.when(text != "", text)


def record_text(value: Column, v: Column) -> Column:
    """The ``text`` of a raw line and its parsed record, which is null for a very large one."""
    large = large_string(strip(value), "text")
    return F.coalesce(text_of(v), F.when(v.isNull() & (large != ""), large))


def extract_text(df: DataFrame, v: str = "v", out: str = "text") -> DataFrame:
    return once(df, out, text_of(F.col(v))).filter(F.col(out).isNotNull())


def line_reason(value: Column, v: Column) -> Column:
    """Why a raw line gives no training text; ``kept`` when it does."""
    text_kind = kind(member(v, "text"))
    return (
        F.when(~nonblank(value), "blank_line")
        .when(v.isNull() & nonblank(record_text(value, v)), "kept")
        .when(v.isNull(), F.coalesce(beyond_limits(value), F.lit("malformed")))
        .when(kind(v) != "OBJECT", "not_object")
        .when(member(v, "text").isNull(), "missing_text")
        .when(text_kind == "VOID", "empty_text")
        .when(text_kind != "STRING", "non_string")
        .when(text_of(v).isNull(), "empty_text")
        .when(~nonblank(text_of(v)), "blank_text")
        .otherwise("kept")
    )


# Why a record gives nothing, in the order the reasons are looked at.
REASONS = (
    "kept", "blank_line", "malformed", "too_large", "too_deep", "not_object", "missing_text", "empty_text",
    "non_string", "blank_text", "no_turns",
)


def chat_reason(value: Column | None, v: Column, messages: Column) -> Column:
    """Why a raw line, or with no ``value`` an array element, gives no chat record."""
    usable = F.when(messages.isNotNull(), "kept").when(kind(v) != "OBJECT", "not_object").otherwise("no_turns")
    if value is None:
        return usable
    return (
        F.when(~nonblank(value), "blank_line")
        .when(v.isNull(), F.coalesce(beyond_limits(value), F.lit("malformed")))
        .otherwise(usable)
    )


def prepared_counts(reason: Column) -> list[Column]:
    """Aggregates that count records by reason, for an observation or an aggregation."""
    counts = [F.count_if(reason == r).alias(r) for r in REASONS]
    return [F.count(F.lit(1)).alias("read"), *counts]


def valid_texts(lines: DataFrame, value: str = "value", out: str = "text") -> DataFrame:
    """Rows whose text is a non-blank string: the tokenizer's training input."""
    return line_texts(lines, value, out).filter(nonblank(F.col(out)))


def line_texts(lines: DataFrame, value: str = "value", out: str = "text", observe: Observe | None = None) -> DataFrame:
    """Rows with the record ``v`` and its non-empty text, of whatever length."""
    parsed = parse_json_strict(lines, value, keep_malformed=True)
    texts = once(parsed, out, record_text(F.col(value), F.col("v")))
    if observe:
        texts = observe(once(texts, "_reason", line_reason(F.col(value), F.col("v"))), "_reason").drop("_reason")
    return texts.filter(F.col(out).isNotNull())


def chunk_text(
    df: DataFrame, size: int = CHUNK_SIZE, col: str = "text", out: str = "text"
) -> DataFrame:
    """One row per chunk with ``chunk_idx``; whitespace-only chunks leave a gap in it."""
    others = [c for c in df.columns if c not in (col, out)]
    pieces = F.posexplode_outer(chunks(F.col(col), size)).alias("chunk_idx", out)
    return df.select(*others, pieces).filter(nonblank(F.col(out)))


def to_chat(
    df: DataFrame,
    v: str = "v",
    out: str = "messages",
    prompt: str = SYSTEM_PROMPT,
    observe: Observe | None = None,
    value: str | None = None,
) -> DataFrame:
    """Raw conversation records to chat records; rows without a usable turn are dropped.

    ``value`` names the raw line of a record that may be malformed.
    """
    chats = once(df, out, chat_messages(F.col(v), prompt))
    if observe:
        reason = chat_reason(F.col(value) if value else None, F.col(v), F.col(out))
        chats = observe(once(chats, "_reason", reason), "_reason").drop("_reason")
    return chats.filter(F.col(out).isNotNull())


def render_records(df: DataFrame, value: str = "value", out: str = "rendered") -> DataFrame:
    """Framed text of each supervised JSON line, whatever its shape; malformed rows drop out."""
    parsed = parse_json_strict(df, value, "_v")
    return parsed.withColumn(out, render_any(F.col("_v"), strip(F.col(value)))).drop("_v")


def prepare_lines(lines: DataFrame, kind: str, observe: Observe | None = None) -> DataFrame:
    """The same steps for a batch or a stream of raw lines with a ``value`` column.

    ``pretrain`` gives ``(chunk_idx, text)``, ``chat`` gives ``(messages, rendered)``. With
    ``observe`` the lines are counted by what became of them, on their way.
    """
    if kind == "pretrain":
        return chunk_text(line_texts(lines, observe=observe).select("text"))
    if kind == "chat":
        parsed = parse_json_strict(lines, keep_malformed=observe is not None)
        chats = to_chat(parsed, observe=observe, value="value").select("messages")
        return chats.withColumn("rendered", render_chat(F.col("messages")))
    raise ValueError(f"unknown kind {kind!r}")
