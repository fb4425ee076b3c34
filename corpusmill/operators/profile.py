"""Counts and profiles of raw corpora."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.strict_json import parse_line
from corpusmill.operators.ranks import take_lines
from corpusmill.operators.records import line_reason, record_text
from corpusmill.operators.steps import once


def count_lines(lines: DataFrame) -> DataFrame:
    return lines.agg(F.count(F.lit(1)).alias("lines"))


def count_samples(samples: DataFrame, by: list[str] | None = None) -> DataFrame:
    return samples.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("samples"))


def profile_texts(df: DataFrame, by: list[str] | None = None, text: str = "text") -> DataFrame:
    """Lines seen, rows with text, characters, and whole-number mean length."""
    filled = F.col(text) != ""
    return (
        df.groupBy(*(by or []))
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.count_if(filled).alias("rows"),
            F.coalesce(F.sum(F.when(filled, F.length(text))), F.lit(0)).alias("chars"),
        )
        .withColumn("mean_chars", F.expr("chars div greatest(rows, 1)"))
    )


def corpus_profile(
    lines: DataFrame,
    first_n: int | None = 10_000,
    by: list[str] | None = None,
    value: str = "value",
) -> DataFrame:
    """Profile of the first raw lines of a numbered corpus (all of them with ``None``)."""
    head = take_lines(lines, first_n)
    parsed = once(once(head, "_v", parse_line(F.col(value))), "text", record_text(F.col(value), F.col("_v")))
    return profile_texts(parsed, by)


def scan_report(lines: DataFrame, value: str = "value") -> DataFrame:
    """Raw lines by the reason they are lost, with ``kept`` for the rest."""
    parsed = once(lines.select(value), "v", parse_line(F.col(value)))
    return (
        parsed.select(line_reason(F.col(value), F.col("v")).alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("lines"))
    )
