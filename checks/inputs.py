"""Inputs derived from the given tables, over all of their rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.byte_symbols import SYMBOLS
from corpusmill.operators.ranks import rank_by_id
from corpusmill.operators.steps import spread
from corpusmill.operators.tokenizer import SPECIAL_TOKENS, Tokenizer
from corpusmill.operators.vocabulary import train_bpe, word_counts
from corpusmill.session import prepare_session, scratch_path

MERGES = 256
MAX_LENGTH = 512

_tokenizers: dict[tuple[str, str, int], Tokenizer] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare_session(spark)
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def tokenizer(spark: SparkSession, sf_dir: str, merges: int = MERGES) -> Tokenizer:
    """Trained on all documents, once per session."""
    key = spark.sparkContext.applicationId, sf_dir, merges
    if key not in _tokenizers:
        _tokenizers[key] = train_bpe(word_counts(documents(spark, sf_dir)), 261 + merges)
    return _tokenizers[key]


def byte_tokenizer() -> Tokenizer:
    """Special tokens and single bytes only."""
    return Tokenizer(tokens=(*SPECIAL_TOKENS, *sorted(SYMBOLS)), merges=())


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(line_no, lang, value)``: one JSON line per document, some broken in known ways."""
    record = F.to_json(F.struct("text"))
    shape = F.col("doc_id") % 20
    value = (
        F.when(shape == 0, "")
        .when(shape == 1, F.expr("left(record, length(record) - 1)"))
        .when(shape == 2, F.concat("record", F.lit(" x")))
        .when(shape == 3, F.to_json(F.struct(F.col("text").alias("title"))))
        .when(shape == 4, '{"text": 5}')
        .when(shape == 5, '{"text": null}')
        .when(shape == 6, '{"text": ""}')
        .when(shape == 7, '{"text": "   "}')
        .otherwise(F.col("record"))
    )
    numbered = rank_by_id(documents(spark, sf_dir), "doc_id", "line_no")
    return numbered.withColumn("record", record).select(
        (F.col("line_no") + 1).alias("line_no"), "lang", value.alias("value")
    )


def stored_texts(spark: SparkSession, sf_dir: str) -> str:
    """Path of a text corpus holding the documents in ``doc_id`` order."""
    path = scratch_path(spark, "texts")
    documents(spark, sf_dir).orderBy("doc_id").select("text").write.text(path)
    return path


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(conv_id, turns)`` in turn order, with ``role`` and ``content``."""
    turn = F.struct("turn", "role", F.col("text").alias("content"))
    grouped = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(
        F.sort_array(F.collect_list(turn)).alias("turns")
    )
    return grouped


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(conv_id, messages)`` with the roles of the table."""
    return turns(spark, sf_dir).select(
        "conv_id",
        F.transform("turns", lambda t: F.struct(t["role"], t["content"])).alias("messages"),
    )


def raw_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(conv_id, conversations)`` with ``from``/``value`` turns.

    Every conversation comes twice: whole, and under ``-1 - conv_id`` with its system turns
    only, which gives no chat record.
    """
    source = (
        lambda t: F.when(t["role"] == "user", "human")
        .when((t["role"] == "assistant") & (F.col("conv_id") % 2 == 0), "gpt")
        .otherwise(t["role"])
    )
    whole = turns(spark, sf_dir).select(
        "conv_id",
        F.transform(
            "turns", lambda t: F.struct(source(t).alias("from"), t["content"].alias("value"))
        ).alias("conversations"),
    )
    system_only = whole.select(
        (-1 - F.col("conv_id")).alias("conv_id"),
        F.filter("conversations", lambda t: t["from"] == "system").alias("conversations"),
    )
    return whole.unionByName(system_only)


def conversation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(conv_id, value)``: raw conversations as JSON lines."""
    return raw_conversations(spark, sf_dir).select(
        "conv_id", F.to_json(F.struct("conversations")).alias("value")
    )


def message_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(conv_id, value)``: ``{messages}`` for even and ``{conversation}`` for odd ids."""
    chat = messages(spark, sf_dir)
    return chat.select(
        "conv_id",
        F.when(F.col("conv_id") % 2 == 0, F.to_json(F.struct("messages")))
        .otherwise(F.to_json(F.struct(F.col("messages").alias("conversation"))))
        .alias("value"),
    )


def instruction_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(item_id, value)``: instruction records with missing, empty and present inputs."""
    item, text = F.col("item_id"), F.col("text")
    extra = F.when(item % 3 == 1, "").when(item % 3 == 2, F.reverse(text))
    return table(spark, sf_dir, "benchmark").select(
        "item_id",
        F.to_json(
            F.struct(
                text.alias("instruction"),
                extra.alias("input"),
                F.when(item % 5 != 0, F.concat(text, F.lit("!"))).alias("output"),
                F.when(item % 5 == 0, F.concat(text, F.lit("?"))).alias("response"),
            )
        ).alias("value"),
    )


def document_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_counts(documents(spark, sf_dir))
