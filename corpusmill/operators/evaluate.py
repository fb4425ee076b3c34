"""Tokenizer quality: coverage, round trips, special tokens, chat frames, unknown words."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.chat import render_chat
from corpusmill.functions.text import strip
from corpusmill.operators.tokenizer import Tokenizer, decode, encode, token_to_id

# Fixed values -------------------------------------------------------------
LISTED_SPECIALS = (
    "<unk>", "<s>", "</s>", "<|im_start|>", "<|im_end|>", "[PAD]", "[CLS]", "[SEP]", "[MASK]",
)
CHAT_CHECK_LENGTH = 256
# --------------------------------------------------------------------------


def _share(flag: Column) -> Column:
    return F.avg(F.when(flag, 1.0).otherwise(0.0))


def _sized(df: DataFrame, tok: Tokenizer, col: str) -> DataFrame:
    n = F.col("tokens")
    return (
        encode(df, tok, col, "_ids")
        .withColumn("tokens", F.size("_ids"))
        .withColumn("chars", F.length(col))
        .withColumn("chars_per_token", F.col("chars") / F.greatest(n, F.lit(1)))
        .withColumn("token_class", F.when(n == 1, "1").when(n <= 3, "2-3").otherwise(">3"))
    )


def coverage(df: DataFrame, tok: Tokenizer, col: str = "word") -> DataFrame:
    """Tokens, characters, characters per token, and class (1, 2-3, more) of each word."""
    return _sized(df, tok, col).drop("_ids")


def coverage_summary(
    df: DataFrame, tok: Tokenizer, col: str = "word", by: list[str] | None = None
) -> DataFrame:
    """Words, tokens, characters and overall characters per token, per group."""
    return (
        coverage(df, tok, col)
        .groupBy(*(by or []))
        .agg(
            F.count(F.lit(1)).alias("words"),
            F.sum("tokens").alias("tokens"),
            F.sum("chars").alias("chars"),
        )
        .withColumn("chars_per_token", F.col("chars") / F.nullif(F.col("tokens"), F.lit(0)))
    )


def _round_trips(df: DataFrame, tok: Tokenizer, col: str) -> DataFrame:
    coded = encode(df, tok, col, "_ids")
    same = strip(tok.decode(F.col("_ids"), skip_special=True)) == strip(F.col(col))
    return coded.withColumn("same", F.coalesce(same, F.lit(False)))


def round_trip(
    df: DataFrame, tok: Tokenizer, col: str = "text", by: list[str] | None = None
) -> DataFrame:
    """Share of texts that encode and decode to themselves, apart from outer whitespace."""
    return (
        _round_trips(df, tok, col)
        .groupBy(*(by or []))
        .agg(
            F.count(F.lit(1)).alias("texts"),
            F.sum(F.size("_ids")).alias("tokens"),
            _share(F.col("same")).alias("round_trip"),
        )
    )


def special_retention(df: DataFrame, tok: Tokenizer, col: str = "text") -> DataFrame:
    """Special tokens of each text (``present``) and those still there after decoding (``kept``)."""
    coded = decode(encode(df, tok, col, "_ids"), tok, "_ids", "_back")
    names = F.array(*[F.lit(s) for s in tok.specials])
    present = F.filter(names, lambda s: F.contains(F.col(col), s))
    return (
        coded.withColumn("present", present)
        .withColumn("kept", F.filter("present", lambda s: F.contains(F.col("_back"), s)))
        .withColumn("tokens", F.size("_ids"))
        .drop("_ids", "_back")
    )


def chat_check(
    df: DataFrame,
    tok: Tokenizer,
    messages: str = "messages",
    max_length: int = CHAT_CHECK_LENGTH,
) -> DataFrame:
    """Frame a chat for an answer, cut it to ``max_length`` tokens and look for both frame tokens."""
    prompted = df.withColumn("_prompt", render_chat(F.col(messages), add_generation_prompt=True))
    ids = encode(prompted, tok, "_prompt", "_all").withColumn(
        "_ids", F.slice("_all", 1, max_length)
    )
    back = decode(ids, tok, "_ids", "_back")
    return (
        back.withColumn("tokens", F.size("_ids"))
        .withColumn(
            "frames_kept",
            F.contains("_back", F.lit(tok.bos_token)) & F.contains("_back", F.lit(tok.eos_token)),
        )
        .drop("_prompt", "_all", "_ids", "_back")
    )


def oov_rate(
    df: DataFrame, tok: Tokenizer, col: str = "word", by: list[str] | None = None
) -> DataFrame:
    """Share of words whose ids hold the unknown id."""
    return (
        encode(df, tok, col, "_ids")
        .groupBy(*(by or []))
        .agg(
            F.count(F.lit(1)).alias("words"),
            _share(F.array_contains("_ids", tok.unk_id)).alias("oov"),
        )
    )


def special_ids(spark: SparkSession, tok: Tokenizer) -> DataFrame:
    """Listed special tokens that have an id of their own: ``(token, id)``."""
    listed = spark.createDataFrame([(s,) for s in LISTED_SPECIALS], "token string")
    return token_to_id(listed, tok).filter(F.col("id") != tok.unk_id)


def _metrics(df: DataFrame, per_group: list[str], in_all: list[str]) -> DataFrame:
    """``(metric, group, value)`` from a rollup by ``_group``: its groups and its total."""

    def named(metrics: list[str]) -> Column:
        pairs = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
        return F.array(*pairs)

    group = F.when(F.col("_total"), F.lit("all")).otherwise(F.col("_group")).alias("group")
    chosen = F.when(F.col("_total"), named(in_all)).otherwise(named(per_group))
    return df.select(group, F.inline(chosen)).select("metric", "group", "value")


def tokenizer_report(
    texts: DataFrame,
    chats: DataFrame,
    words: DataFrame,
    tok: Tokenizer,
    by: str | None = None,
) -> DataFrame:
    """Every check as rows ``(metric, group, value)``.

    ``texts`` holds ``text``, ``chats`` holds ``messages``, ``words`` holds ``word``; ``by`` is
    an optional grouping column of ``texts``. Each input is encoded once: groups and totals come
    from one rollup.
    """
    spark = texts.sparkSession
    is_total = (F.grouping_id() > 0).alias("_total")

    group = F.coalesce(F.col(by).cast("string"), F.lit("")) if by else F.lit("all")
    names = F.array(*[F.lit(s) for s in tok.specials])
    present = F.filter(names, lambda s: F.contains(F.col("text"), s))
    back = decode(_round_trips(texts.select(group.alias("_group"), "text"), tok, "text"), tok, "_ids", "_back")
    of_texts = (
        back.withColumn("_present", present)
        .withColumn("_kept", F.filter("_present", lambda s: F.contains(F.col("_back"), s)))
        .rollup("_group")
        .agg(
            is_total,
            F.count(F.lit(1)).alias("texts"),
            F.sum(F.size("_ids")).alias("tokens"),
            _share(F.col("same")).alias("round_trip"),
            F.sum(F.size("_present")).alias("specials_present"),
            F.sum(F.size("_kept")).alias("specials_kept"),
        )
    )
    of_chats = chat_check(chats, tok).agg(
        F.lit(True).alias("_total"),
        F.lit("all").alias("_group"),
        F.sum("tokens").alias("chat_tokens"),
        _share(F.col("frames_kept")).alias("chat_frames_kept"),
    )
    unknown = F.array_contains("_ids", tok.unk_id)
    of_words = (
        _sized(words, tok, "word")
        .rollup(F.col("token_class").alias("_group"))
        .agg(
            is_total,
            F.count(F.lit(1)).alias("words"),
            F.sum("tokens").alias("word_tokens"),
            F.sum("chars").alias("word_chars"),
            _share(unknown).alias("oov"),
        )
        .withColumn("words_by_class", F.col("words"))
        .withColumn("chars_per_token", F.col("word_chars") / F.nullif(F.col("word_tokens"), F.lit(0)))
    )
    counts = ["specials_present", "specials_kept", "words"]
    shares = ["chat_tokens", "chat_frames_kept", "word_tokens", "word_chars", "chars_per_token", "oov"]
    # An empty input has no total; its counts are 0 and its shares null.
    fixed = [("vocab_size", "all", float(tok.vocab_size)), *[(m, "all", 0.0) for m in counts]]
    fixed += [(m, "all", None) for m in shares]
    ids = special_ids(spark, tok).select(F.lit("special_id"), "token", F.col("id").cast("double"))
    parts = [
        spark.createDataFrame(fixed, "metric string, group string, value double"),
        ids,
        _metrics(of_texts, ["texts", "tokens", "round_trip"], ["specials_present", "specials_kept"]),
        _metrics(of_chats, [], ["chat_tokens", "chat_frames_kept"]),
        _metrics(of_words, ["words_by_class"], ["word_tokens", "word_chars", "chars_per_token", "words", "oov"]),
    ]
    return reduce(DataFrame.union, parts).groupBy("metric", "group").agg(F.max("value").alias("value"))
