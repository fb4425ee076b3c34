"""Saving and loading tokenizers as tables."""

from __future__ import annotations

from dataclasses import fields

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from corpusmill.operators.tokenizer import Tokenizer

_TABLES = {"tokens", "merges", "specials"}


def save_tokenizer(
    spark: SparkSession, tok: Tokenizer, path: str, mode: str = "errorifexists"
) -> None:
    """Write vocabulary, merges and special tokens as Parquet and the settings as one JSON row.

    The tables are bounded by the vocabulary size.
    """
    tok.vocab_table(spark).coalesce(1).write.mode(mode).parquet(f"{path}/vocab")
    tok.merge_table(spark).coalesce(1).write.mode(mode).parquet(f"{path}/merges")
    specials = [(k, s, tok.ids[s]) for k, s in enumerate(tok.specials)]
    spark.createDataFrame(specials, "place int, token string, id int").coalesce(1).write.mode(
        mode
    ).parquet(f"{path}/special_tokens")
    names = [f.name for f in fields(tok) if f.name not in _TABLES]
    values = tuple(
        list(v) if isinstance(v, tuple) else v for v in (getattr(tok, n) for n in names)
    )
    spark.createDataFrame([values], names).coalesce(1).write.mode(mode).json(f"{path}/config")


def load_tokenizer(spark: SparkSession, path: str) -> Tokenizer:
    vocab = spark.read.parquet(f"{path}/vocab").orderBy("id").collect()
    merges = spark.read.parquet(f"{path}/merges").orderBy("rank").collect()
    specials = spark.read.parquet(f"{path}/special_tokens").orderBy("place").collect()
    config = spark.read.json(f"{path}/config").select(F.col("*")).first().asDict()
    return Tokenizer(
        tokens=tuple(r.token for r in vocab),
        merges=tuple((r.left, r.right) for r in merges),
        specials=tuple(r.token for r in specials),
        **{k: tuple(v) if isinstance(v, list) else v for k, v in config.items()},
    )
