"""Corpus to saved tokenizer."""

from __future__ import annotations

from pyspark.sql import SparkSession

from corpusmill.operators.ranks import take_lines
from corpusmill.operators.records import valid_texts
from corpusmill.operators.tokenizer import Tokenizer
from corpusmill.operators.vocabulary import VOCAB_SIZE, train_bpe, word_counts
from corpusmill.session import prepare_session
from corpusmill.sources.lines import number_lines, read_lines
from corpusmill.sources.tokenizer_store import save_tokenizer


def train_tokenizer(
    spark: SparkSession,
    src: str,
    save_dir: str | None = None,
    vocab_size: int = VOCAB_SIZE,
    max_lines: int | None = None,
    test_mode: bool = False,
    add_prefix_space: bool = False,
    continuing_prefix: str = "",
) -> Tokenizer:
    """Train on the valid texts of a JSON-lines corpus and save the result.

    Lines are numbered only when a limit asks for it.
    """
    prepare_session(spark)
    lines = read_lines(spark, src)
    if max_lines or test_mode:
        lines = take_lines(number_lines(lines), max_lines, test_mode)
    words = word_counts(valid_texts(lines), add_prefix_space=add_prefix_space)
    tok = train_bpe(
        words,
        vocab_size,
        continuing_prefix=continuing_prefix,
        add_prefix_space=add_prefix_space,
    )
    if save_dir:
        save_tokenizer(spark, tok, save_dir)
    return tok
