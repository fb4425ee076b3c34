"""Fixed-length training samples from text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.chat import TURN_START, with_bos
from corpusmill.functions.samples import (
    assistant_mask,
    length_mask,
    pad_value_mask,
    shift_xy,
    truncate_pad,
)
from corpusmill.operators.tokenizer import Tokenizer, encode

# Fixed values -------------------------------------------------------------
MAX_LENGTH = 512
PRETRAIN_PAD_ID = 0
ANSWER_HEADER = ("assistant", "\n")
# --------------------------------------------------------------------------


def answer_header_ids(tok: Tokenizer) -> list[int]:
    """Ids of the frame that opens an assistant turn, under this vocabulary."""
    role, newline = ANSWER_HEADER
    if tok.add_prefix_space:
        role = " " + role
    return [tok.token_id(TURN_START), *tok.encode_word(role), *tok.encode_word(newline)]


def _shifted(df: DataFrame, padded: str, mask: str) -> DataFrame:
    sample = shift_xy(F.col(padded), F.col(mask))
    return df.withColumn("_s", sample).select(
        *[c for c in df.columns if c not in (padded, mask)], "_s.x", "_s.y", "_s.mask"
    )


def pretrain_samples(
    df: DataFrame, tok: Tokenizer, max_length: int = MAX_LENGTH, col: str = "text"
) -> DataFrame:
    """``x``, ``y``, ``mask`` of each text: start token, cut or zero-padded, shifted by one."""
    begun = df.withColumn("_text", with_bos(F.col(col), tok.bos_token))
    ids = encode(begun, tok, "_text", "_ids").drop(col, "_text")
    padded = ids.select(
        "*",
        truncate_pad(F.col("_ids"), max_length, PRETRAIN_PAD_ID).alias("_padded"),
        length_mask(F.col("_ids"), max_length).alias("_mask"),
    ).drop("_ids")
    return _shifted(padded, "_padded", "_mask")


def sft_samples(
    df: DataFrame,
    tok: Tokenizer,
    max_length: int = MAX_LENGTH,
    mask: str = "pad_value",
    col: str = "rendered",
) -> DataFrame:
    """Samples of framed chat text.

    ``pad_value`` leaves out every position holding the padding id, which is also the end
    token; ``assistant`` supervises the assistant turns with their end token.
    """
    ids = encode(df, tok, col, "_ids").drop(col)
    padded = ids.withColumn("_padded", truncate_pad(F.col("_ids"), max_length, tok.pad_id))
    if mask == "pad_value":
        bits = pad_value_mask(F.col("_padded"), tok.pad_id)
    elif mask == "assistant":
        bits = assistant_mask(F.col("_padded"), answer_header_ids(tok), tok.eos_id)
    else:
        raise ValueError(f"unknown mask {mask!r}")
    return _shifted(padded.drop("_ids").withColumn("_mask", bits), "_padded", "_mask")


def supervised_tokens(
    samples: DataFrame, by: list[str] | None = None, mask: str = "mask"
) -> DataFrame:
    """Number of positions that count in the loss, per sample or per group."""
    ones = F.aggregate(mask, F.lit(0).cast("bigint"), lambda total, bit: total + bit)
    if by is None:
        return samples.withColumn("supervised", ones)
    return samples.groupBy(*by).agg(F.sum(ones).alias("supervised"))
