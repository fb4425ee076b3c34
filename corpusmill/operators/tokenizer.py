"""A trained byte-level BPE tokenizer and its column expressions.

Encoding and decoding are column expressions: no shuffle, whatever the corpus size. What a
task needs — merges and token names — is bounded by the vocabulary size.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.byte_symbols import SYMBOLS, hex_to_text
from corpusmill.functions.chat import TURN_END, TURN_START
from corpusmill.functions.merging import WordMerger, array_encoder
from corpusmill.functions.text import normalize_parts, pretokenize, split_special

# Fixed values -------------------------------------------------------------
SPECIAL_TOKENS = ("<unk>", "<s>", "</s>", TURN_START, TURN_END)
MODEL_MAX_LENGTH = 8192
# --------------------------------------------------------------------------

@dataclass(frozen=True)
class Tokenizer:
    """Vocabulary, merges and settings.

    ``tokens`` lists every token by id: special tokens, the 256 byte symbols in code-point
    order, then the merged tokens. ``merges`` holds ``(left, right)`` token texts by rank.
    """

    tokens: tuple[str, ...]
    merges: tuple[tuple[str, str], ...]
    specials: tuple[str, ...] = SPECIAL_TOKENS
    unk_token: str = "<unk>"
    bos_token: str = TURN_START
    eos_token: str = TURN_END
    pad_token: str = TURN_END
    add_prefix_space: bool = False
    continuing_prefix: str = ""
    normalize: bool = True
    model_max_length: int = MODEL_MAX_LENGTH
    chat_roles: tuple[str, ...] = field(default=("system", "user", "assistant"))

    @cached_property
    def ids(self) -> dict[str, int]:
        return {token: i for i, token in enumerate(self.tokens)}

    def token_id(self, token: str) -> int:
        return self.ids.get(token, self.ids[self.unk_token])

    @property
    def vocab_size(self) -> int:
        return len(self.tokens)

    @property
    def pad_id(self) -> int:
        return self.ids[self.pad_token]

    @property
    def eos_id(self) -> int:
        return self.ids[self.eos_token]

    @property
    def unk_id(self) -> int:
        return self.ids[self.unk_token]

    @cached_property
    def pair_ranks(self) -> dict[tuple[int, int], tuple[int, int]]:
        ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (left, right) in enumerate(self.merges):
            joined = left + right[len(self.continuing_prefix):]
            ranks.setdefault((self.ids[left], self.ids[right]), (rank, self.ids[joined]))
        return ranks

    @cached_property
    def merger(self) -> WordMerger:
        """Ids of pre-tokens and special tokens."""
        return WordMerger(
            {token: self.ids[token] for token in self.specials},
            [self.token_id(s) for s in SYMBOLS],
            [self.token_id(self.continuing_prefix + s) for s in SYMBOLS],
            self.pair_ranks,
        )

    def encode_word(self, word: str) -> list[int]:
        """Ids of one pre-token, or of one special token."""
        return self.merger.encode([word])[0].as_py()

    # Column expressions ---------------------------------------------------

    def words(self, parts: Column, clean: Column) -> Column:
        """Special tokens and pre-tokens in order, from the parts before and after NFKC."""
        found = F.zip_with(
            parts,
            clean,
            lambda raw, part: F.when(raw.isin(*self.specials), F.array(raw)).otherwise(
                pretokenize(part, self.add_prefix_space)
            ),
        )
        return F.flatten(found)

    def ids_of(self, words: Column) -> Column:
        return F.arrow_udf(array_encoder(self.merger), "array<int>")(words)

    def decode(self, ids: Column, skip_special: bool = False) -> Column:
        """Text of the ids; unknown ids give nothing, broken UTF-8 gives U+FFFD."""
        byte_of = {s: b for b, s in enumerate(SYMBOLS)}

        def hex_of(token: str) -> str:
            if skip_special and token in self.specials:
                return ""
            if all(c in byte_of for c in token):
                return bytes(byte_of[c] for c in token).hex()
            return token.encode("utf-8").hex()

        # One literal, cut once when the plan is made.
        table = F.split(F.lit(",".join(map(hex_of, self.tokens))), ",", -1)
        pieces = F.transform(ids, lambda i: F.coalesce(F.get(table, i), F.lit("")))
        return hex_to_text(F.array_join(pieces, ""))

    # Tables ---------------------------------------------------------------

    def vocab_table(self, spark: SparkSession) -> DataFrame:
        rows = [(t, i, t in self.specials) for i, t in enumerate(self.tokens)]
        return spark.createDataFrame(rows, "token string, id int, special boolean")

    def merge_table(self, spark: SparkSession) -> DataFrame:
        rows = [(k, left, right) for k, (left, right) in enumerate(self.merges)]
        return spark.createDataFrame(rows, "rank int, left string, right string")


def encode(df: DataFrame, tok: Tokenizer, col: str = "text", out: str = "ids") -> DataFrame:
    """Add ``array<int>`` of token ids; nothing is added in front or behind.

    The steps are separate columns because each is read more than once by the next.
    """
    parts = df.withColumn("_parts", split_special(F.col(col), tok.specials))
    clean = parts.withColumn(
        "_clean", normalize_parts(F.col("_parts")) if tok.normalize else F.col("_parts")
    )
    words = tok.words(F.col("_parts"), F.col("_clean"))
    return clean.withColumn(out, tok.ids_of(words)).drop("_parts", "_clean")


def decode(
    df: DataFrame,
    tok: Tokenizer,
    col: str = "ids",
    out: str = "decoded",
    skip_special: bool = False,
) -> DataFrame:
    return df.withColumn(out, tok.decode(F.col(col), skip_special))


def token_to_id(
    df: DataFrame, tok: Tokenizer, col: str = "token", out: str = "id"
) -> DataFrame:
    """Id of each token name; the unknown id for names not in the vocabulary."""
    vocab = tok.vocab_table(df.sparkSession).select(
        F.col("token").alias("_token"), F.col("id").alias("_id")
    )
    return (
        df.join(F.broadcast(vocab), F.col(col) == F.col("_token"), "left")
        .withColumn(out, F.coalesce("_id", F.lit(tok.unk_id)))
        .drop("_token", "_id")
    )
