"""Blank tests, chunking, normalisation, special-token splitting and pre-tokenisation."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values -------------------------------------------------------------
CHUNK_SIZE = 512
# Python's str.strip() set: Unicode White_Space plus the four separators U+001C..U+001F.
SPACE_CLASS = r"\s\x1c-\x1f"
# Byte-level pre-token pattern as published by Radford et al. (2019).
WORD_PATTERN = (
    r"'(?:s|t|re|ve|m|ll|d)| ?+\p{L}++| ?+\p{N}++| ?+[^\s\p{L}\p{N}]++|\s+(?!\S)|\s+"
)
# Blocks whose characters NFKC leaves alone and which never combine with a neighbour:
# Latin letters, dashes and quotes, CJK punctuation, kana, CJK ideographs, Hangul (and ASCII).
NFKC_STABLE = (
    r"À-ıĴ-ľŁ-ňŊ-ž"
    r"‐‒-―‘-‟、。〈-】"
    r"ぁ-ゖァ-ヺ一-鿿가-힣"
)
# --------------------------------------------------------------------------

# Texts of a batch that are normalised at a time.
NFKC_PARTS = 256


def nonblank(col: Column) -> Column:
    """True when the text holds a character that is not whitespace; null counts as blank."""
    return F.coalesce(F.rlike(col, F.lit(f"(?U)[^{SPACE_CLASS}]")), F.lit(False))


def strip(col: Column) -> Column:
    """Cut whitespace at both ends. The regex runs only when an end is not printable ASCII."""
    first, last = F.substring(col, 1, 1), F.substring(col, -1, 1)
    clean = first.between("!", "~") & last.between("!", "~")
    ends = f"(?U)\\A[{SPACE_CLASS}]++|(?<![{SPACE_CLASS}])[{SPACE_CLASS}]++\\z"
    # The look-behind keeps an inner whitespace run from being tried at each of its characters.
    return F.when(clean, col).otherwise(F.regexp_replace(col, ends, ""))


def chunks(col: Column, size: int = CHUNK_SIZE) -> Column:
    """Consecutive pieces of at most ``size`` code points, found in one pass over the text."""
    return F.regexp_extract_all(col, F.lit("(?s).{1,%d}" % size), F.lit(0))


def _nfkc_parts(parts: pa.Array) -> pa.Array:
    lengths = pc.fill_null(pc.list_value_length(parts), 0)
    ends = pc.cumulative_sum(lengths)
    offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends.cast(pa.int32())])
    flat, values = parts.flatten(), [pa.array([], pa.string())]
    for start in range(0, len(flat), NFKC_PARTS):
        piece = flat.slice(start, NFKC_PARTS).to_pylist()
        values.append(pa.array([unicodedata.normalize("NFKC", part) for part in piece], pa.string()))
    return pa.ListArray.from_arrays(offsets, pa.concat_arrays(values), mask=parts.is_null())


def _unstable(col: Column) -> Column:
    """True when NFKC may change the text: a non-ASCII character outside the stable blocks."""
    other = F.octet_length(col) != F.length(col)
    return other & F.rlike(col, F.lit(f"[^\\x00-\\x7f](?<![{NFKC_STABLE}])"))


def normalize_parts(parts: Column) -> Column:
    """NFKC for every string of an array. Rows that cannot change skip the Arrow function."""
    nfkc = F.arrow_udf(_nfkc_parts, "array<string>")
    return F.coalesce(nfkc(F.when(F.exists(parts, _unstable), parts)), parts)


def normalize_nfkc(col: Column) -> Column:
    nfkc = F.arrow_udf(_nfkc_parts, "array<string>")
    return F.coalesce(F.get(nfkc(F.when(_unstable(col), F.array(col))), F.lit(0)), col)


def split_special(col: Column, specials: Sequence[str]) -> Column:
    """Cut the text before and after every special token; pieces keep their order."""
    longest_first = sorted(specials, key=len, reverse=True)
    literal = "|".join(re.escape(s) for s in longest_first)
    # One-character tests first: the whole alternation is tried at few positions.
    first = "".join(sorted({re.escape(s[0]) for s in specials}))
    last = "".join(sorted({re.escape(s[-1]) for s in specials}))
    pieces = F.split(col, f"(?=[{first}])(?={literal})|(?<=[{last}])(?<={literal})", -1)
    found = F.rlike(col, F.lit(f"(?=[{first}])(?:{literal})"))
    return F.when(found, F.filter(pieces, lambda p: p != "")).when(
        col == "", F.array().cast("array<string>")
    ).otherwise(F.array(col))


def flag_special(parts: Column, specials: Sequence[str]) -> Column:
    """``array<struct<part, special>>`` for the pieces of :func:`split_special`."""
    return F.transform(
        parts, lambda p: F.struct(p.alias("part"), p.isin(*specials).alias("special"))
    )


def pretokenize(col: Column, add_prefix_space: bool = False) -> Column:
    """Byte-level pre-tokens: letters, digits, symbols and spaces; one space joins its word."""
    if add_prefix_space:
        col = F.when(F.startswith(col, F.lit(" ")) | (col == ""), col).otherwise(
            F.concat(F.lit(" "), col)
        )
    return F.regexp_extract_all(col, F.lit("(?U)" + WORD_PATTERN), F.lit(0))
