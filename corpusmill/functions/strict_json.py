"""Strict JSON: one value per text, nothing after it.

Strings and numbers may have any length. Two limits stay: a VARIANT holds at most 128 MiB, and
values nested deeper than 1,000 are refused, since the parser's recursion would end the
executor. Texts beyond them are told apart from malformed ones by :func:`beyond_limits`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions.text import strip


# Limits of the VARIANT type and of the parser's nesting.
VARIANT_BYTES = 128 << 20
MAX_DEPTH = 1000

OPTIONS = {
    "maxStringLen": str((1 << 31) - 1),
    "maxNumLen": str((1 << 31) - 1),
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}


def _listed(col: Column) -> Column:
    return F.concat(F.lit("["), col, F.lit("]"))


def parse_strict(col: Column) -> Column:
    """VARIANT of the single JSON value in the text, null when malformed.

    The parser ignores trailing text. Wrapping the text in an array shows trailing text,
    trailing commas and several values; wrapping it in an object shows ``… ] [``.
    """
    items = F.from_json(_listed(col), "array<variant>", OPTIONS)
    wrapped = F.from_json(F.concat(F.lit('{"v":'), col, F.lit("}")), "variant", OPTIONS)
    single = (F.size(items) == 1) & wrapped.isNotNull()
    return F.when(F.coalesce(single, F.lit(False)), F.get(items, F.lit(0)))


def large_string(col: Column, key: str) -> Column:
    """Text under a key of a record that is too large for a VARIANT; null for smaller ones."""
    rows = F.from_json(_listed(col), f"array<struct<`{key}`:string>>", OPTIONS)
    found = F.when(F.size(rows) == 1, F.get(rows, F.lit(0))[key])
    return F.when(F.octet_length(col) > VARIANT_BYTES // 2, found)


def beyond_limits(col: Column) -> Column:
    """For a text that gives no VARIANT: ``too_large``, ``too_deep``, or null if malformed."""
    opened = F.length(col) - F.length(F.translate(col, "[{", ""))
    return F.when(F.octet_length(col) > VARIANT_BYTES // 2, "too_large").when(
        opened >= MAX_DEPTH, "too_deep"
    )


def parse_line(col: Column) -> Column:
    return parse_strict(strip(col))


def kind(v: Column) -> Column:
    """Type name of a VARIANT: OBJECT, ARRAY, STRING, BIGINT, …, or null."""
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def member(v: Column, key: str) -> Column:
    """VARIANT under an object key; SQL null only when the key is missing."""
    return F.try_variant_get(v, f"$.{key}", "variant")


def member_text(v: Column, key: str, missing: str = "") -> Column:
    """Text under a key: ``missing`` without the key, null for JSON null, JSON text otherwise."""
    return F.when(member(v, key).isNull(), F.lit(missing)).otherwise(
        F.try_variant_get(v, f"$.{key}", "string")
    )


def string_member(v: Column, key: str) -> Column:
    """Text under a key when it is a JSON string, else null."""
    return F.when(kind(member(v, key)) == "STRING", F.try_variant_get(v, f"$.{key}", "string"))


def spaced_json(source: Column) -> Column:
    """The same JSON text with one space after ``,`` and ``:`` and none elsewhere.

    Strings are written again with non-ASCII characters in the clear.
    """
    # Raw control characters cannot occur in JSON strings, so two of them stand in for the
    # escaped backslash and quote while the strings are found.
    marked = F.replace(
        F.replace(source, F.lit("\\\\"), F.lit("\x01")), F.lit('\\"'), F.lit("\x02")
    )
    tokens = F.regexp_extract_all(marked, F.lit(r'"[^"]*+"|[^\s",:]++|[,:]'), F.lit(0))

    def rewrite(t: Column) -> Column:
        text = F.replace(
            F.replace(t, F.lit("\x02"), F.lit('\\"')), F.lit("\x01"), F.lit("\\\\")
        )
        return (
            F.when(t.isin(",", ":"), F.concat(t, F.lit(" ")))
            .when(text.contains("\\"), F.coalesce(F.to_json(F.try_parse_json(text)), text))
            .otherwise(t)
        )

    return F.array_join(F.transform(tokens, rewrite), "")
