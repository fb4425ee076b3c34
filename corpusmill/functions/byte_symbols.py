"""One printable symbol per UTF-8 byte, and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def printable_symbols() -> list[str]:
    """Symbol of each byte: printable bytes stand for themselves, the rest follow U+0100."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


SYMBOLS = printable_symbols()
_LATIN1 = "".join(map(chr, range(256)))


def map_bytes(word: Column, targets: str) -> Column:
    """Replace each UTF-8 byte of the text by the character listed for it."""
    return F.translate(F.decode(F.encode(word, "UTF-8"), "ISO-8859-1"), _LATIN1, targets)


def to_symbols(word: Column) -> Column:
    return map_bytes(word, "".join(SYMBOLS))


def hex_to_text(digits: Column) -> Column:
    """UTF-8 text from hex digits; broken sequences become U+FFFD."""
    return F.make_valid_utf8(F.unhex(digits).cast("string"))


def from_symbols(symbols: Column) -> Column:
    # Two bytes per character in UTF-16; the shift to U+01xx keeps byte 0 away from U+0000.
    shifted = "".join(chr(0x100 + b) for b in range(256))
    wide = F.hex(F.encode(F.translate(symbols, "".join(SYMBOLS), shifted), "UTF-16BE"))
    return hex_to_text(F.regexp_replace(wide, "01(..)", "$1"))
