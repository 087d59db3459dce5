"""Values to and from cell bytes: big-endian integers and UTF-8 text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def long_bytes(number: Column) -> Column:
    """Eight bytes, the form counters are kept in."""
    return F.unhex(F.lpad(F.hex(number.cast("bigint")), 16, "0"))


def int_bytes(number: Column) -> Column:
    """Four bytes, the form of a plain integer cell; a number that needs more is an error.

    Eight and four bytes do not mix: a counter can not go on from such a cell.
    """
    wide = number.cast("bigint")
    low = F.unhex(F.right(F.lpad(F.hex(wide), 16, "0"), F.lit(8)))
    return F.when(wide.between(-(2**31), 2**31 - 1), low).when(
        wide.isNotNull(), F.raise_error(F.concat(F.lit("no 32-bit number: "), wide.cast("string")))
    )


def text_bytes(text: Column) -> Column:
    return text.cast("binary")


def decode_text(raw: Column) -> Column:
    """UTF-8 text; bytes that are not valid become U+FFFD."""
    return F.make_valid_utf8(raw.cast("string"))
