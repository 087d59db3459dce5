"""Splitting text into words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tokenize(text: Column) -> Column:
    """Words between single spaces, as an array.

    Only U+0020 separates, so tabs and newlines stay inside a word and case is kept. Empty words
    at the start and in the middle stay, those at the end go: ``"a  b "`` gives ``[a, "", b]``,
    ``""`` gives ``[""]`` and a text of spaces only gives ``[]``. Null gives null.
    """
    trimmed = F.rtrim(text)
    return (
        F.when(trimmed != "", F.split(trimmed, " "))
        .when(text == "", F.array(F.lit("")))
        .when(text.isNotNull(), F.array().cast("array<string>"))
    )
