"""Rows of the document table as lines of text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def document_lines(documents: DataFrame) -> DataFrame:
    """One line per document. A missing number reads 0 and a missing text ``null``."""
    # The labels.
    line = F.concat(
        F.lit("id: "), _number("id"),
        F.lit("\ttype: "), _text("type"),
        F.lit("\tauthors: "), _text("authors"),
        F.lit("\ttitle: "), _text("title"),
        F.lit("\tyear:"), _number("year"),
    )
    return documents.select("id", line.alias("line"))


def _number(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).cast("string")


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("null"))
