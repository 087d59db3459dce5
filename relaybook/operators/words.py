"""Words of message values and their counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relaybook.functions import decode_text, tokenize


def values(messages: DataFrame) -> DataFrame:
    """The message values as text, without topic and key."""
    return messages.select(decode_text(F.col("value")).alias("value"))


def words(lines: DataFrame, *, text: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per word; a null text gives none. Columns named in ``keep`` go with each word."""
    return lines.select(*keep, F.explode(tokenize(F.col(text))).alias("word"))


def word_count(lines: DataFrame, *, text: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Occurrences ``n`` of each word, summed inside each task before the one shuffle."""
    return words(lines, text=text, keep=keep).groupBy(*keep, "word").agg(F.count("*").alias("n"))


def top_words(counts: DataFrame, limit: int = 10) -> DataFrame:
    """The most frequent words; equal counts in word order."""
    return counts.orderBy(F.desc("n"), "word").limit(limit)


def counter_lines(counts: DataFrame) -> DataFrame:
    """Counts as lines ``Counter:<word>,<n>``."""
    line = F.concat(F.lit("Counter:"), "word", F.lit(","), F.col("n").cast("string"))
    return counts.select(line.alias("value"))
