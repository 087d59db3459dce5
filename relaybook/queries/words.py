"""Word counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from relaybook.operators import words
from relaybook.queries.fixtures import document_messages, table
from relaybook.queries.registry import query, sql_words

_COUNTS = f"SELECT word, count(*) AS n FROM ({sql_words('text', 'documents')}) GROUP BY word"


@query(_COUNTS)
def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = document_messages(table(spark, sf_dir, "documents"))
    return messages.transform(words.values).transform(words.word_count)


@query(f"{_COUNTS} ORDER BY n DESC, word LIMIT 10")
def word_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_count(spark, sf_dir).transform(words.top_words)


@query(f"SELECT concat('Counter:', word, ',', n) AS value FROM ({_COUNTS})")
def batch_lines_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_count(spark, sf_dir).transform(words.counter_lines)
