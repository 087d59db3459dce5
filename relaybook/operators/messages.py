"""Reshaping messages on their way from one broker to another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relaybook.functions import decode_text, envelope, normalize_topic


def with_header(messages: DataFrame, name: str, expression: str) -> DataFrame:
    """Add a header as a column, computed by a SQL expression over the message."""
    return messages.withColumn(name, F.expr(expression))


def with_kafka_topic(messages: DataFrame) -> DataFrame:
    """Add ``kafka_topic``, the topic's Kafka name."""
    return messages.withColumn("kafka_topic", normalize_topic(F.col("topic")))


def with_envelope(messages: DataFrame, ts: Column | None = None) -> DataFrame:
    """Replace the payload by its JSON envelope, stamped with ``ts`` or the processing time."""
    stamp = F.current_timestamp() if ts is None else ts
    return messages.withColumn("payload", envelope(F.col("payload"), stamp))


def with_text_payload(messages: DataFrame) -> DataFrame:
    return messages.withColumn("payload", decode_text(F.col("payload")))


def to_topic(messages: DataFrame, topic: str) -> DataFrame:
    """Send every message to one fixed topic, whatever topic it came from."""
    return messages.withColumn("topic", F.lit(topic))


def keyless(messages: DataFrame, topic: str = "topic") -> DataFrame:
    """The sink's columns: the topic, no key, and the payload as value."""
    return messages.select(
        F.col(topic).alias("topic"), F.lit(None).cast("string").alias("key"),
        F.col("payload").alias("value"),
    )


def fan_out(messages: DataFrame, copies: int = 1000, tasks: int | None = None) -> DataFrame:
    """Each message ``copies`` times, keyed ``"0"``, ``"1"``, and so on.

    ``tasks`` spreads the messages first, which costs a fraction of the copies they become; use
    it where the input has few splits.
    """
    if copies < 1:
        raise ValueError("there must be at least one copy")
    if tasks is not None:
        messages = messages.repartition(tasks)
    number = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    return messages.withColumn("key", number).withColumn("key", F.col("key").cast("string"))


def retained(messages: DataFrame, *order: str) -> DataFrame:
    """The message a broker retains for each topic: the last one flagged so.

    ``order`` names the columns that tell which is last, ``ts`` by default; add a sequence where
    times can be equal. An empty payload clears the topic.
    """
    latest = F.max_by(F.struct("payload", "qos"), F.struct(*(order or ("ts",)))).alias("last")
    # Spark sorts to group here; with a number first it rarely has to compare the topics.
    topic = (F.xxhash64("topic").alias("hash"), "topic")
    kept = messages.where("retained").groupBy(*topic).agg(latest)
    return kept.select("topic", "last.payload", "last.qos").where(F.length("payload") > 0)
