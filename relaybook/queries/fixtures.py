"""The given tables in the shapes the operators take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relaybook.functions import text_bytes
from relaybook.schemas import MESSAGE
from relaybook.sources.messages import BATCH_BYTES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(
    spark: SparkSession, sf_dir: str, name: str, batch_bytes: int | None = BATCH_BYTES
) -> DataFrame:
    """The same table as a stream; a table is one file or a folder.

    A stream takes a pattern for both; this one fits the exact name and nothing beside it.
    """
    reader = spark.readStream.schema(table(spark, sf_dir, name).schema)
    if batch_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", batch_bytes)
    return reader.parquet(f"{sf_dir}/{name}.parque[t]")


def device_topics(events: DataFrame) -> DataFrame:
    """Events with the MQTT topic ``devices/<type>/<user>`` and the key ``<type>.<user>``."""
    user = F.col("user_id").cast("string")
    return events.withColumn(
        "topic", F.concat(F.lit("devices/"), "event_type", F.lit("/"), user)
    ).withColumn("key", F.concat("event_type", F.lit("."), user))


def landed_events(events: DataFrame) -> DataFrame:
    """Events as landed device messages; the broker retains all of them."""
    return device_topics(events).select(
        "topic", text_bytes(F.col("props")).alias("payload"), F.lit(0).alias("qos"),
        F.lit(True).alias("retained"), F.col("ts").cast("timestamp").alias("ts"),
    )


def event_messages(events: DataFrame) -> DataFrame:
    """Events as messages of the Kafka topic ``devices``."""
    return _messages(
        device_topics(events), F.col("key"), F.col("props"), "devices", F.col("event_id"),
        F.col("ts").cast("timestamp"),
    )


def chat_messages(conversations: DataFrame) -> DataFrame:
    """Conversation turns as messages of the Kafka topic ``chat``, keyed ``<role>.<conversation>``."""
    key = F.concat("role", F.lit("."), F.col("conv_id").cast("string"))
    return _messages(conversations, key, F.col("text"), "chat", F.col("turn"), F.lit(None))


def document_messages(documents: DataFrame) -> DataFrame:
    """Documents as messages of the Kafka topic ``documents``."""
    key = F.col("doc_id").cast("string")
    return _messages(documents, key, F.col("text"), "documents", F.col("doc_id"), F.lit(None))


def _messages(
    rows: DataFrame, key: Column, value: Column, topic: str, offset: Column, ts: Column
) -> DataFrame:
    made = rows.select(
        text_bytes(key).alias("key"), text_bytes(value).alias("value"), F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"), offset.cast("bigint").alias("offset"),
        ts.cast("timestamp").alias("timestamp"),
    )
    return made.select(MESSAGE.fieldNames())
