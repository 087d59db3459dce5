"""From landed device messages to the messages a Kafka sink takes.

Each is a narrow DataFrame to DataFrame chain, without a shuffle unless asked for; pass the result to
``write_messages`` or ``start_messages``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relaybook.operators.messages import (
    fan_out,
    keyless,
    to_topic,
    with_envelope,
    with_kafka_topic,
    with_text_payload,
)


def bridge(landed: DataFrame) -> DataFrame:
    """Republish each message as it is, on the same topic and without a key."""
    return landed.transform(with_text_payload).transform(keyless)


def enveloped_bridge(landed: DataFrame, ts: Column | None = None) -> DataFrame:
    """Republish on the Kafka name of the topic, with the payload in a JSON envelope."""
    return (
        landed.transform(with_text_payload)
        .transform(with_kafka_topic)
        .transform(with_envelope, ts)
        .transform(keyless, "kafka_topic")
    )


def replay_bridge(
    landed: DataFrame, topic: str, copies: int = 1000, tasks: int | None = None
) -> DataFrame:
    """Send each payload to one fixed topic many times over, under numbered keys."""
    payloads = landed.transform(with_text_payload).transform(to_topic, topic)
    copied = payloads.select("topic", "payload").transform(fan_out, copies, tasks)
    return copied.select("topic", "key", F.col("payload").alias("value"))
