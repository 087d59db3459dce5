"""Message sinks and the console."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from relaybook.streaming.runs import triggered

# The producer settings used unless the caller gives others.
PRODUCER = {
    "acks": "1",
    "retries": "0",
    "batch.size": "16384",
    "linger.ms": "1",
    "buffer.memory": "33554432",
}

_COLUMNS = ("topic", "key", "value", "partition")


def write_messages(
    messages: DataFrame,
    *,
    servers: str | None = None,
    path: str | None = None,
    producer: dict[str, str] | None = None,
) -> None:
    """Write a table of messages to the topics its rows name, or to Parquet files.

    The columns ``topic``, ``key`` and ``value`` are sent. A column ``partition``, if there is
    one, decides the partition; drop it from messages that come from another topic.
    """
    writer = _sink_columns(messages).write
    if _kafka(servers, path):
        writer.format("kafka").options(**kafka_options(servers, producer)).save()
    else:
        writer.mode("append").parquet(path)


def start_messages(
    messages: DataFrame,
    checkpoint: str,
    *,
    servers: str | None = None,
    path: str | None = None,
    producer: dict[str, str] | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Write a stream of messages, as :func:`write_messages` does.

    A failed send fails the batch, which then runs again, so no message is dropped. Kafka may
    then see a message twice; the file sink never does.
    """
    writer = _sink_columns(messages).writeStream.option("checkpointLocation", checkpoint)
    if _kafka(servers, path):
        writer = writer.format("kafka").options(**kafka_options(servers, producer))
    else:
        writer = writer.format("parquet").option("path", path)
    return triggered(writer, every).start()


def start_console(
    stream: DataFrame, checkpoint: str, *, rows: int = 10, every: str | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Print the first rows of every batch."""
    writer = stream.writeStream.format("console").outputMode(mode).option("numRows", rows)
    writer = writer.option("truncate", "false").option("checkpointLocation", checkpoint)
    return triggered(writer, every).start()


def write_lines(lines: DataFrame, path: str) -> None:
    """Write the one text column as lines."""
    lines.write.mode("append").text(path)


def kafka_options(servers: str, producer: dict[str, str] | None = None) -> dict[str, str]:
    settings = {**PRODUCER, **(producer or {})}
    return {"kafka.bootstrap.servers": servers, **{f"kafka.{k}": v for k, v in settings.items()}}


def _sink_columns(messages: DataFrame) -> DataFrame:
    return messages.select([c for c in _COLUMNS if c in messages.columns])


def _kafka(servers: str | None, path: str | None) -> bool:
    if (servers is None) == (path is None):
        raise ValueError("give either servers or path")
    return servers is not None
