"""The vehicle feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from relaybook.operators.vehicles import vehicle_messages
from relaybook.streaming.batchlog import BatchLog
from relaybook.streaming.runs import each_batch
from relaybook.streaming.sinks import write_messages

SENT = StructType([StructField("topic", StringType()), StructField("value", StringType())])


def feed_vehicles(
    lines: DataFrame, checkpoint: str, topic: str, *, servers: str | None = None,
    log: BatchLog | None = None, every: str | None = "3 seconds",
) -> StreamingQuery:
    """Turn every micro-batch of lines into one pass of vehicle messages.

    The pass has the batch's number and start time. Messages go to Kafka, or to a log of
    ``topic`` and ``value``, which a repeated batch leaves as it is.
    """
    if (servers is None) == (log is None):
        raise ValueError("give either servers or log")

    def one_pass(batch: DataFrame, batch_id: int) -> None:
        made = vehicle_messages(batch, F.current_timestamp(), F.lit(batch_id))
        sent = made.select(F.lit(topic).alias("topic"), F.col("message").alias("value"))
        if log is not None:
            log.add(sent, batch_id)
        else:
            write_messages(sent, servers=servers)

    return each_batch(lines, one_pass, checkpoint, every=every)
