"""Message sources: Kafka topics, and the same messages kept as files.

A streaming read keeps its position in the query's checkpoint, so ``starting`` only counts for a
query without one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from relaybook.functions.topics import topic_matches
from relaybook.schemas import LANDED, MESSAGE

# One micro-batch of a file stream reads at most this much, so a long backlog commits as it goes.
BATCH_BYTES = 256 * 1024**3
# And one of a Kafka stream this many messages, or the first batch would take all that a topic holds.
BATCH_OFFSETS = 200_000_000


def read_messages(
    spark: SparkSession,
    topics: Sequence[str],
    *,
    servers: str | None = None,
    path: str | None = None,
    stream: bool = False,
    starting: str = "earliest",
    min_partitions: int | None = None,
    batch_offsets: int | None = BATCH_OFFSETS,
    batch_bytes: int | None = BATCH_BYTES,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Messages of some topics, from Kafka ``servers`` or from Parquet files under ``path``.

    ``min_partitions`` splits large Kafka partitions into more read tasks.
    """
    if (servers is None) == (path is None):
        raise ValueError("give either servers or path")
    if path is not None:
        found = read_files(spark, path, MESSAGE, stream=stream, batch_bytes=batch_bytes, options=options)
        return found.where(F.col("topic").isin(list(topics)))
    reader = (spark.readStream if stream else spark.read).format("kafka")
    reader = (
        reader.option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting)
    )
    if min_partitions is not None:
        reader = reader.option("minPartitions", min_partitions)
    if batch_offsets is not None and stream:
        reader = reader.option("maxOffsetsPerTrigger", batch_offsets)
    return reader.options(**(options or {})).load().select(MESSAGE.fieldNames())


def read_landed(
    spark: SparkSession,
    path: str,
    filters: Sequence[str] = ("#",),
    *,
    file_format: str = "parquet",
    stream: bool = False,
    batch_bytes: int | None = BATCH_BYTES,
) -> DataFrame:
    """Device messages landed from an MQTT broker that match any of the subscription filters."""
    found = read_files(spark, path, LANDED, file_format=file_format, stream=stream, batch_bytes=batch_bytes)
    return found.where(topic_matches(F.col("topic"), filters))


def read_files(
    spark: SparkSession,
    path: str,
    schema: StructType,
    *,
    file_format: str = "parquet",
    stream: bool = False,
    batch_bytes: int | None = BATCH_BYTES,
    options: dict[str, str] | None = None,
) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    if stream and batch_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", batch_bytes)
    return reader.format(file_format).schema(schema).options(**(options or {})).load(path)
