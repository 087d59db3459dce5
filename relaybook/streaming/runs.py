"""Starting streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def triggered(writer: DataStreamWriter, every: str | None = None) -> DataStreamWriter:
    """A batch every so often, for example ``"5 seconds"``; else all that is there, then stop."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def each_batch(
    stream: DataFrame,
    action: Callable[[DataFrame, int], object],
    checkpoint: str,
    *,
    every: str | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Call ``action(batch, batch_id)`` once per micro-batch.

    A stream started again on the same checkpoint goes on behind its last finished batch, and
    runs an unfinished one again under the same id. Two streams must never share a checkpoint.
    Batches without data are not run.
    """
    writer = stream.writeStream.outputMode(mode).foreachBatch(action)
    return triggered(writer.option("checkpointLocation", checkpoint), every).start()


def finish(query: StreamingQuery) -> None:
    """Wait for a stream that stops by itself; its error is raised here."""
    query.awaitTermination()

