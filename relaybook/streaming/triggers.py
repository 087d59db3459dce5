"""What every trigger of a stream found, also those that found nothing.

A batch without data does not run, so no sink hears of it. A listener does: Spark reports the progress
of each batch that ran, and of a trigger that had nothing to do that the query was idle.
"""

from __future__ import annotations

import threading
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from relaybook.streaming.batchlog import read_or_empty

TRIGGER = StructType([
    StructField("query_id", StringType()), StructField("run_id", StringType()),
    StructField("triggered_at", TimestampType()), StructField("batch_id", LongType()),
    StructField("n", LongType()),
])


class TriggerLog(StreamingQueryListener):
    """A log with the number of rows of each trigger: 0 for one that found no data.

    Use it as a context, or add it to ``spark.streams`` and remove it. Events arrive a little after
    their triggers and in their order; ``flush`` writes those that have arrived, a few rows at once, and
    leaving the context waits for the end of every query it saw begin. A run that ends without a batch,
    as one over what there is does when there is nothing, is a trigger that found none.

    Spark reports an idle query every ``spark.sql.streaming.noDataProgressEventInterval`` milliseconds at
    most (10,000 by default): set that to the trigger's interval where each empty trigger is to be a row.
    """

    def __init__(self, spark: SparkSession, path: str, wait: float = 60.0):
        self.spark, self.path, self.wait = spark, path, wait
        self._events: list[tuple] = []
        #: Of each run that goes on: its query, when it began, and whether a trigger was reported.
        self._open: dict[str, tuple[str, str, bool]] = {}
        self._change = threading.Condition()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        with self._change:
            self._open[str(event.runId)] = (str(event.id), event.timestamp, False)

    def onQueryProgress(self, event) -> None:  # noqa: N802
        found = event.progress
        self._add(found.id, found.runId, found.timestamp, found.batchId, found.numInputRows)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        self._add(event.id, event.runId, event.timestamp, None, 0)

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        run = str(event.runId)
        with self._change:
            query, began, heard = self._open.get(run, (str(event.id), "", True))
        if not heard and event.exception is None:
            self._add(query, run, began, None, 0)
        with self._change:
            self._open.pop(run, None)
            self._change.notify_all()

    def _add(self, query, run, timestamp: str, batch_id: int | None, n: int) -> None:
        at = datetime.fromisoformat(timestamp.replace("Z", "+00:00"))
        with self._change:
            self._events.append((str(query), str(run), at, batch_id, n))
            if str(run) in self._open:
                self._open[str(run)] = (*self._open[str(run)][:2], True)

    def flush(self) -> None:
        """Write the events that have arrived and not been written."""
        with self._change:
            events, self._events = self._events, []
        if events:
            self.spark.createDataFrame(events, TRIGGER).coalesce(1).write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        return read_or_empty(self.spark, self.path, TRIGGER)

    def __enter__(self) -> TriggerLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error) -> None:
        with self._change:
            self._change.wait_for(lambda: not self._open, self.wait)
        self.spark.streams.removeListener(self)
        self.flush()


def trigger_counts(log: DataFrame) -> DataFrame:
    """The number of rows ``n`` of each trigger, numbered from 0 for each query in the order of time."""
    in_time = Window.partitionBy("query_id").orderBy("triggered_at", F.col("batch_id").asc_nulls_last())
    return log.select(
        "query_id", (F.row_number().over(in_time) - 1).cast("bigint").alias("trigger_no"), "triggered_at", "n"
    )
