"""Windows that close behind a watermark, with the rows that came too late kept beside them."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from relaybook.operators.windows import interval, windowed_count
from relaybook.streaming.batchlog import BatchLog, query_id
from relaybook.streaming.counters import Counters, increments
from relaybook.streaming.folded import FoldedTable
from relaybook.streaming.runs import each_batch

_WATERMARK = StructType([
    StructField("writer_id", StringType()), StructField("batch_id", LongType()),
    StructField("watermark", TimestampType()),
])


class ClosingWindows:
    """Counts of tumbling windows, the watermark of the stream, and its late rows.

    The watermark stands ``late`` behind the newest event time of all batches before; a row is late if
    its window ended at or before it. Such rows are not counted and not lost: they go to a log of their
    own, with all their columns. So closed windows, open ones and late rows add up to all rows.
    """

    def __init__(self, spark: SparkSession, root: str, rows: StructType, ts: str, width: timedelta, late: timedelta):
        self.spark, self.ts, self.width, self.late = spark, ts, width, late
        self.counters = Counters(spark, f"{root}/counts")
        self.late_rows = BatchLog(spark, f"{root}/late", rows)
        self.marks = FoldedTable(spark, f"{root}/watermark", _WATERMARK, ["writer_id"], ["batch_id"], buckets=1)

    def add(self, batch: DataFrame, batch_id: int, writer_id: str | None = None) -> None:
        """Count one batch; a batch that runs again changes nothing."""
        writer = writer_id or query_id(batch.sparkSession)
        known = self.marks.read().where(F.col("writer_id") == writer).first()
        if known and known["batch_id"] >= batch_id:
            return
        mark = known["watermark"] if known else None
        ended = F.window(self.ts, interval(self.width))["end"]
        is_late = ended <= F.lit(mark) if mark else F.lit(False)
        seen = Observation()
        # The newest time is seen on the way to the late rows; no row is late before the first watermark.
        watched = batch.observe(seen, F.max(self.ts).alias("newest")) if mark else batch
        if self.late_rows.add(watched.where(is_late), batch_id, writer) and mark:
            newest = seen.get["newest"]
        else:
            newest = batch.agg(F.max(self.ts)).first()[0]
        counts = windowed_count(batch.where(~is_late), self.ts, self.width)
        start = F.unix_millis("window_start").cast("string")
        self.counters.add(increments(counts.withColumn("start", start), "start", "Windows"), batch_id, writer)
        if newest is not None:
            mark = max(newest - self.late, mark) if mark else newest - self.late
        row = self.spark.createDataFrame([(writer, batch_id, mark)], _WATERMARK)
        self.marks.upsert(row, batch_id, writer)

    def windows(self) -> DataFrame:
        """All windows counted so far: ``window_start``, ``n`` and whether the window is ``closed``.

        With several writers, a window is closed when it is behind the watermarks of all.
        """
        start = F.timestamp_millis(F.col("qualifier").cast("bigint"))
        least = self.marks.read().agg(F.min("watermark").alias("m"), F.count_if(F.col("watermark").isNull()).alias("open")).first()
        mark = None if least["open"] else least["m"]
        end: Column = F.col("window_start") + F.expr(f"interval {interval(self.width)}")
        closed = F.coalesce(end <= F.lit(mark).cast("timestamp"), F.lit(False))
        counted = self.counters.totals().select(start.alias("window_start"), F.col("value").alias("n"))
        return counted.withColumn("closed", closed)


def close_windows(rows: DataFrame, windows: ClosingWindows, checkpoint: str, *, every: str | None = None) -> StreamingQuery:
    """Count a stream of rows into closing windows."""
    return each_batch(rows, windows.add, checkpoint, every=every)
