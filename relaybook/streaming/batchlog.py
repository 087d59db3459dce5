"""A Parquet log with one folder per micro-batch, in which every batch counts exactly once.

Layout under the root, with one writer per streaming query::

    data/writer_id=<w>/batch_id=<n>/    the rows of the batch
    done/writer_id=<w>/batch_id=<n>/    one row, written after the data is complete

A batch that runs again finds itself done and writes nothing. One that failed halfway replaces its
own folder, which nobody reads before it is done.
"""

from __future__ import annotations

import re
from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

_PLACE = [StructField("writer_id", StringType()), StructField("batch_id", LongType())]
_DONE_AT = StructType([StructField("done_at", TimestampType())])
_DONE = StructType(_DONE_AT.fields + _PLACE)


class BatchLog:
    def __init__(self, spark: SparkSession, root: str, schema: StructType):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema

    def add(self, rows: DataFrame, batch_id: int, writer_id: str | None = None) -> bool:
        """Write the rows of a batch; False if the batch was done before.

        Inside ``foreachBatch`` the writer is the streaming query itself, whose id lives in its
        checkpoint: a restart goes on as the same writer, and a new checkpoint, which counts its
        batches from 0 again, can not hit another writer's batches.
        """
        writer = writer_id or query_id(rows.sparkSession)
        if not re.fullmatch(r"[A-Za-z0-9_-]+", writer):
            raise ValueError("a writer id has only letters, digits, '-' and '_'")
        spot = _spot(writer, batch_id)
        if self.is_done(batch_id, writer):
            return False
        rows.select(self.schema.fieldNames()).write.mode("overwrite").parquet(f"{self.root}/data/{spot}")
        done = rows.sparkSession.range(1).select(F.current_timestamp().alias("done_at"))
        done.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/done/{spot}")
        return True

    def is_done(self, batch_id: int, writer_id: str) -> bool:
        return not self._read(f"done/{_spot(writer_id, batch_id)}", _DONE_AT).isEmpty()

    def forget(self, covered: dict[str, int], grace: timedelta) -> None:
        """Remove batches up to those named for each writer, if done longer than ``grace`` ago."""
        old = F.col("done_at") <= F.current_timestamp() - F.lit(grace)
        for mark in self._read("done", _DONE).where(old).select("writer_id", "batch_id").collect():
            if mark["batch_id"] <= covered.get(mark["writer_id"], -1):
                spot = _spot(mark["writer_id"], mark["batch_id"])
                # Data without a mark is never read, so a stop in between does no harm.
                remove(self.spark, f"{self.root}/done/{spot}")
                remove(self.spark, f"{self.root}/data/{spot}")

    def batch(self, batch_id: int, writer_id: str | None = None) -> DataFrame:
        """The rows of one batch, which may be the one that is running."""
        writer = writer_id or query_id(self.spark)
        return self._read(f"data/{_spot(writer, batch_id)}", self.schema)

    def done(self, after: dict[str, int] | None = None) -> dict[str, list[int]]:
        """The done batches of each writer, or those later than what ``after`` names for it."""
        marks = self._read("done", _DONE)
        for writer, last in (after or {}).items():
            marks = marks.where((F.col("writer_id") != writer) | (F.col("batch_id") > last))
        found: dict[str, set[int]] = {}
        for mark in marks.select("writer_id", "batch_id").collect():
            found.setdefault(mark["writer_id"], set()).add(mark["batch_id"])
        return {writer: sorted(batches) for writer, batches in found.items()}

    def read(self, batches: dict[str, list[int]] | None = None) -> DataFrame:
        """Rows of the done batches, or of some of them; with ``writer_id`` and ``batch_id``.

        Only the folders of these batches are listed, so neither a batch that is being written
        nor one of long ago gets in the way.
        """
        wanted = self.done() if batches is None else batches
        folders = [
            f"{self.root}/data/{_spot(writer, batch)}"
            for writer, found in sorted(wanted.items()) for batch in found
        ]
        schema = StructType(self.schema.fields + _PLACE)
        if not folders:
            return no_rows(self.spark, schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/data")
        return reader.parquet(*folders)

    def _read(self, folder: str, schema: StructType) -> DataFrame:
        return read_or_empty(self.spark, f"{self.root}/{folder}", schema)


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The Parquet files under a path, or no rows where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return no_rows(spark, schema)


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a folder by Hadoop's file system, which reaches every store that Spark writes to."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def no_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    """An empty table that takes no task to read."""
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    return spark.range(0).where(F.lit(False)).select(*nulls)


def query_id(spark: SparkSession) -> str:
    """The id of the streaming query whose batch is running."""
    found = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not found:
        raise ValueError("outside a streaming query, name the writer")
    return found


def _spot(writer: str, batch_id: int) -> str:
    return f"writer_id={writer}/batch_id={int(batch_id)}"
