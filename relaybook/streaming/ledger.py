"""Committed positions of a consumer that reads topics in batches.

A ledger holds ranges of offsets, from the first to before ``until``, for every topic and partition that
a consumer has worked through. Ranges that touch are merged, holes stay visible, and a range that was
committed before is refused, so each message is worked on once, also if a commit is lost and the read is
repeated. Every commit writes the merged ranges as a new state; there are as many rows as partitions and
holes, whatever the number of commits::

    <root>/consumer=<c>/state/commit=<n>/     topic, partition, first, until
    <root>/consumer=<c>/done/commit=<n>/      one row, written last
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from relaybook.streaming.batchlog import no_rows, read_or_empty, remove

RANGE = StructType([
    StructField("topic", StringType()), StructField("partition", IntegerType()),
    StructField("first", LongType()), StructField("until", LongType()),
])
_DONE = StructType([StructField("at", LongType()), StructField("commit", LongType())])
_PLACE = ["topic", "partition"]


def merged(ranges: DataFrame) -> DataFrame:
    """Ranges that touch or overlap made one; empty ones are left out."""
    order = Window.partitionBy(*_PLACE).orderBy("first", "until")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    opens = F.coalesce(F.col("first") > F.max("until").over(before), F.lit(True))
    runs = ranges.where("first < until").withColumn("opens", opens.cast("int"))
    numbered = runs.withColumn("run", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*_PLACE, "run").agg(
        F.min("first").alias("first"), F.max("until").alias("until")
    ).select(RANGE.fieldNames())


def holes(ranges: DataFrame) -> DataFrame:
    """What lies between the ranges of a partition."""
    order = Window.partitionBy(*_PLACE).orderBy("first")
    next_first = F.lead("first").over(order)
    return merged(ranges).select(
        *_PLACE, F.col("until").alias("first"), next_first.alias("until")
    ).where("until is not null")


def without(ranges: DataFrame, taken: DataFrame) -> DataFrame:
    """The parts of ``ranges`` that ``taken`` does not hold."""
    # Between two borders that follow each other, all offsets are in the same ranges.
    sides = merged(ranges).select("*", F.lit(1).alias("wanted"), F.lit(0).alias("held")).unionAll(
        merged(taken).select("*", F.lit(0), F.lit(1))
    )
    borders = sides.select(*_PLACE, F.col("first").alias("first"), "wanted", "held").unionAll(
        sides.select(*_PLACE, F.col("until"), -F.col("wanted"), -F.col("held"))
    ).groupBy(*_PLACE, "first").agg(F.sum("wanted").alias("wanted"), F.sum("held").alias("held"))
    order = Window.partitionBy(*_PLACE).orderBy("first")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    cut = borders.select(
        *_PLACE, "first", F.lead("first").over(order).alias("until"),
        F.sum("wanted").over(so_far).alias("wanted"), F.sum("held").over(so_far).alias("held"),
    )
    return merged(cut.where("wanted > 0 and held = 0 and until is not null").select(RANGE.fieldNames()))


def available(messages: DataFrame) -> DataFrame:
    """The range of offsets that messages have in each partition."""
    return messages.groupBy(*_PLACE).agg(
        F.min("offset").alias("first"), (F.max("offset") + 1).alias("until")
    )


def within(messages: DataFrame, ranges: DataFrame) -> DataFrame:
    """The messages whose offset lies in one of the ranges."""
    held = merged(ranges).select(
        F.col("topic").alias("own_topic"), F.col("partition").alias("own_partition"), "first", "until"
    )
    return messages.join(held, (
        (F.col("topic") == F.col("own_topic")) & (F.col("partition") == F.col("own_partition"))
        & (F.col("offset") >= F.col("first")) & (F.col("offset") < F.col("until"))
    ), "left_semi")


def kafka_offsets(ranges: DataFrame) -> tuple[str, str]:
    """The options ``startingOffsets`` and ``endingOffsets`` of a Kafka read of these ranges.

    Such a read takes one range of a partition, so holes are read again; see :func:`within`.
    """
    starts: dict[str, dict[str, int]] = {}
    ends: dict[str, dict[str, int]] = {}
    spans = ranges.groupBy(*_PLACE).agg(F.min("first").alias("first"), F.max("until").alias("until"))
    for row in spans.collect():
        starts.setdefault(row["topic"], {})[str(row["partition"])] = row["first"]
        ends.setdefault(row["topic"], {})[str(row["partition"])] = row["until"]
    return json.dumps(starts, sort_keys=True), json.dumps(ends, sort_keys=True)


class Ledger:
    def __init__(self, spark: SparkSession, root: str, consumer: str):
        self.spark, self.root = spark, f"{root.rstrip('/')}/consumer={consumer}"

    def committed(self) -> DataFrame:
        """The merged ranges that were committed."""
        return self._state(self._last())

    def gaps(self) -> DataFrame:
        """Offsets between committed ones that were not."""
        return holes(self.committed())

    def pending(self, offered: DataFrame) -> DataFrame:
        """The parts of the offered ranges that were not committed yet."""
        return without(offered, self.committed())

    def commit(self, ranges: DataFrame) -> int:
        """Add ranges and return the number of the commit.

        A range that overlaps a committed one, or another of the same call, is an error and nothing is
        committed then.
        """
        last = self._last()
        state = self._state(last)
        all_ranges = state.unionByName(ranges.select(RANGE.fieldNames())).where("first < until")
        before = Window.partitionBy(*_PLACE).orderBy("first", "until").rowsBetween(Window.unboundedPreceding, -1)
        twice = all_ranges.withColumn("reached", F.max("until").over(before)).where("first < reached").first()
        if twice:
            raise ValueError(f"offsets from {twice['first']} of {twice['topic']}-{twice['partition']} are committed")
        folder, number = f"{self.root}/state/commit={last + 1}", last + 1
        merged(all_ranges).coalesce(1).write.mode("overwrite").parquet(folder)
        done = self.spark.range(1).select(F.lit(0).cast("bigint").alias("at"))
        # A second consumer of the same name that commits at the same time fails here.
        done.coalesce(1).write.mode("errorifexists").parquet(f"{self.root}/done/commit={number}")
        for part in ("done", "state"):
            remove(self.spark, f"{self.root}/{part}/commit={number - 2}")
        return number

    def consume(self, messages: DataFrame, action: Callable[[DataFrame], object]) -> int | None:
        """Give the messages that were not committed to ``action``, then commit them; None if there are none.

        What is committed is the range of offsets from the first to the last one offered, less what was
        committed before: offsets without a message, which compacted topics have, count as read.
        """
        wanted = self.pending(available(messages)).collect()
        if not wanted:
            return None
        # As many rows as partitions and holes.
        ranges = self.spark.createDataFrame(wanted, RANGE)
        action(within(messages, ranges))
        return self.commit(ranges)

    def _last(self) -> int:
        done = read_or_empty(self.spark, f"{self.root}/done", _DONE)
        return done.agg(F.max("commit")).first()[0] or 0

    def _state(self, number: int) -> DataFrame:
        if not number:
            return no_rows(self.spark, RANGE)
        return self.spark.read.schema(RANGE).parquet(f"{self.root}/state/commit={number}")
