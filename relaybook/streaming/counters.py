"""Running counters, exact under restarts and repeated batches.

Every micro-batch adds its increments to a :class:`BatchLog`; a total is the sum of all of them.
``compact`` folds the log so far into a snapshot, after which reads start from that, and removes
what the snapshot holds, so that reading does not slow down with the batches of the past::

    <root>/table=<t>/family=<f>/data, done           the increments
    <root>/table=<t>/family=<f>/snapshots/totals     totals of each snapshot
    <root>/table=<t>/family=<f>/snapshots/covered    last batch of each writer in it, written last

Totals are grouped by row key and qualifier together, since one row key may hold nearly all
counters.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from relaybook.schemas import INCREMENT, TOTAL
from relaybook.streaming.batchlog import BatchLog, no_rows, query_id, read_or_empty, remove

#: Buckets that a row's cells are numbered in; each holds so small a share of the row.
ROW_BUCKETS = 4096

_AS_OF = StructField("as_of", LongType())
_COVERED = StructType([StructField("writer_id", StringType()), StructField("last", LongType())])


class Counters:
    def __init__(self, spark: SparkSession, root: str, table: str = "counters", family: str = "f"):
        self.spark = spark
        self.root = f"{root.rstrip('/')}/table={table}/family={family}"
        self.log = BatchLog(spark, self.root, INCREMENT)
        self._added: dict[str, int] = {}

    def add(self, increments: DataFrame, batch_id: int, writer_id: str | None = None) -> bool:
        """Add the increments ``(row_key, qualifier, delta)`` of one batch; False if already added.

        A writer's batches come in order, so the last one that a snapshot covers may be repeated
        (and then adds nothing), while an earlier one that left no mark is an error.
        """
        writer = writer_id or query_id(increments.sparkSession)
        # A batch behind the last one added here can not be in a snapshot, so none is read for it.
        if batch_id <= self._added.get(writer, batch_id):
            last = self._snapshot()[1].get(writer)
            if last is not None and batch_id <= last and not self.log.is_done(batch_id, writer):
                if batch_id < last:
                    raise ValueError(f"batch {batch_id} comes after batch {last} was folded into a snapshot")
                return False
        summed = increments.groupBy("row_key", "qualifier").agg(F.sum("delta").alias("delta"))
        added = self.log.add(summed, batch_id, writer)
        self._added[writer] = max(batch_id, self._added.get(writer, batch_id))
        return added

    def totals(self) -> DataFrame:
        """All counters as ``(row_key, qualifier, value)``."""
        as_of, covered = self._snapshot()
        return self._totals(as_of, self.log.done(covered))

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The value of each distinct ``(row_key, qualifier)`` asked for, 0 where there is none.

        Both sides are unique per key by then, so no key can be skewed in the join.
        """
        wanted = keys.select("row_key", "qualifier").distinct()
        found = wanted.join(self.totals(), ["row_key", "qualifier"], "left")
        return found.select("row_key", "qualifier", F.coalesce("value", F.lit(0)).alias("value"))

    def compact(self, grace: timedelta = timedelta(hours=1)) -> None:
        """Fold what is done so far into a snapshot. Run one at a time; writers may go on.

        Its files are sorted, so that asking for some rows skips most of each. Batches that it covers
        and that were done longer than ``grace`` ago are removed, and so are snapshots before the
        last one (with no grace, that too): ``grace`` is how long a reader may take.
        """
        as_of, covered = self._snapshot()
        fresh = self.log.done(covered)
        totals = self._totals(as_of, fresh).sortWithinPartitions("row_key", "qualifier")
        last = self._publish(totals, as_of + 1, covered, fresh)
        self.log.forget(last, grace)
        for old in range(as_of - 1 if grace else as_of, 0, -1):
            # The list of what it covers goes last, as it came last.
            gone = [remove(self.spark, f"{self.root}/snapshots/{part}/as_of={old}")
                    for part in ("totals", "covered")]
            if not any(gone):
                break

    def reset(self) -> None:
        """Start all counters from 0 again: an empty snapshot that covers what is done so far."""
        as_of, covered = self._snapshot()
        self._publish(no_rows(self.spark, TOTAL), as_of + 1, covered, self.log.done(covered))

    def _totals(self, as_of: int, fresh: dict[str, list[int]]) -> DataFrame:
        changes = self.log.read(fresh)
        parts = changes.select("row_key", "qualifier", F.col("delta").alias("value"))
        if as_of:
            parts = parts.unionByName(self._folded("totals", as_of, TOTAL))
        return parts.groupBy("row_key", "qualifier").agg(F.sum("value").alias("value"))

    def _snapshot(self) -> tuple[int, dict[str, int]]:
        published = read_or_empty(
            self.spark, f"{self.root}/snapshots/covered", StructType([*_COVERED.fields, _AS_OF])
        )
        as_of = published.agg(F.max("as_of")).first()[0]
        if as_of is None:
            return 0, {}
        rows = self._folded("covered", as_of, _COVERED).collect()
        return as_of, {row["writer_id"]: row["last"] for row in rows}

    def _folded(self, part: str, as_of: int, schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.root}/snapshots/{part}/as_of={as_of}")

    def _publish(
        self, totals: DataFrame, as_of: int, covered: dict[str, int], fresh: dict[str, list[int]]
    ) -> dict[str, int]:
        folder = f"{self.root}/snapshots"
        totals.write.mode("overwrite").parquet(f"{folder}/totals/as_of={as_of}")
        # A query finishes one batch before it starts the next, so the last one stands for all.
        last = {**covered, **{writer: max(batches) for writer, batches in fresh.items()}}
        rows = self.spark.createDataFrame(sorted(last.items()), _COVERED)
        rows.coalesce(1).write.mode("overwrite").parquet(f"{folder}/covered/as_of={as_of}")
        return last


def wide_rows(totals: DataFrame, most: int = 10_000) -> DataFrame:
    """Each row as maps of qualifier to value, in parts of ``most`` cells; only a row's last part has fewer.

    A row key can hold any number of qualifiers, so its cells are numbered without ever being in one
    place: they are dealt to buckets by hash and counted there, the counts give each bucket's start, and
    a cell is numbered within its bucket. Parts are runs of these numbers, so no part is over ``most``
    whatever the row's size, and a row's parts are alike in every run. A null qualifier can not be a key
    of a map and is an error.
    """
    if most < 1:
        raise ValueError("a part holds at least one cell")
    dealt = totals.withColumn("bucket", F.pmod(F.xxhash64("qualifier"), F.lit(ROW_BUCKETS)).cast("int"))
    counts = dealt.groupBy("row_key", "bucket").agg(F.count("*").alias("held"))
    earlier = Window.partitionBy("row_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("row_key").alias("own_key"), F.col("bucket").alias("own_bucket"),
        F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("start"),
    )
    within = F.row_number().over(Window.partitionBy("row_key", "bucket").orderBy("qualifier"))
    numbered = dealt.withColumn("within", within).join(
        starts, F.col("row_key").eqNullSafe(F.col("own_key")) & (F.col("bucket") == F.col("own_bucket"))
    )
    part = F.expr(f"(start + within - 1) div {int(most)}").alias("part")
    entries = F.array_sort(F.collect_list(F.struct("qualifier", "value")))
    return numbered.groupBy("row_key", part).agg(F.map_from_entries(entries).alias("cells"))


def increments(counts: DataFrame, qualifier: str, row_key: str = "Counter", n: str = "n") -> DataFrame:
    """Counts as increments of one row, each under its own qualifier."""
    return counts.select(
        F.lit(row_key).alias("row_key"), F.col(qualifier).alias("qualifier"), F.col(n).alias("delta")
    )
