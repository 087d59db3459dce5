"""A table of the last row of every key, folded batch by batch.

Keys are dealt by hash to a fixed number of buckets. A batch is merged with the buckets that it touches
and with no others; the merged buckets become folders of a new generation::

    data/generation=<g>/bucket=<b>/    a bucket as of the batch that made generation g
    done/generation=<g>/               last batch of each writer, number of buckets; written last

A bucket is read from its newest generation that is done, so a reader lists one folder a bucket whatever
the number of batches. Nothing is overwritten in place: a folder that is replaced goes away before its
successor is there, and a stop in between would lose the bucket's other keys.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from relaybook.streaming.batchlog import no_rows, query_id, read_or_empty, remove

BUCKETS = 64
_MARK = StructType([
    StructField("writer_id", StringType()), StructField("last", LongType()),
    StructField("buckets", IntegerType()),
])


class FoldedTable:
    """The row with the highest ``order`` of every ``key``.

    Merging is the same however often and in whatever order batches come, as long as rows of one key
    differ in ``order``; rows equal in both are told apart by their other columns, so the result is
    defined then too. Null keys are keys like others; an order of null is the lowest. One writer at a
    time; readers may go on while ``keep`` later batches are added.
    """

    def __init__(
        self, spark: SparkSession, root: str, schema: StructType, key: list[str], order: list[str],
        buckets: int = BUCKETS, keep: int = 2,
    ):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.key, self.order, self.buckets, self.keep = key, order, buckets, max(1, keep)
        self.rest = [name for name in schema.fieldNames() if name not in (*key, *order)]

    def upsert(self, rows: DataFrame, batch_id: int, writer_id: str | None = None) -> bool:
        """Merge a batch; False if it was merged before.

        Inside ``foreachBatch`` the writer is the streaming query, as in :class:`BatchLog`. The batch's
        rows are cut to one a key before they meet the stored ones, so a busy key costs one row a task.
        """
        writer = writer_id or query_id(rows.sparkSession)
        if not re.fullmatch(r"[A-Za-z0-9_-]+", writer):
            raise ValueError("a writer id has only letters, digits, '-' and '_'")
        newest, covered = self._marks()
        if batch_id <= covered.get(writer, -1):
            return False
        spark = rows.sparkSession
        generation = newest + 1
        fresh = self._newest_of(rows.select(self.schema.fieldNames())).withColumn("bucket", self._bucket())
        # The batch, one row a key, lies in the new generation's own folder until it is merged.
        landed = f"{self.root}/incoming/generation={generation}"
        fresh.write.mode("overwrite").parquet(landed)
        incoming = spark.read.schema(fresh.schema).parquet(landed)
        touched = sorted(r["bucket"] for r in incoming.select("bucket").distinct().collect())
        if touched:
            stored = self._read(spark, newest, set(touched)).withColumn("bucket", self._bucket())
            merged = self._newest_of(incoming.unionByName(stored), "bucket")
            merged.repartition(len(touched), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(
                f"{self.root}/data/generation={generation}"
            )
        last = {**covered, writer: int(batch_id)}
        mark = spark.createDataFrame([(w, b, self.buckets) for w, b in sorted(last.items())], _MARK)
        mark.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/done/generation={generation}")
        remove(spark, landed)
        self._forget(generation)
        return True

    def read(self) -> DataFrame:
        """The last row of every key."""
        return self._read(self.spark, self._marks()[0])

    def files(self) -> int:
        """Data files that a reader lists now."""
        folders = self._folders(self._marks()[0])
        return len(self.spark.read.schema(self.schema).parquet(*folders).inputFiles()) if folders else 0

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def _newest_of(self, rows: DataFrame, *also: str) -> DataFrame:
        """One row a key. The hash comes first in the grouping, as numbers are compared faster than texts."""
        last = F.max(F.struct(*self.order, *self.rest)).alias("last")
        kept = rows.groupBy(F.xxhash64(*self.key).alias("hash"), *self.key, *also).agg(last)
        fields = [
            F.col(name) if name in self.key else F.col("last")[name].alias(name)
            for name in self.schema.fieldNames()
        ]
        return kept.select(*fields, *also)

    def _read(self, spark: SparkSession, generation: int, only: set[int] | None = None) -> DataFrame:
        folders = self._folders(generation, only)
        return spark.read.schema(self.schema).parquet(*folders) if folders else no_rows(spark, self.schema)

    def _marks(self) -> tuple[int, dict[str, int]]:
        """The newest generation that is done, and the last batch of each writer in it."""
        done = self._listed("done/generation=*")
        for generation in sorted((int(path.rpartition("=")[2]) for path in done), reverse=True):
            rows = read_or_empty(self.spark, f"{self.root}/done/generation={generation}", _MARK).collect()
            if rows:
                if rows[0]["buckets"] != self.buckets:
                    raise ValueError(f"the table has {rows[0]['buckets']} buckets, not {self.buckets}")
                return generation, {row["writer_id"]: row["last"] for row in rows}
        return 0, {}

    def _folders(self, generation: int, only: set[int] | None = None) -> list[str]:
        newest: dict[int, tuple[int, str]] = {}
        for made, bucket, path in self._stored():
            if made <= generation and (only is None or bucket in only):
                newest[bucket] = max(newest.get(bucket, (0, "")), (made, path))
        return [path for _, path in sorted(newest.values())]

    def _stored(self) -> list[tuple[int, int, str]]:
        """Each bucket folder as (generation, bucket, path); there are ``buckets`` times a few."""
        found = []
        for path in self._listed("data/generation=*/bucket=*"):
            made, bucket = re.search(r"generation=(\d+)/bucket=(\d+)$", path).groups()
            found.append((int(made), int(bucket), path))
        return found

    def _listed(self, pattern: str) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{pattern}")
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path)
        return [status.getPath().toString() for status in found or []]

    def _forget(self, generation: int) -> None:
        """Remove what no reader needs that began within the last ``keep`` batches."""
        oldest = generation - self.keep
        needed = set(self._folders(oldest))
        for made, _, path in self._stored():
            if made <= oldest and path not in needed:
                remove(self.spark, path)
        for path in self._listed("done/generation=*"):
            if int(path.rpartition("=")[2]) < oldest:
                remove(self.spark, path)
        for path in self._listed("data/generation=*"):
            made = int(path.rpartition("=")[2])
            if made <= oldest and not self._listed(f"data/generation={made}/bucket=*"):
                remove(self.spark, path)
