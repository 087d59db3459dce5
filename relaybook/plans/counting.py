"""Streaming jobs that keep counts."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from relaybook.functions import long_bytes
from relaybook.operators.cells import int_cells
from relaybook.operators.windows import windowed_count
from relaybook.operators.words import top_words, values, word_count
from relaybook.schemas import CELL, INCREMENT, TOTAL
from relaybook.streaming.batchlog import BatchLog, no_rows, query_id
from relaybook.streaming.counters import Counters, increments
from relaybook.streaming.folded import FoldedTable
from relaybook.streaming.runs import each_batch, triggered

BATCH_COUNT = StructType([StructField("n", LongType())])
BATCH_WORDS = StructType([StructField("word", StringType()), StructField("n", LongType())])


def count_words(
    messages: DataFrame, counters: Counters, checkpoint: str, *, row_key: str = "Counter",
    every: str | None = None,
) -> StreamingQuery:
    """Add the words of every micro-batch of messages to the counters of one row.

    A batch hands over whole messages and is split here, so that splitting and counting are one
    piece of generated code.
    """

    def count(batch: DataFrame, batch_id: int) -> None:
        counts = batch.transform(values).transform(word_count)
        counters.add(increments(counts, "word", row_key), batch_id)

    return each_batch(messages.select("value"), count, checkpoint, every=every)


def count_messages(
    messages: DataFrame, width: timedelta, counters: Counters, checkpoint: str, *,
    ts: str = "timestamp", row_key: str = "Messages", every: str | None = None,
) -> StreamingQuery:
    """Count messages per event-time window, however late they come.

    The counter's qualifier is the epoch millisecond the window starts at. No state is kept
    between batches, so there is no watermark and nothing is dropped.
    """

    def count(batch: DataFrame, batch_id: int) -> None:
        counts = windowed_count(batch, ts, width)
        start = F.unix_millis("window_start").cast("string")
        counters.add(increments(counts.withColumn("start", start), "start", row_key), batch_id)

    return each_batch(messages.select(ts), count, checkpoint, every=every)


def count_ones(
    stream: DataFrame, counters: Counters, checkpoint: str, *, every: str | None = None
) -> StreamingQuery:
    """Add a stream of increments to the counters, one write per micro-batch."""
    wanted = stream.select(INCREMENT.fieldNames())
    return each_batch(wanted, counters.add, checkpoint, every=every)


def count_batch_words(
    messages: DataFrame, log: BatchLog, checkpoint: str, *, show: int = 10, every: str | None = None
) -> StreamingQuery:
    """Log the word counts of every micro-batch by itself, and print the first of them.

    What is printed is read back from the log, so the batch is counted once.
    """

    def count(batch: DataFrame, batch_id: int) -> None:
        log.add(batch.transform(values).transform(word_count), batch_id)
        if show:
            log.batch(batch_id).transform(top_words, show).show(show, truncate=False)

    return each_batch(messages.select("value"), count, checkpoint, every=every)


def put_batch_words(
    messages: DataFrame, log: BatchLog, checkpoint: str, *, row_key: str = "Counter",
    family: str = "f", every: str | None = None,
) -> StreamingQuery:
    """Put the word counts of every micro-batch as cells of one row, in eight bytes.

    A put replaces: the latest cell of a word has its count in the last batch that held it. The
    batch id is the sequence, which orders the puts of one stream whatever its clock says.
    """

    def put(batch: DataFrame, batch_id: int) -> None:
        counts = batch.transform(values).transform(word_count)
        now, seq = F.current_timestamp(), F.lit(batch_id).cast("bigint")
        cells = int_cells(counts, F.lit(row_key), F.col("word"), F.col("n"), now, seq, family, long_bytes)
        log.add(cells, batch_id)

    return each_batch(messages.select("value"), put, checkpoint, every=every)


def fold_batch_words(
    messages: DataFrame, table: FoldedTable, *, checkpoint: str, row_key: str = "Counter",
    family: str = "f", every: str | None = None,
) -> StreamingQuery:
    """As :func:`put_batch_words`, into a table that holds the last cell of each word only."""

    def put(batch: DataFrame, batch_id: int) -> None:
        counts = batch.transform(values).transform(word_count)
        now, seq = F.current_timestamp(), F.lit(batch_id).cast("bigint")
        cells = int_cells(counts, F.lit(row_key), F.col("word"), F.col("n"), now, seq, family, long_bytes)
        table.upsert(cells, batch_id)

    return each_batch(messages.select("value"), put, checkpoint, every=every)


def cells_table(
    spark: SparkSession, root: str, order: tuple[str, ...] = ("seq", "ts"), **options
) -> FoldedTable:
    """Cells of which only the last version is kept, by sequence first, as one writer's clock may step back."""
    return FoldedTable(spark, root, CELL, ["row_key", "family", "qualifier"], list(order), **options)


def cells_log(spark: SparkSession, root: str) -> BatchLog:
    return BatchLog(spark, root, CELL)


def count_batches(
    messages: DataFrame, log: BatchLog, checkpoint: str, *, every: str | None = None
) -> StreamingQuery:
    """Log the number of messages ``n`` of every micro-batch."""

    def count(batch: DataFrame, batch_id: int) -> bool:
        return log.add(batch.agg(F.count("*").alias("n")), batch_id)

    return each_batch(messages.select(F.lit(1)), count, checkpoint, every=every)


def totals_log(spark: SparkSession, root: str) -> BatchLog:
    return BatchLog(spark, root, TOTAL)


def keep_totals(
    stream: DataFrame, log: BatchLog, checkpoint: str, *, every: str | None = None
) -> StreamingQuery:
    """Keep running totals in the stream's state and log those that a batch changed.

    The state grows with the number of counters; where that is large, set the session's state
    store to RocksDB or use :func:`count_ones`, which needs none.
    """
    totals = stream.groupBy("row_key", "qualifier").agg(F.sum("delta").alias("value"))
    return each_batch(totals, log.add, checkpoint, every=every, mode="update")


def fold_totals(
    stream: DataFrame, table: FoldedTable, checkpoint: str, *, every: str | None = None
) -> StreamingQuery:
    """Keep running totals in the stream's state and the last total of each counter in a folded table.

    Unlike the log of :func:`keep_totals`, the table does not grow with the batches of the past.
    """
    totals = stream.groupBy("row_key", "qualifier").agg(F.sum("delta").alias("value"))

    def fold(batch: DataFrame, batch_id: int) -> bool:
        writer = F.lit(query_id(batch.sparkSession)).alias("writer_id")
        return table.upsert(batch.select("*", writer, F.lit(batch_id).cast("bigint").alias("batch_id")), batch_id)

    return each_batch(totals, fold, checkpoint, every=every, mode="update")


def totals_table(spark: SparkSession, root: str, **options) -> FoldedTable:
    schema = StructType([*TOTAL.fields, StructField("writer_id", StringType()), StructField("batch_id", LongType())])
    return FoldedTable(spark, root, schema, ["row_key", "qualifier", "writer_id"], ["batch_id"], **options)


def folded_totals(table: FoldedTable) -> DataFrame:
    """The total of each counter, summed over the writers of a folded table."""
    return table.read().groupBy("row_key", "qualifier").agg(F.sum("value").alias("value"))


def state_totals(stream: DataFrame, checkpoint: str, *, every: str | None = None) -> StreamingQuery:
    """Keep running totals in the stream's state and nowhere else; :func:`read_state_totals` reads them."""
    totals = stream.groupBy("row_key", "qualifier").agg(F.sum("delta").alias("value"))
    writer = totals.writeStream.outputMode("update").format("noop")
    return triggered(writer.option("checkpointLocation", checkpoint), every).start()


def read_state_totals(spark: SparkSession, *checkpoints: str) -> DataFrame:
    """The totals in the state of streams that keep them, as of each stream's last finished batch.

    Each stream began with an empty state, so their totals add up.
    """
    found = no_rows(spark, TOTAL)
    for checkpoint in checkpoints:
        state = spark.read.format("statestore").load(checkpoint)
        # The value of the state is the sum so far, its one buffer.
        sums = F.col(f"value.`{state.schema['value'].dataType.fieldNames()[0]}`")
        found = found.unionAll(state.select("key.row_key", "key.qualifier", sums.alias("value")))
    return found.groupBy("row_key", "qualifier").agg(F.sum("value").alias("value"))


def last_totals(log: BatchLog) -> DataFrame:
    """The last logged total of each counter, summed over the writers of the log.

    The batches of one writer are in order; a new checkpoint is a new writer, whose state began
    empty, so its totals add to those of the others.
    """
    cell = ["row_key", "qualifier"]
    last = log.read().groupBy(*cell, "writer_id").agg(F.max_by("value", "batch_id").alias("value"))
    return last.groupBy(*cell).agg(F.sum("value").alias("value"))
