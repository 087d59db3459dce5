"""Counts per window of event time."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType, TimestampType

from relaybook.operators.windows import fill_windows, first_of_each, sliding_count, windowed_count
from relaybook.operators.words import words
from relaybook.plans import ClosingWindows, close_windows, count_messages
from relaybook.queries.fixtures import event_messages, table, table_stream
from relaybook.queries.registry import query, sql_words
from relaybook.session import work_dir
from relaybook.sources.messages import read_files
from relaybook.streaming.batchlog import read_or_empty
from relaybook.streaming.counters import Counters
from relaybook.streaming.runs import finish, triggered

HOUR = timedelta(hours=1)
BATCH = timedelta(seconds=5)

_WORDS = sql_words("props", "events", "ts,")
_BATCHES = f"""
    SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, word, count(*) AS n
    FROM ({_WORDS}) GROUP BY ALL"""


def event_words(events: DataFrame) -> DataFrame:
    return words(events, text="props", keep=("ts",))


@query(_BATCHES)
def batch_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windowed_count(event_words(table(spark, sf_dir, "events")), "ts", HOUR, keys=("word",))


@query(f"""
    SELECT time_bucket(INTERVAL '5 seconds', ts) AS window_start, word, count(*) AS n
    FROM ({_WORDS}) GROUP BY ALL""")
def short_batch_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windowed_count(event_words(table(spark, sf_dir, "events")), "ts", BATCH, keys=("word",))


@query(f"""
    SELECT window_start, word, n, place FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY window_start ORDER BY n DESC, word) AS INTEGER) AS place
        FROM ({_BATCHES})) WHERE place <= 10""")
def batch_first_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_word_count(spark, sf_dir).transform(first_of_each)


@query(f"""
    SELECT time_bucket(INTERVAL '1 hour', ts) - k * INTERVAL '1 hour' AS window_start, word, count(*) AS n
    FROM ({_WORDS}), range(3) AS r(k) GROUP BY ALL""")
def sliding_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = event_words(table(spark, sf_dir, "events"))
    return sliding_count(events, "ts", 3 * HOUR, HOUR, keys=("word",))


@query("""
    SELECT g.window_start, count(e.ts) AS n
    FROM (SELECT unnest(generate_series(
              time_bucket(INTERVAL '1 hour', min(ts)), max(ts), INTERVAL '1 hour')) AS window_start
          FROM events) g
    LEFT JOIN events e ON time_bucket(INTERVAL '1 hour', e.ts) = g.window_start
    GROUP BY g.window_start""")
def batch_message_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_windows(windowed_count(table(spark, sf_dir, "events"), "ts", HOUR), HOUR)


@query("""
    SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, count(*) AS n
    FROM events GROUP BY ALL""")
def stream_message_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows counted by a checkpointed stream that is stopped and started again."""
    folder = work_dir(spark, "stream_message_count")
    counters = Counters(spark, f"{folder}/counters")
    for _ in range(2):
        messages = event_messages(table_stream(spark, sf_dir, "events"))
        finish(count_messages(messages, HOUR, counters, f"{folder}/checkpoint"))
    start = F.timestamp_millis(F.col("qualifier").cast("bigint")).cast("timestamp_ntz")
    return counters.totals().select(start.alias("window_start"), F.col("value").alias("n"))


@query("""
    SELECT window_start, count(*) AS n
    FROM (SELECT time_bucket(INTERVAL '1 hour', ts) - k * INTERVAL '1 hour' AS window_start
          FROM events, range(3) AS r(k))
    WHERE window_start + INTERVAL '3 hours' <= (SELECT max(ts) - INTERVAL '10 minutes' FROM events)
    GROUP BY window_start""")
def stream_closed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding windows of a stream with a watermark, written once each as they close.

    The events land in the order of time, a few days at once, and each landing is a batch of its
    own, so windows close over several batches and no row is late.
    """
    folder = work_dir(spark, "stream_closed_windows")
    stored = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"))
    first, last = stored.agg(F.min("ts"), F.max("ts")).first()
    step = (last - first) / 4 if first else timedelta()
    for part in range(4 if first else 0):
        landed = stored.where((F.col("ts") >= F.lit(first + part * step)) if part else F.lit(True))
        if part < 3:
            landed = landed.where(F.col("ts") < F.lit(first + (part + 1) * step))
        landed.write.mode("append").parquet(f"{folder}/landing")
        events = read_files(spark, f"{folder}/landing", stored.schema, stream=True)
        counted = windowed_count(events, "ts", 3 * HOUR, HOUR, late=timedelta(minutes=10))
        writer = counted.writeStream.outputMode("append").format("parquet").option("path", f"{folder}/out")
        finish(triggered(writer.option("checkpointLocation", f"{folder}/checkpoint")).start())
    found = StructType([StructField("window_start", TimestampType()), StructField("n", LongType())])
    closed = read_or_empty(spark, f"{folder}/out", found)
    return closed.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n")


@query("""
    WITH marks AS (SELECT max(ts) - INTERVAL '10 minutes' AS first_mark FROM events WHERE event_id % 2 = 0),
    split AS (
        SELECT *, time_bucket(INTERVAL '1 hour', ts) AS window_start,
            event_id % 2 = 1 AND time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' <= first_mark AS late
        FROM events, marks),
    last_mark AS (SELECT max(ts) - INTERVAL '10 minutes' AS mark FROM events)
    SELECT CASE WHEN late THEN 'late' WHEN window_start + INTERVAL '1 hour' <= mark THEN 'closed' ELSE 'open' END AS kind,
        window_start, count(*) AS n
    FROM split, last_mark GROUP BY ALL""")
def closed_open_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of a stream whose second batch is mostly late: closed ones, open ones, and late rows.

    Together they hold every event.
    """
    folder = work_dir(spark, "closed_open_late")
    stored = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_id")
    windows = ClosingWindows(spark, f"{folder}/windows", stored.schema, "ts", HOUR, timedelta(minutes=10))
    for part in range(2):
        stored.where(F.col("event_id") % 2 == part).write.mode("append").parquet(f"{folder}/landing")
        events = read_files(spark, f"{folder}/landing", stored.schema, stream=True)
        finish(close_windows(events, windows, f"{folder}/checkpoint"))
    counted = windows.windows().select(
        F.when(F.col("closed"), "closed").otherwise("open").alias("kind"), "window_start", "n"
    )
    late = windowed_count(windows.late_rows.read(), "ts", HOUR).select(F.lit("late").alias("kind"), "window_start", "n")
    return counted.unionByName(late).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
