"""Cells: put, latest, overwrite, point read, encodings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relaybook.functions import decode_text, int_bytes, long_bytes, text_bytes
from relaybook.operators.cells import (
    get_row,
    latest_cells,
    put_cells,
    read_cells,
    recreate_cells,
)
from relaybook.plans import fold_batch_words, put_batch_words
from relaybook.plans.counting import cells_log, cells_table
from relaybook.queries.fixtures import chat_messages, event_messages, table
from relaybook.queries.registry import query, sql_words
from relaybook.session import work_dir
from relaybook.sources import read_messages
from relaybook.streaming.runs import finish

_USER_EVENTS = """
    SELECT event_type AS row_key, '{family}' AS family, CAST(user_id AS VARCHAR) AS qualifier,
           {value} AS value
    FROM events {where} GROUP BY event_type, user_id"""
_LAST_ID = "printf('%016X', arg_max(event_id, (ts, event_id)))"
_LAST_PROPS = "arg_max(props, (ts, event_id))"


def _cells(events: DataFrame, value: Column, family: str = "f") -> DataFrame:
    """Events as puts into the row of their type and the column of their user."""
    return events.select(
        F.col("event_type").alias("row_key"), F.lit(family).alias("family"),
        F.col("user_id").cast("string").alias("qualifier"), value.alias("value"),
        F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("seq"),
    )


def _id_cells(events: DataFrame) -> DataFrame:
    return _cells(events, long_bytes(F.col("event_id")))


def _props_cells(events: DataFrame, family: str = "f") -> DataFrame:
    return _cells(events, text_bytes(F.col("props")), family)


@query(_USER_EVENTS.format(family="f", value=_LAST_ID, where=""))
def cell_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integer cells put many times; the last put counts."""
    folder = work_dir(spark, "cell_latest")
    put_cells(_id_cells(table(spark, sf_dir, "events")), f"{folder}/cells")
    latest = latest_cells(read_cells(spark, f"{folder}/cells"))
    return latest.withColumn("value", F.hex("value"))


@query("""
    SELECT CAST(conv_id AS VARCHAR) AS row_key, 'f' AS family, role AS qualifier,
           arg_max(text, turn) AS value
    FROM conversations GROUP BY conv_id, role""")
def cell_latest_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last text of each role in a conversation; the turn breaks the tie of equal times."""
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("row_key"), F.lit("f").alias("family"),
        F.col("role").alias("qualifier"), text_bytes(F.col("text")).alias("value"),
        F.timestamp_seconds(F.lit(0)).alias("ts"), F.col("turn").alias("seq"),
    )
    return latest_cells(turns).withColumn("value", decode_text(F.col("value")))


@query(_USER_EVENTS.format(family="info", value=_LAST_PROPS, where=""))
def cell_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table dropped and written anew; nothing of the first write is left."""
    folder = work_dir(spark, "cell_overwrite")
    events = table(spark, sf_dir, "events")
    recreate_cells(_id_cells(events), f"{folder}/cells")
    recreate_cells(_props_cells(events, "info"), f"{folder}/cells")
    latest = latest_cells(read_cells(spark, f"{folder}/cells"))
    return latest.withColumn("value", decode_text(F.col("value")))


@query(_USER_EVENTS.format(family="f", value=_LAST_PROPS, where="WHERE event_type = 'purchase'"))
def cell_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cells of the row asked for."""
    folder = work_dir(spark, "cell_get")
    recreate_cells(_props_cells(table(spark, sf_dir, "events")), f"{folder}/cells")
    return get_row(read_cells(spark, f"{folder}/cells"), "purchase")


@query(_USER_EVENTS.format(family="f", value=_LAST_ID, where=""))
def cell_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same cells put in batches that do not follow the order of time, each folded into its buckets."""
    folder = work_dir(spark, "cell_folded")
    kept = cells_table(spark, f"{folder}/cells", ("ts", "seq"), buckets=8)
    cells = _id_cells(table(spark, sf_dir, "events"))
    for batch in range(4):
        kept.upsert(cells.where(F.col("seq") % 4 == batch), batch, "events")
    # A batch that comes again is known and changes nothing.
    kept.upsert(cells.where(F.col("seq") % 4 == 3), 3, "events")
    return kept.read().select("row_key", "family", "qualifier", F.hex("value").alias("value"))


@query("""
    SELECT CAST(user_id AS VARCHAR) AS row_key, 'f' AS family, event_type AS qualifier,
           arg_max(props, (ts, event_id)) AS value
    FROM events WHERE user_id = 7 GROUP BY user_id, event_type""")
def cell_point_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row of a table of unsorted appends, found by the Bloom filters of its files."""
    folder = work_dir(spark, "cell_point_get")
    cells = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("row_key"), F.lit("f").alias("family"),
        F.col("event_type").alias("qualifier"), text_bytes(F.col("props")).alias("value"),
        F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("seq"),
    )
    for part in range(3):
        put_cells(cells.where(F.col("seq") % 3 == part), f"{folder}/cells", row_keys=100_000)
    return get_row(read_cells(spark, f"{folder}/cells"), "7")


_WORDS_PUT = f"""
    WITH first AS (SELECT word, count(*) AS n FROM ({sql_words("props", "events")}) GROUP BY word),
         later AS (SELECT word, count(*) AS n FROM ({sql_words("text", "conversations")}) GROUP BY word)
    SELECT 'Counter' AS row_key, 'f' AS family, word AS qualifier,
           printf('%016X', coalesce(later.n, first.n)) AS value
    FROM first FULL JOIN later USING (word)"""


@query(_WORDS_PUT)
def stream_cell_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts of two batches put one over the other, into a table of last cells only."""
    folder = work_dir(spark, "stream_cell_folded")
    kept = cells_table(spark, f"{folder}/cells", buckets=8)
    for landed in (
        event_messages(table(spark, sf_dir, "events")),
        chat_messages(table(spark, sf_dir, "conversations")),
    ):
        landed.write.mode("append").parquet(f"{folder}/landing")
        messages = read_messages(spark, ["devices", "chat"], path=f"{folder}/landing", stream=True)
        finish(fold_batch_words(messages, kept, checkpoint=f"{folder}/checkpoint"))
    return kept.read().select("row_key", "family", "qualifier", F.hex("value").alias("value"))


@query(_WORDS_PUT)
def stream_cell_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts of two batches put one over the other; each landed table is one batch."""
    folder = work_dir(spark, "stream_cell_latest")
    log = cells_log(spark, f"{folder}/cells")
    for landed in (
        event_messages(table(spark, sf_dir, "events")),
        chat_messages(table(spark, sf_dir, "conversations")),
    ):
        landed.write.mode("append").parquet(f"{folder}/landing")
        messages = read_messages(spark, ["devices", "chat"], path=f"{folder}/landing", stream=True)
        finish(put_batch_words(messages, log, f"{folder}/checkpoint"))
    return latest_cells(log.read(), ("seq", "ts")).withColumn("value", F.hex("value"))


@query("""
    SELECT event_id, printf('%016X', event_id - user_id * 100) AS long_hex,
           right(printf('%016X', event_id - user_id * 100), 8) AS int_hex, props AS text
    FROM events""")
def int_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of both signs as cell bytes, and text there and back."""
    number = F.col("event_id") - F.col("user_id") * 100
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.hex(long_bytes(number)).alias("long_hex"),
        F.hex(int_bytes(number)).alias("int_hex"),
        decode_text(text_bytes(F.col("props"))).alias("text"),
    )
