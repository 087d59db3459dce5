"""Running counters kept by streams."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relaybook.functions import decode_text
from relaybook.operators.messages import keyless, to_topic, with_text_payload
from relaybook.plans import count_batch_words, count_batches, count_words
from relaybook.plans.counting import (
    BATCH_COUNT,
    BATCH_WORDS,
    count_ones,
    fold_totals,
    folded_totals,
    keep_totals,
    last_totals,
    read_state_totals,
    state_totals,
    totals_log,
    totals_table,
)
from relaybook.queries.fixtures import (
    chat_messages,
    document_messages,
    event_messages,
    landed_events,
    table,
    table_stream,
)
from relaybook.queries.registry import query, sql_words
from relaybook.session import work_dir
from relaybook.sources import read_messages
from relaybook.streaming.batchlog import BatchLog
from relaybook.streaming.counters import Counters, increments, wide_rows
from relaybook.streaming.runs import finish
from relaybook.streaming.sinks import start_messages
from relaybook.streaming.triggers import TriggerLog, trigger_counts

_DOCUMENT_WORDS = sql_words("text", "documents")
_CHAT_WORDS = sql_words("text", "conversations")
_CHATS_AND_EVENTS = """
    SELECT 'Counter' AS row_key, qualifier, count(*) AS value
    FROM (SELECT event_type AS qualifier FROM events UNION ALL SELECT role FROM conversations)
    GROUP BY qualifier"""


def _counter_sql(words: str) -> str:
    return f"SELECT 'Counter' AS row_key, word AS qualifier, count(*) AS value FROM ({words}) GROUP BY word"


def _ones(rows: DataFrame, qualifier: Column) -> DataFrame:
    """An increment of 1 per row."""
    return increments(
        rows.select(qualifier.alias("name"), F.lit(1).cast("bigint").alias("n")), "name"
    )


def _key_name(messages: DataFrame) -> DataFrame:
    return _ones(messages, F.substring_index(decode_text(F.col("key")), ".", 1))


def _count_documents(spark: SparkSession, sf_dir: str, counters: Counters, folder: str) -> None:
    messages = document_messages(table_stream(spark, sf_dir, "documents"))
    finish(count_words(messages, counters, f"{folder}/documents"))


def _count_chats(spark: SparkSession, sf_dir: str, counters: Counters, folder: str) -> None:
    messages = chat_messages(table_stream(spark, sf_dir, "conversations"))
    finish(count_words(messages, counters, f"{folder}/conversations"))


@query(_counter_sql(_DOCUMENT_WORDS))
def word_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of messages, split into words, added to the counters of one row."""
    folder = work_dir(spark, "word_counters")
    counters = Counters(spark, folder)
    _count_documents(spark, sf_dir, counters, folder)
    return counters.totals()


@query(_counter_sql(sql_words("props", "events")))
def relay_and_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole way: landed messages, a bridge to one topic, and word counters behind it."""
    folder = work_dir(spark, "relay_and_count")
    landed = landed_events(table_stream(spark, sf_dir, "events"))
    sent = landed.transform(with_text_payload).transform(to_topic, "devices").transform(keyless)
    finish(start_messages(sent, f"{folder}/bridge", path=f"{folder}/topics"))
    messages = read_messages(spark, ["devices"], path=f"{folder}/topics", stream=True)
    counters = Counters(spark, f"{folder}/counters")
    finish(count_words(messages, counters, f"{folder}/words"))
    return counters.totals()


@query("SELECT 'Counter' AS row_key, event_type AS qualifier, count(*) AS value FROM events GROUP BY event_type")
def counter_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "counter_totals")
    counters = Counters(spark, folder)
    ones = _ones(table_stream(spark, sf_dir, "events"), F.col("event_type"))
    finish(count_ones(ones, counters, f"{folder}/checkpoint"))
    return counters.totals()


@query("""
    SELECT l_returnflag AS row_key, CAST(l_suppkey AS VARCHAR) AS qualifier,
           CAST(sum(l_linenumber) AS BIGINT) AS value
    FROM lineitem GROUP BY ALL""")
def counter_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many rows with many qualifiers, and increments other than 1."""
    folder = work_dir(spark, "counter_volume")
    counters = Counters(spark, folder)
    lines = table_stream(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("row_key"), F.col("l_suppkey").cast("string").alias("qualifier"),
        F.col("l_linenumber").cast("bigint").alias("delta"),
    )
    finish(count_ones(lines, counters, f"{folder}/checkpoint"))
    return counters.totals()


@query(_CHATS_AND_EVENTS)
def counter_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that stops, goes on behind its checkpoint, and has its last batch repeated."""
    folder = work_dir(spark, "counter_restart")
    counters = Counters(spark, folder)
    chats = chat_messages(table(spark, sf_dir, "conversations"))
    for landed in (event_messages(table(spark, sf_dir, "events")), chats):
        landed.write.mode("append").parquet(f"{folder}/landing")
        messages = read_messages(spark, ["devices", "chat"], path=f"{folder}/landing", stream=True)
        finish(count_ones(_key_name(messages), counters, f"{folder}/checkpoint"))
    for writer, batches in counters.log.done().items():
        counters.add(_key_name(chats), max(batches), writer)
    return counters.totals()


@query("""
    SELECT 0::BIGINT AS batch_id, count(*) AS n FROM events
    UNION ALL SELECT 1, count(*) FROM conversations""")
def stream_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages of each micro-batch of a stream that was restarted."""
    folder = work_dir(spark, "stream_batch_counts")
    log = BatchLog(spark, f"{folder}/counts", BATCH_COUNT)
    for landed in (
        event_messages(table(spark, sf_dir, "events")),
        chat_messages(table(spark, sf_dir, "conversations")),
    ):
        landed.write.mode("append").parquet(f"{folder}/landing")
        messages = read_messages(spark, ["devices", "chat"], path=f"{folder}/landing", stream=True)
        finish(count_batches(messages, log, f"{folder}/checkpoint"))
    return log.read().select("batch_id", "n")


@query(f"""
    SELECT 0::BIGINT AS batch_id, word, count(*) AS n FROM ({sql_words('props', 'events')}) GROUP BY word
    UNION ALL SELECT 1, word, count(*) FROM ({_CHAT_WORDS}) GROUP BY word""")
def stream_batch_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The word counts of each micro-batch by itself."""
    folder = work_dir(spark, "stream_batch_words")
    log = BatchLog(spark, f"{folder}/counts", BATCH_WORDS)
    for landed in (
        event_messages(table(spark, sf_dir, "events")),
        chat_messages(table(spark, sf_dir, "conversations")),
    ):
        landed.write.mode("append").parquet(f"{folder}/landing")
        messages = read_messages(spark, ["devices", "chat"], path=f"{folder}/landing", stream=True)
        finish(count_batch_words(messages, log, f"{folder}/checkpoint", show=0))
    return log.read().select("batch_id", "word", "n")


@query(_CHATS_AND_EVENTS)
def counter_stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same totals kept in streams' states, with every change logged by two checkpoints."""
    folder = work_dir(spark, "counter_stream_state")
    log = totals_log(spark, f"{folder}/totals")
    for stream, name in (
        (event_messages(table_stream(spark, sf_dir, "events")), "events"),
        (chat_messages(table_stream(spark, sf_dir, "conversations")), "conversations"),
    ):
        finish(keep_totals(_key_name(stream), log, f"{folder}/{name}"))
    return last_totals(log)


@query(_CHATS_AND_EVENTS)
def counter_state_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same totals, of which a folded table keeps the last one of each counter and stream."""
    folder = work_dir(spark, "counter_state_folded")
    kept = totals_table(spark, f"{folder}/totals", buckets=8)
    for stream, name in (
        (event_messages(table_stream(spark, sf_dir, "events")), "events"),
        (chat_messages(table_stream(spark, sf_dir, "conversations")), "conversations"),
    ):
        finish(fold_totals(_key_name(stream), kept, f"{folder}/{name}"))
    return folded_totals(kept)


@query(_CHATS_AND_EVENTS)
def counter_state_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same totals read from the state of a stream that was started again; nothing is logged."""
    folder = work_dir(spark, "counter_state_store")
    for landed in (
        event_messages(table(spark, sf_dir, "events")),
        chat_messages(table(spark, sf_dir, "conversations")),
    ):
        landed.write.mode("append").parquet(f"{folder}/landing")
        messages = read_messages(spark, ["devices", "chat"], path=f"{folder}/landing", stream=True)
        finish(state_totals(_key_name(messages), f"{folder}/checkpoint"))
    return read_state_totals(spark, f"{folder}/checkpoint")


@query(_counter_sql(f"{_DOCUMENT_WORDS} UNION ALL {_CHAT_WORDS}"))
def counter_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals made of a snapshot and of what was counted after it, with a stream started again."""
    folder = work_dir(spark, "counter_compaction")
    counters = Counters(spark, folder)
    _count_documents(spark, sf_dir, counters, folder)
    counters.compact(grace=timedelta())
    _count_documents(spark, sf_dir, counters, folder)
    _count_chats(spark, sf_dir, counters, folder)
    return counters.totals()


@query(_counter_sql(_CHAT_WORDS))
def counter_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters that were set back to 0 in between."""
    folder = work_dir(spark, "counter_reset")
    counters = Counters(spark, folder)
    _count_documents(spark, sf_dir, counters, folder)
    counters.reset()
    _count_chats(spark, sf_dir, counters, folder)
    return counters.totals()


@query("""
    SELECT 'Counter' AS row_key, CAST(c_custkey AS VARCHAR) AS qualifier, count(event_id) AS value
    FROM customer LEFT JOIN events ON user_id = c_custkey GROUP BY c_custkey""")
def counter_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counter of every customer, most of whom have none."""
    folder = work_dir(spark, "counter_lookup")
    counters = Counters(spark, folder)
    ones = _ones(table_stream(spark, sf_dir, "events"), F.col("user_id").cast("string"))
    finish(count_ones(ones, counters, f"{folder}/checkpoint"))
    keys = _ones(table(spark, sf_dir, "customer"), F.col("c_custkey").cast("string"))
    return counters.lookup(keys)


@query(_counter_sql(_CHAT_WORDS))
def counter_wide_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row of counters as maps, opened up again."""
    folder = work_dir(spark, "counter_wide_row")
    counters = Counters(spark, folder)
    _count_chats(spark, sf_dir, counters, folder)
    return wide_rows(counters.totals(), most=1000).select(
        "row_key", F.explode("cells").alias("qualifier", "value")
    )


@query(f"""
    SELECT 'Counter' AS row_key, part, least(1000, n - 1000 * part) AS cells
    FROM (SELECT count(DISTINCT word) AS n FROM ({_CHAT_WORDS})), range(1000000) AS r(part)
    WHERE 1000 * part < n""")
def counter_row_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The size of each part of one row; all but the last are full."""
    folder = work_dir(spark, "counter_row_parts")
    counters = Counters(spark, folder)
    _count_chats(spark, sf_dir, counters, folder)
    parts = wide_rows(counters.totals(), most=1000)
    return parts.select("row_key", "part", F.size("cells").cast("bigint").alias("cells"))


@query("""
    SELECT 0::BIGINT AS trigger_no, count(*) AS n FROM events
    UNION ALL SELECT 1, 0 UNION ALL SELECT 2, count(*) FROM conversations""")
def stream_trigger_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages of each trigger of a stream, the second of which finds none."""
    folder = work_dir(spark, "stream_trigger_counts")
    log = BatchLog(spark, f"{folder}/counts", BATCH_COUNT)
    with TriggerLog(spark, f"{folder}/triggers") as triggers:
        for landed in (
            event_messages(table(spark, sf_dir, "events")), None,
            chat_messages(table(spark, sf_dir, "conversations")),
        ):
            if landed is not None:
                landed.write.mode("append").parquet(f"{folder}/landing")
            messages = read_messages(spark, ["devices", "chat"], path=f"{folder}/landing", stream=True)
            finish(count_batches(messages, log, f"{folder}/checkpoint"))
    return trigger_counts(triggers.read()).select("trigger_no", "n")
