import os
from datetime import datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from relaybook.operators.messages import fan_out, retained, to_topic, with_envelope, with_header
from relaybook.operators.vehicles import VINS, vehicle_messages
from relaybook.operators.windows import windowed_count
from relaybook.operators.words import counter_lines, top_words, values, word_count
from relaybook.plans import (
    bridge,
    count_batch_words,
    count_batches,
    count_messages,
    count_words,
    enveloped_bridge,
    feed_vehicles,
    replay_bridge,
)
from relaybook.plans.counting import BATCH_COUNT, BATCH_WORDS
from relaybook.plans.fleet import SENT
from relaybook.queries.fixtures import (
    document_messages,
    event_messages,
    landed_events,
    table,
    table_stream,
)
from relaybook.schemas import LANDED, MESSAGE
from relaybook.sources import read_landed, read_lines, read_messages
from relaybook.streaming.batchlog import BatchLog
from relaybook.streaming.counters import Counters
from relaybook.streaming.runs import finish, triggered
from relaybook.streaming.sinks import kafka_options, start_console, start_messages, write_messages

SF_DIR = "/root/testdata/sf0.001"


def bag(df):
    return sorted(tuple(r) for r in df.collect())


def landed(spark, *rows):
    return spark.createDataFrame(list(rows), LANDED)


# --- a stream gives what the table gives

def test_words_of_a_stream(spark, folder):
    counters = Counters(spark, f"{folder}/counters")
    messages = document_messages(table_stream(spark, SF_DIR, "documents"))
    finish(count_words(messages, counters, f"{folder}/checkpoint"))
    batch = document_messages(table(spark, SF_DIR, "documents")).transform(values).transform(word_count)
    assert bag(counters.totals().select("qualifier", "value")) == bag(batch)


def test_a_live_stream(spark, folder):
    """Batches by the clock, over files that come one after the other."""
    counters = Counters(spark, f"{folder}/counters")
    rows = [(None, b"a b", "t", 0, i, None) for i in range(3)]
    for i, row in enumerate(rows):
        spark.createDataFrame([row], MESSAGE).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        if i == 0:
            messages = read_messages(spark, ["t"], path=f"{folder}/in", stream=True)
            query = count_words(messages, counters, f"{folder}/checkpoint", every="1 second")
        query.processAllAvailable()
    query.stop()
    assert bag(counters.totals()) == [("Counter", "a", 3), ("Counter", "b", 3)]
    assert len(query.recentProgress) >= 3


def test_windows_of_a_stream(spark, folder):
    hour = timedelta(hours=1)
    counters = Counters(spark, f"{folder}/counters")
    messages = event_messages(table_stream(spark, SF_DIR, "events"))
    finish(count_messages(messages, hour, counters, f"{folder}/checkpoint"))
    batch = windowed_count(table(spark, SF_DIR, "events"), "ts", hour)
    start = F.timestamp_millis(F.col("qualifier").cast("bigint")).cast("timestamp_ntz")
    assert bag(counters.totals().select(start, "value")) == bag(batch)


def test_windows_close_behind_the_watermark(spark, folder):
    """Windows still open at the end of the input are not written in append mode."""
    events = table_stream(spark, SF_DIR, "events").select(F.col("ts").cast("timestamp"))
    second = timedelta(seconds=1)
    counted = windowed_count(events, "ts", 3 * second, second, late=timedelta(minutes=10))
    writer = counted.writeStream.format("parquet").option("path", f"{folder}/out")
    finish(triggered(writer.option("checkpointLocation", f"{folder}/checkpoint")).start())
    every = windowed_count(table(spark, SF_DIR, "events"), "ts", 3 * second, second)
    last = table(spark, SF_DIR, "events").agg(F.max("ts")).first()[0]
    closed = every.where(F.col("window_start") + F.expr("interval 3 seconds") <= F.lit(last - timedelta(minutes=10)))
    written = spark.read.parquet(f"{folder}/out")
    written = written.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    assert bag(written) == bag(closed)
    assert written.count() < every.count()


def test_bridge_of_a_stream(spark, folder):
    messages = enveloped_bridge(landed_events(table_stream(spark, SF_DIR, "events")), F.col("ts"))
    finish(start_messages(messages, f"{folder}/checkpoint", path=f"{folder}/out"))
    batch = enveloped_bridge(landed_events(table(spark, SF_DIR, "events")), F.col("ts"))
    written = spark.read.schema(batch.schema).parquet(f"{folder}/out")
    assert bag(written.select("topic", "value")) == bag(batch.select("topic", "value"))
    # The same checkpoint again: nothing is sent twice.
    finish(start_messages(messages, f"{folder}/checkpoint", path=f"{folder}/out"))
    assert spark.read.schema(batch.schema).parquet(f"{folder}/out").count() == batch.count()


# --- counts per micro-batch

def test_counts_per_batch(spark, folder):
    log = BatchLog(spark, f"{folder}/log", BATCH_COUNT)
    for n in (3, 5):
        landed_rows = [(f"t{i}", b"x", 0, False, None) for i in range(n)]
        landed(spark, *landed_rows).coalesce(1).write.mode("append").parquet(f"{folder}/landing")
        stream = read_landed(spark, f"{folder}/landing", stream=True)
        finish(count_batches(stream, log, f"{folder}/checkpoint"))
    finish(count_batches(read_landed(spark, f"{folder}/landing", stream=True), log, f"{folder}/checkpoint"))
    assert bag(log.read().select("batch_id", "n")) == [(0, 3), (1, 5)]


def test_words_per_batch(spark, folder):
    log = BatchLog(spark, f"{folder}/log", BATCH_WORDS)
    for text in (b"a b a", b"a"):
        rows = [(None, text, "t", 0, 0, None)]
        spark.createDataFrame(rows, MESSAGE).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        messages = read_messages(spark, ["t"], path=f"{folder}/in", stream=True)
        finish(count_batch_words(messages, log, f"{folder}/checkpoint"))
    assert bag(log.read().select("batch_id", "word", "n")) == [(0, "a", 2), (0, "b", 1), (1, "a", 1)]


# --- sources and sinks

def test_messages_from_files(spark, folder):
    rows = [(b"k", b"v", "a", 0, 1, None), (None, b"w", "b", 0, 2, None), (None, None, "c", 0, 3, None)]
    spark.createDataFrame(rows, MESSAGE).write.parquet(folder + "/m")
    found = read_messages(spark, ["a", "b"], path=folder + "/m")
    assert sorted(bytes(r["value"]) for r in found.collect()) == [b"v", b"w"]
    assert read_messages(spark, ["a"], path=folder + "/m", stream=True).isStreaming


def test_messages_need_one_place(spark):
    with pytest.raises(ValueError):
        read_messages(spark, ["a"])
    with pytest.raises(ValueError):
        read_messages(spark, ["a"], path="p", servers="s")
    with pytest.raises(ValueError):
        write_messages(spark.range(1))


@pytest.mark.parametrize("stream", [False, True])
def test_kafka_is_asked_for(spark, stream):
    """Without the connector the call gets as far as looking for it."""
    with pytest.raises(AnalysisException, match="kafka"):
        read_messages(spark, ["a"], servers="h:1", stream=stream, min_partitions=2, batch_offsets=5)


def test_kafka_settings():
    assert kafka_options("h:1", {"acks": "all"}) == {
        "kafka.bootstrap.servers": "h:1", "kafka.acks": "all", "kafka.retries": "0",
        "kafka.batch.size": "16384", "kafka.linger.ms": "1", "kafka.buffer.memory": "33554432",
    }


def test_landed_json(spark, folder):
    landed(spark, ("a/b", b"x", 1, True, datetime(2024, 1, 1)), ("c", b"y", 0, False, None)).write.json(folder + "/j")
    found = read_landed(spark, folder + "/j", ["a/#"], file_format="json").collect()
    assert [(r["topic"], bytes(r["payload"]), r["qos"], r["retained"]) for r in found] == [("a/b", b"x", 1, True)]


def test_lines(spark, folder):
    os.makedirs(f"{folder}/tree/deep/er")
    for name, text in [("a.txt", "1\n2\r\n3\r4\n"), ("deep/er/b_transaction.txt", "é\n\n"), ("deep/c.csv", "no\n")]:
        with open(f"{folder}/tree/{name}", "w", encoding="utf-8", newline="") as out:
            out.write(text)
    texts = read_lines(spark, f"{folder}/tree", name_glob="*.txt", recursive=True)
    assert bag(texts) == [("",), ("1",), ("2",), ("3",), ("4",), ("é",)]
    named = read_lines(spark, f"{folder}/tree", name_glob="*transaction*", recursive=True)
    assert bag(named) == [("",), ("é",)]
    assert bag(read_lines(spark, f"{folder}/tree/a.txt")) == [("1",), ("2",), ("3",), ("4",)]


def test_archive(spark, folder):
    os.makedirs(f"{folder}/in")
    log = BatchLog(spark, f"{folder}/sent", SENT)
    for i in range(3):
        with open(f"{folder}/in/{i}.txt", "w", encoding="utf-8") as out:
            out.write("x\n")
        lines = read_lines(spark, f"{folder}/in", stream=True, archive=f"{folder}/done")
        finish(feed_vehicles(lines, f"{folder}/checkpoint", "t", log=log, every=None))
    assert log.read().count() == 3
    moved = [name for _, _, names in os.walk(f"{folder}/done") for name in names if name.endswith(".txt")]
    assert "0.txt" in moved and not os.path.exists(f"{folder}/in/0.txt")
    with pytest.raises(ValueError):
        read_lines(spark, folder, archive="x")


def test_console(spark, folder):
    stream = table_stream(spark, SF_DIR, "events").select("event_id")
    query = start_console(stream, f"{folder}/checkpoint")
    finish(query)
    assert query.exception() is None
    assert query.lastProgress["numInputRows"] == 1000


# --- messages

def test_bridges(spark):
    rows = landed(spark, ("a/b", b"x\xff", 0, False, datetime(2024, 1, 1)))
    assert bag(bridge(rows)) == [("a/b", None, "x\ufffd")]
    assert bag(enveloped_bridge(rows, F.timestamp_millis(F.lit(5)))) == [
        ("a.b", None, '{"payload":"x\ufffd","timestamp":"5"}')]
    assert bag(replay_bridge(rows, "t", 3)) == [("t", str(i), "x\ufffd") for i in range(3)]
    assert bag(replay_bridge(rows, "t", 3, tasks=2)) == bag(replay_bridge(rows, "t", 3))
    assert replay_bridge(rows, "t").count() == 1000


def test_envelope_of_now(spark):
    rows = landed(spark, ("a", b"x", 0, False, None)).withColumn("payload", F.lit("x"))
    assert '"payload":"x"' in rows.transform(with_envelope).first()["payload"]


def test_header_and_topic(spark):
    rows = spark.createDataFrame([("a/b",)], "topic string")
    assert bag(with_header(rows, "h", "upper(topic)")) == [("a/b", "A/B")]
    assert bag(to_topic(rows, "t")) == [("t",)]


def test_no_copies(spark):
    with pytest.raises(ValueError):
        fan_out(spark.range(1), 0)


def test_retained(spark):
    at, then = datetime(2024, 1, 1), datetime(2024, 1, 2)
    rows = spark.createDataFrame(
        [("a", "1", 0, True, at, 1), ("a", "2", 1, True, at, 2), ("a", "3", 0, False, then, 3),
         ("cleared", "x", 0, True, at, 1), ("cleared", "", 0, True, then, 2), ("never", "x", 0, False, at, 1)],
        "topic string, payload string, qos int, retained boolean, ts timestamp, seq int")
    assert bag(retained(rows, "ts", "seq")) == [("a", "2", 1)]


def test_counter_lines_and_top(spark):
    counts = spark.createDataFrame([("b", 2), ("a", 2), ("", 1)], "word string, n bigint")
    assert bag(counter_lines(counts)) == [("Counter:,1",), ("Counter:a,2",), ("Counter:b,2",)]
    assert [r["word"] for r in top_words(counts, 2).collect()] == ["a", "b"]


# --- vehicles

def test_vehicle_message(spark):
    lines = spark.createDataFrame([(0, "x y"), (1, ""), (5, "z")], "i bigint, value string")
    at = F.lit(datetime(2024, 1, 1, 3, 4, 5))
    found = {r["i"]: r for r in vehicle_messages(lines, at, F.col("i")).collect()}
    assert found[0]["message"] == f"{VINS[0]} x y03:04:05"
    assert found[1]["message"] == f"{VINS[1]} 03:04:05"
    assert found[5]["vin"] == VINS[2]
    assert found[5]["topic"] == VINS[2][-3:] == "458"
    with pytest.raises(ValueError):
        vehicle_messages(lines, at, F.col("i"), turns=8)


def test_vehicle_feed(spark, folder):
    log = BatchLog(spark, f"{folder}/sent", SENT)
    for text in ("a\nb\n", "c\n"):
        os.makedirs(f"{folder}/in", exist_ok=True)
        with open(f"{folder}/in/{len(os.listdir(f'{folder}/in'))}.txt", "w", encoding="utf-8") as out:
            out.write(text)
        lines = read_lines(spark, f"{folder}/in", stream=True)
        finish(feed_vehicles(lines, f"{folder}/checkpoint", "t", log=log, every=None))
    found = {r["value"][18:-8]: (r["batch_id"], r["value"][:17], r["value"][-8:]) for r in log.read().collect()}
    assert {line: part[:2] for line, part in found.items()} == {"a": (0, VINS[0]), "b": (0, VINS[0]), "c": (1, VINS[1])}
    assert found["a"][2] == found["b"][2]
