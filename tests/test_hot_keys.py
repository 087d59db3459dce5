"""A third of all rows under one key, against plain loops over the same rows."""

import collections
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from relaybook.functions import text_bytes
from relaybook.operators.cells import get_row, latest_cells, read_cells, recreate_cells
from relaybook.operators.messages import retained
from relaybook.operators.placement import place
from relaybook.operators.windows import first_of_each, sliding_count, windowed_count
from relaybook.operators.words import word_count
from relaybook.streaming.counters import Counters, wide_rows

N = 30_000
START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def rows(spark):
    """Row i: key ``hot`` for every third, else one of 1000; time i seconds; word of the key."""
    i = F.col("id")
    key = F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (i * 7 % 1000).cast("string")))
    ts = F.timestamp_seconds(F.lit(1704067200) + i)
    made = spark.range(N).select(i, key.alias("key"), ts.alias("ts"), (i % 13).alias("n"))
    return made.withColumn("text", F.concat("key", F.lit(" hot x"), F.col("n").cast("string")))


def keys():
    return ["hot" if i % 3 == 0 else f"k{i * 7 % 1000}" for i in range(N)]


def test_words(rows):
    expected = collections.Counter()
    for i, key in enumerate(keys()):
        expected.update([key, "hot", f"x{i % 13}"])
    assert {r["word"]: r["n"] for r in word_count(rows, text="text").collect()} == expected


def test_cells(spark, rows, folder):
    cells = rows.select(
        "key", F.lit("f").alias("family"), F.col("n").cast("string").alias("qualifier"),
        text_bytes(F.col("id").cast("string")).alias("value"), F.date_trunc("day", "ts").alias("ts"),
        F.col("id").alias("seq"),
    ).withColumnRenamed("key", "row_key")
    expected = {(key, str(i % 13)): str(i) for i, key in enumerate(keys())}
    found = latest_cells(cells).collect()
    assert {(r["row_key"], r["qualifier"]): r["value"].decode() for r in found} == expected
    recreate_cells(cells, folder + "/c")
    hot = get_row(read_cells(spark, folder + "/c"), "hot").collect()
    assert {r["qualifier"]: r["value"] for r in hot} == {q: v for (k, q), v in expected.items() if k == "hot"}


def test_retained(rows):
    messages = rows.select(
        F.col("key").alias("topic"), F.col("id").cast("string").alias("payload"), F.lit(0).alias("qos"),
        F.lit(True).alias("retained"), "ts",
    )
    expected = {key: str(i) for i, key in enumerate(keys())}
    assert {r["topic"]: r["payload"] for r in retained(messages).collect()} == expected


def test_counters(spark, rows, folder):
    counters = Counters(spark, folder)
    increments = rows.select(
        F.col("key").alias("row_key"), (F.col("id") % 300).cast("string").alias("qualifier"),
        F.col("n").alias("delta"),
    )
    expected = collections.Counter()
    for i, key in enumerate(keys()):
        expected[key, str(i % 300)] += i % 13
    for batch in range(2):
        counters.add(increments, batch, "w")
    totals = counters.totals()
    assert {(r["row_key"], r["qualifier"]): r["value"] for r in totals.collect()} == {
        cell: 2 * value for cell, value in expected.items()}
    parts = wide_rows(totals, most=100).collect()
    opened = [((p["row_key"], q), v) for p in parts for q, v in p["cells"].items()]
    assert len(opened) == len(expected) and dict(opened) == {c: 2 * v for c, v in expected.items()}
    hot = sum(key == "hot" for key, _ in expected)
    assert sum(p["row_key"] == "hot" for p in parts) == -(-hot // 100) and max(len(p["cells"]) for p in parts) <= 100


def test_windows(rows):
    width, slide = timedelta(minutes=30), timedelta(minutes=10)
    expected = collections.Counter()
    for i, key in enumerate(keys()):
        for back in range(3):
            expected[START + timedelta(minutes=10 * (i // 600 - back)), key] += 1
    timed = rows.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    found = sliding_count(timed, "ts", width, slide, keys=("key",)).collect()
    assert {(r["window_start"], r["key"]): r["n"] for r in found} == expected
    counts = windowed_count(timed, "ts", timedelta(hours=1), keys=("key",))
    first = first_of_each(counts.withColumnRenamed("key", "word"), limit=1).collect()
    assert len(first) == 9 and {r["word"] for r in first} == {"hot"}


def test_placement(rows):
    numbered = rows.select("id", F.when(F.col("key") == "hot", 1).otherwise(F.col("n") % 4).cast("int").alias("partition"))
    spots = place(numbered, 4, splits=8, salt="id").groupBy(F.spark_partition_id().alias("at"), "partition").count().collect()
    assert sum(r["count"] for r in spots) == N
    assert all(r["at"] // 8 == r["partition"] for r in spots)
    hot = [r["count"] for r in spots if r["partition"] == 1]
    assert len(hot) == 8 and max(hot) < 2 * min(hot)
