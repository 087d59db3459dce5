"""Tables of last rows, totals from state, retained messages, and windows with late rows, against plain Python."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from relaybook.plans.closing import ClosingWindows, close_windows
from relaybook.plans.counting import (
    cells_table,
    fold_totals,
    folded_totals,
    read_state_totals,
    state_totals,
    totals_table,
)
from relaybook.plans.retaining import keep_retained, kept_messages, kept_table
from relaybook.schemas import CELL, INCREMENT, KEPT
from relaybook.sources.messages import read_files
from relaybook.streaming.folded import FoldedTable
from relaybook.streaming.runs import finish

START = datetime(2024, 1, 1)


def cells(spark, *rows):
    made = [(k, "f", q, v.encode(), START + timedelta(seconds=ts), seq) for k, q, v, ts, seq in rows]
    return spark.createDataFrame(made, CELL)


def held(table):
    return {(r["row_key"], r["qualifier"]): r["value"].decode() for r in table.read().collect()}


def test_fifty_batches_list_as_many_files_as_five(spark, folder):
    pick, expected = random.Random(1), {}
    kept = cells_table(spark, folder, ("ts", "seq"), buckets=4)
    files = {}
    for batch in range(50):
        rows = [(f"r{pick.randrange(3)}", f"q{pick.randrange(20)}", f"{batch}.{n}", pick.randrange(100), 1000 * batch + n)
                for n in range(6)]
        for k, q, v, ts, seq in rows:
            expected[k, q] = max(expected.get((k, q), ((-1, -1), "")), ((ts, seq), v))
        assert kept.upsert(cells(spark, *rows), batch, "w")
        files[batch] = kept.files()
    assert held(kept) == {key: v for key, (_, v) in expected.items()}
    assert files[49] == files[5] == 4
    # What is stored beside the buckets in use is bounded too: a few generations of them.
    assert len(kept._stored()) <= 4 * (kept.keep + 2)


def test_a_batch_is_merged_once_and_an_unfinished_one_replaced(spark, folder):
    kept = cells_table(spark, folder, buckets=2)
    assert kept.upsert(cells(spark, ("r", "a", "1", 0, 0), ("r", "b", "1", 0, 0)), 0, "w")
    assert not kept.upsert(cells(spark, ("r", "a", "x", 9, 9)), 0, "w")
    assert kept.upsert(cells(spark, ("r", "c", "1", 0, 0)), 0, "other")
    # A generation without its mark is not read.
    half = f"{folder}/data/generation=3"
    cells(spark, ("r", "a", "bad", 9, 9)).withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(half)
    assert held(kept) == {("r", "a"): "1", ("r", "b"): "1", ("r", "c"): "1"}
    assert kept.upsert(cells(spark, ("r", "a", "2", 1, 1)), 1, "w")
    assert held(kept) == {("r", "a"): "2", ("r", "b"): "1", ("r", "c"): "1"}
    assert held(cells_table(spark, folder, buckets=2)) == held(kept)
    with pytest.raises(ValueError):
        cells_table(spark, folder, buckets=3).read()


def test_a_reader_goes_on_while_batches_are_added(spark, folder):
    kept = cells_table(spark, folder, buckets=1, keep=2)
    kept.upsert(cells(spark, ("r", "a", "0", 0, 0)), 0, "w")
    reading = kept.read()
    kept.upsert(cells(spark, ("r", "a", "1", 1, 1)), 1, "w")
    kept.upsert(cells(spark, ("r", "a", "2", 2, 2)), 2, "w")
    assert [r["value"] for r in reading.collect()] == [b"0"]
    assert held(kept) == {("r", "a"): "2"}


def test_nulls_ties_and_empty_batches(spark, folder):
    kept = cells_table(spark, folder, buckets=3)
    assert kept.upsert(cells(spark).limit(0), 0, "w") and kept.read().count() == 0 and kept.files() == 0
    rows = spark.createDataFrame([(None, "f", None, b"x", None, None), (None, "f", None, b"y", START, 1),
                                  ("r", "f", "a", b"1", START, 1), ("r", "f", "a", b"2", START, 1)], CELL)
    kept.upsert(rows, 1, "w")
    assert {(r["row_key"], r["value"]) for r in kept.read().collect()} == {(None, b"y"), ("r", b"2")}
    with pytest.raises(ValueError):
        kept.upsert(rows, 2, "no/writer")


def test_only_touched_buckets_are_written(spark, folder):
    kept = FoldedTable(spark, folder, INCREMENT, ["row_key", "qualifier"], ["delta"], buckets=16)
    kept.upsert(spark.range(200).select(F.lit("r").alias("row_key"), F.col("id").cast("string").alias("qualifier"),
                                        F.lit(1).cast("long").alias("delta")), 0, "w")
    before = {path for _, _, path in kept._stored()}
    kept.upsert(spark.createDataFrame([("r", "7", 2)], INCREMENT), 1, "w")
    assert len({path for _, _, path in kept._stored()} - before) == 1
    assert kept.read().agg(F.sum("delta")).first()[0] == 201


def test_totals_of_the_state_after_a_restart(spark, folder):
    expected = {}
    kept = totals_table(spark, f"{folder}/kept", buckets=2)
    for turn, rows in enumerate([[("r", "a", 1), ("r", "b", 5)], [("r", "a", 10), ("s", "a", -3)], [("r", "b", 1)]]):
        spark.createDataFrame(rows, INCREMENT).coalesce(1).write.mode("append").parquet(f"{folder}/landing")
        for k, q, n in rows:
            expected[k, q] = expected.get((k, q), 0) + n
        finish(state_totals(read_files(spark, f"{folder}/landing", INCREMENT, stream=True), f"{folder}/state"))
        finish(fold_totals(read_files(spark, f"{folder}/landing", INCREMENT, stream=True), kept, f"{folder}/folded"))
        for found in (read_state_totals(spark, f"{folder}/state"), folded_totals(kept)):
            assert {(r["row_key"], r["qualifier"]): r["value"] for r in found.collect()} == expected, turn
    both = read_state_totals(spark, f"{folder}/state", f"{folder}/folded")
    assert {(r["row_key"], r["qualifier"]): r["value"] for r in both.collect()} == {k: 2 * n for k, n in expected.items()}


def test_a_cleared_topic_stays_cleared_until_a_later_message(spark, folder):
    kept = kept_table(spark, f"{folder}/kept", buckets=2)
    landed = [[("t", b"one", 1), ("u", b"u", 1)], [("t", b"", 5)], [("t", b"late", 3)], [("t", b"new", 6), ("u", None, 9)]]
    states = []
    schema = "topic string, payload binary, qos int, retained boolean, ts timestamp, seq long"
    for turn, rows in enumerate(landed):
        made = [(t, p, 0, True, START + timedelta(seconds=ts), ts) for t, p, ts in rows] + [("n", b"not kept", 0, False, START, 0)]
        spark.createDataFrame(made, schema).coalesce(1).write.mode("append").parquet(f"{folder}/landing")
        stream = read_files(spark, f"{folder}/landing", spark.createDataFrame([], schema).schema, stream=True)
        finish(keep_retained(stream, kept, f"{folder}/checkpoint"))
        states.append({r["topic"]: r["payload"] for r in kept_messages(kept).collect()})
        assert turn < 4
    assert states == [{"t": b"one", "u": b"u"}, {"u": b"u"}, {"u": b"u"}, {"t": b"new"}]
    assert kept.read().columns == KEPT.fieldNames()


def test_closed_and_open_windows_and_late_rows_hold_all_rows(spark, folder):
    schema = spark.createDataFrame([], "ts timestamp, n int").schema
    width, late = timedelta(seconds=10), timedelta(seconds=5)
    windows = ClosingWindows(spark, f"{folder}/windows", schema, "ts", width, late)
    pick, mark = random.Random(2), None
    counts, lates, total = {}, [], 0
    for turn in range(5):
        rows = [(START + timedelta(seconds=pick.randrange(20 * turn, 20 * turn + 60)), turn) for _ in range(40)]
        if turn == 3:
            rows.append((START, 3))
        for ts, n in rows:
            window = START + (ts - START) // width * width
            if mark and window + width <= mark:
                lates.append((ts, n))
            else:
                counts[window] = counts.get(window, 0) + 1
        newest = max(ts for ts, _ in rows) - late
        mark, total = max(newest, mark or newest), total + len(rows)
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/landing")
        finish(close_windows(read_files(spark, f"{folder}/landing", schema, stream=True), windows, f"{folder}/checkpoint"))
    writer = windows.marks.read().first()["writer_id"]
    windows.add(spark.createDataFrame(rows, schema), 4, writer)
    found = {r["window_start"]: (r["n"], r["closed"]) for r in windows.windows().collect()}
    assert found == {w: (n, w + width <= mark) for w, n in counts.items()}
    assert sorted(map(tuple, windows.late_rows.read().select("ts", "n").collect())) == sorted(lates) and lates
    assert sum(n for n, _ in found.values()) + len(lates) == total
