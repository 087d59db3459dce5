"""Subscriptions, committed positions, resent messages, triggers, row parts, point reads and slices."""

import json
import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from relaybook.functions import topic_matches
from relaybook.operators.cells import get_row, put_cells, read_cells
from relaybook.operators.subscriptions import invalid_filters, matching_filters, subscribed
from relaybook.schemas import CELL, DOCUMENT, MESSAGE, TOTAL
from relaybook.sources.messages import read_files
from relaybook.sources.tables import read_jdbc, slice_predicates, split_misfits
from relaybook.streaming.counters import wide_rows
from relaybook.streaming.ledger import RANGE, Ledger, available, kafka_offsets, within, without
from relaybook.streaming.resend import message_ids, once
from relaybook.streaming.runs import each_batch, finish
from relaybook.streaming.triggers import TriggerLog, trigger_counts

START = datetime(2024, 1, 1)


def matches(topic, name):
    """What the protocol says, level by level."""
    levels, wanted = topic.split("/"), name.split("/")
    if topic.startswith("$") and wanted[0] in ("#", "+"):
        return False
    for at, want in enumerate(wanted):
        if want == "#":
            return True
        if at >= len(levels) or want not in ("+", levels[at]):
            return False
    return len(levels) == len(wanted)


def test_filters_against_plain(spark):
    pick, names = random.Random(3), ["a", "b", "", "+", "$x", "c.d", "(", "*"]
    topics = {"/".join(pick.choice(names[:3] + names[4:]) for _ in range(pick.randint(1, 8))) for _ in range(120)}
    topics |= {"$SYS/a", "a", "", "a+b", "+", "a/#", "a\nb"}
    filters = {"/".join(pick.choice(names) for _ in range(pick.randint(1, 8))) for _ in range(400)}
    filters |= {f + "/#" for f in list(filters)[:150]} | {"#", "+", "+/#", "$SYS/#", "$SYS/+", "a/#", "a"}
    filters.discard("")
    wrong = ["", "a#", "#/a", "a/+b", "a/#/b", None]
    t = spark.createDataFrame([(x,) for x in [*topics, None, "a"]], "topic string")
    f = spark.createDataFrame([(x,) for x in [*filters, *wrong, "a"]], "filter string")
    found = {(r["topic"], r["filter"]) for r in matching_filters(t, f).collect()}
    assert found == {(topic, name) for topic in topics for name in filters if matches(topic, name)}
    assert sorted(map(str, (r["filter"] for r in invalid_filters(f).collect()))) == sorted(map(str, wrong))
    few = sorted(filters)[:40]
    one = {r["topic"] for r in t.where(topic_matches(F.col("topic"), few)).collect()}
    assert one == {topic for topic, name in found if name in few}


def test_many_filters_make_no_larger_plan(spark):
    sizes = []
    for n in (50, 5000):
        topics = spark.range(200).select(F.concat(F.lit("d/"), (F.col("id") % 7).cast("string"), F.lit("/"), F.col("id").cast("string")).alias("topic"))
        filters = spark.range(n).select(F.when(F.col("id") % 2 == 0, F.concat(F.lit("d/+/"), F.col("id").cast("string")))
                                        .otherwise(F.concat(F.lit("d/"), F.col("id").cast("string"), F.lit("/#"))).alias("filter"))
        found = matching_filters(topics, filters)
        sizes.append(len(found._jdf.queryExecution().analyzed().toString().splitlines()))
        assert found.count() == sum(f"d/+/{i}" in {f"d/+/{j}" for j in range(0, n, 2)} for i in range(200)) + sum(
            i % 7 % 2 == 1 and i % 7 < n for i in range(200))
    assert sizes[0] == sizes[1]


def test_messages_with_their_subscriptions(spark):
    messages = spark.createDataFrame([("a/b", 1), ("a/b", 2), ("c", 3), (None, 4)], "topic string, n int")
    subscriptions = spark.createDataFrame([("x", "a/+"), ("y", "#"), ("x", "a/+"), ("z", None)], "client string, filter string")
    found = sorted((r["n"], r["client"]) for r in subscribed(messages, subscriptions).collect())
    assert found == [(1, "x"), (1, "x"), (1, "y"), (2, "x"), (2, "x"), (2, "y"), (3, "y")]
    assert subscribed(messages, subscriptions.limit(0)).count() == subscribed(messages.limit(0), subscriptions).count() == 0
    with pytest.raises(ValueError):
        subscribed(messages, subscriptions.withColumn("N", F.lit(1)))


def ranges(spark, *rows):
    return spark.createDataFrame([("t", *r) for r in rows], RANGE)


def listed(found):
    return sorted((r["partition"], r["first"], r["until"]) for r in found.collect())


def test_ranges_against_sets(spark):
    pick = random.Random(5)
    for _ in range(4):
        wanted, taken = ([(p, a, a + pick.randint(0, 9)) for p in range(3) for a in [pick.randint(0, 40) for _ in range(5)]]
                         for _ in range(2))
        left = {(p, n) for p, a, b in wanted for n in range(a, b)} - {(p, n) for p, a, b in taken for n in range(a, b)}
        found = listed(without(ranges(spark, *wanted), ranges(spark, *taken)))
        assert [(p, n) for p, a, b in found for n in range(a, b)] == sorted(left)
        assert all(b < c or p != q for (p, _, b), (q, c, _) in zip(found, found[1:], strict=False))


def test_ledger(spark, folder):
    ledger = Ledger(spark, folder, "c")
    assert listed(ledger.committed()) == [] and listed(ledger.pending(ranges(spark, (0, 5, 9)))) == [(0, 5, 9)]
    ledger.commit(ranges(spark, (0, 0, 5), (1, 0, 3)))
    ledger.commit(ranges(spark, (0, 8, 10), (1, 3, 7), (2, 4, 4)))
    assert listed(ledger.committed()) == [(0, 0, 5), (0, 8, 10), (1, 0, 7)]
    assert listed(ledger.gaps()) == [(0, 5, 8)]
    for wrong in ([(0, 4, 6)], [(1, 9, 12), (1, 11, 13)]):
        with pytest.raises(ValueError):
            ledger.commit(ranges(spark, *wrong))
    assert listed(Ledger(spark, folder, "c").committed()) == [(0, 0, 5), (0, 8, 10), (1, 0, 7)]
    assert listed(Ledger(spark, folder, "d").committed()) == []
    assert listed(ledger.pending(ranges(spark, (0, 0, 12), (3, 1, 2)))) == [(0, 5, 8), (0, 10, 12), (3, 1, 2)]
    starts, ends = kafka_offsets(ranges(spark, (0, 5, 8), (0, 10, 12), (1, 7, 9)))
    assert (json.loads(starts), json.loads(ends)) == ({"t": {"0": 5, "1": 7}}, {"t": {"0": 12, "1": 9}})


def test_each_message_is_consumed_once(spark, folder):
    ledger, seen = Ledger(spark, folder, "c"), []

    def messages(*offsets):
        made = [(None, b"v", "t", p, n, START) for p, n in offsets]
        return spark.createDataFrame(made, MESSAGE)

    def take(read):
        seen.append(sorted((r["partition"], r["offset"]) for r in read.collect()))

    first, later = [(0, 0), (0, 1), (1, 5), (1, 9)], [(0, 2), (1, 10), (4, 0)]
    assert ledger.consume(messages(*first), take) == 1 and ledger.consume(messages(*first), take) is None
    with pytest.raises(ZeroDivisionError):
        ledger.consume(messages(*first, *later), lambda read: 1 / 0)
    assert ledger.consume(messages(*first, *later), take) == 2 and ledger.consume(messages(*first, *later), take) is None
    assert seen == [sorted(first), sorted(later)]
    assert within(messages(*first), available(messages((0, 1)))).count() == 1
    assert ledger.consume(messages(), take) is None


def test_a_resent_batch_counts_once_and_state_shrinks(spark, folder):
    schema, seen, sizes = "topic string, key string, value string, timestamp timestamp", [], []
    for turn in range(4):
        # Each batch is sent twice, the second time in the next one; time goes on by an hour a batch.
        rows = [("t", "k", f"{n}.{i}", START + timedelta(hours=n, seconds=i)) for n in (turn - 1, turn) if n >= 0 for i in range(50)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/landing")
        stream = read_files(spark, f"{folder}/landing", spark.createDataFrame([], schema).schema, stream=True)
        told = once(message_ids(stream, "value"), timedelta(hours=1, minutes=30))
        query = each_batch(told, lambda batch, _: seen.extend(r["value"] for r in batch.collect()), f"{folder}/checkpoint")
        finish(query)
        sizes.append(query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
    assert sorted(seen) == sorted(f"{n}.{i}" for n in range(4) for i in range(50))
    # Without the watermark all 200 keys would still be there.
    assert max(sizes) < 200 and sizes[-1] <= 150


def test_triggers_without_data_are_logged(spark, folder):
    schema = spark.createDataFrame([], "value string").schema
    with TriggerLog(spark, f"{folder}/triggers") as log:
        for rows in (3, 0, 5):
            if rows:
                spark.range(rows).selectExpr("cast(id as string) value").coalesce(1).write.mode("append").parquet(f"{folder}/landing")
            finish(each_batch(read_files(spark, f"{folder}/landing", schema, stream=True), lambda batch, _: batch.count(), f"{folder}/checkpoint"))
    assert [r["n"] for r in trigger_counts(log.read()).orderBy("trigger_no").collect()] == [3, 0, 5]


def test_an_idle_live_stream_is_logged(spark, folder):
    schema = spark.createDataFrame([], "value string").schema
    spark.range(4).selectExpr("cast(id as string) value").coalesce(1).write.parquet(f"{folder}/landing")
    spark.conf.set("spark.sql.streaming.noDataProgressEventInterval", "100")
    try:
        with TriggerLog(spark, f"{folder}/triggers") as log:
            query = each_batch(read_files(spark, f"{folder}/landing", schema, stream=True), lambda batch, _: batch.count(),
                               f"{folder}/checkpoint", every="200 milliseconds")
            # Idle events come by the clock, so the test waits for one, 30 seconds at most.
            until = time.monotonic() + 30
            while time.monotonic() < until and not any(e[3] is None for e in log._events):
                time.sleep(0.1)
            query.stop()
            query.awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.noDataProgressEventInterval")
    found = [r["n"] for r in trigger_counts(log.read()).orderBy("trigger_no").collect()]
    assert found[0] == 4 and len(found) > 1 and set(found[1:]) == {0}


def test_parts_of_a_wide_row_are_bounded(spark):
    totals = spark.range(2_000_000).select(
        F.lit("hot").alias("row_key"), F.concat(F.lit("q"), F.col("id").cast("string")).alias("qualifier"), F.col("id").alias("value")
    ).unionAll(spark.createDataFrame([("small", "a", 1), ("small", "b", 2), (None, "c", 3)], TOTAL))
    parts = wide_rows(totals, most=50_000).select("row_key", "part", F.size("cells").alias("n"), F.map_keys("cells").alias("k"))
    found = parts.select("row_key", "part", "n").collect()
    hot = sorted((r["part"], r["n"]) for r in found if r["row_key"] == "hot")
    assert hot == [(n, 50_000) for n in range(40)]
    assert sorted((str(r["row_key"]), r["part"], r["n"]) for r in found if r["row_key"] != "hot") == [("None", 0, 1), ("small", 0, 2)]
    assert parts.where("row_key = 'hot'").select(F.explode("k").alias("k")).distinct().count() == 2_000_000
    assert wide_rows(totals.limit(0)).count() == 0
    with pytest.raises(ValueError):
        wide_rows(totals, most=0)


def scanned(df):
    """The rows that the scan of a collected result gave."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "Adaptive" in plan.getClass().getName() else plan
    todo = [plan]
    while todo:
        node = todo.pop()
        if "FileSourceScan" in node.getClass().getName():
            return node.metrics().apply("numOutputRows").value()
        if "QueryStage" in node.getClass().getName():
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]


def test_a_point_read_skips_files_by_their_bloom_filters(spark, folder):
    """Every file holds keys from low to high, so only the filter tells that the key is not there."""
    def cells(file):
        return spark.range(2000).select(
            F.concat(F.lit("k"), F.lpad((F.col("id") * 8 + file).cast("string"), 6, "0")).alias("row_key"), F.lit("f").alias("family"),
            F.lit("q").alias("qualifier"), F.lit(b"v").alias("value"), F.lit(START).alias("ts"), F.col("id").alias("seq"))

    read = {}
    for name, keys in (("with", 2000), ("without", None)):
        for file in range(8):
            put_cells(cells(file).coalesce(1), f"{folder}/{name}", row_keys=keys)
        found = get_row(read_cells(spark, f"{folder}/{name}"), "k008003")
        assert [r["value"] for r in found.collect()] == ["v"]
        read[name] = scanned(found)
    assert read["without"] == 16_000 and read["with"] <= 4000


@pytest.mark.parametrize("keys", [[7] * 900 + list(range(100)), list(range(1000)), [1], [None] * 5 + [3, 4], []])
def test_slices_hold_every_row_once(spark, keys):
    rows = spark.createDataFrame([(k,) for k in keys], "k int")
    conditions = slice_predicates(rows, "k", 8)
    everything = rows.unionAll(spark.createDataFrame([(-10**6,), (10**6,), (None,)], "k int"))
    counts = [everything.where(F.expr(c)).count() for c in conditions]
    assert sum(counts) == len(keys) + 3 and len(conditions) <= 8
    held = everything.select(sum([F.coalesce(F.expr(c), F.lit(False)).cast("int") for c in conditions], F.lit(0)).alias("n"))
    assert {r["n"] for r in held.collect()} == {1}
    if keys == list(range(1000)):
        assert max(counts) <= 2 * 1000 / 8


def test_slices_of_dates_and_arguments(spark):
    rows = spark.sql("select date_add(date'2024-01-01', cast(id as int)) d from range(100)")
    conditions = slice_predicates(rows, "d", 4)
    assert len(conditions) == 4 and sum(rows.where(F.expr(c)).count() for c in conditions) == 100
    with pytest.raises(ValueError):
        slice_predicates(rows, "d", 0)
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:none", "t", split_on="d", predicates=conditions)


def test_misfits_are_told_apart(spark):
    rows = spark.createDataFrame([("1", "t", "a", "x", "2000"), ("one", "t", "a", "x", "year"), (None, None, None, None, None),
                                  ("2", "t", "a", "x", None)], "a string, a2 string, a3 string, a4 string, a5 string")
    fitting, rejected = split_misfits(rows, DOCUMENT)
    assert [(r["id"], r["year"]) for r in fitting.collect()] == [(1, 2000), (None, None), (2, None)]
    assert [(r["id"], r["misfits"]) for r in rejected.collect()] == [("one", ["id", "year"])]
    assert fitting.schema.fieldNames() == DOCUMENT.fieldNames()
    with pytest.raises(ValueError):
        split_misfits(rows.select("a"), DOCUMENT)
