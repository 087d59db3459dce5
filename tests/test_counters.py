import os
import random
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from relaybook.plans.counting import count_ones, keep_totals, last_totals, totals_log
from relaybook.schemas import INCREMENT
from relaybook.sources.messages import read_files
from relaybook.streaming.batchlog import BatchLog
from relaybook.streaming.counters import Counters, wide_rows
from relaybook.streaming.runs import finish


def increments(spark, *rows):
    return spark.createDataFrame(list(rows), INCREMENT)


def totals(counters):
    return {(r["row_key"], r["qualifier"]): r["value"] for r in counters.totals().collect()}


def land(spark, path, *rows):
    increments(spark, *rows).coalesce(1).write.mode("append").parquet(path)


def run(spark, counters, landing, checkpoint):
    stream = read_files(spark, landing, INCREMENT, stream=True)
    query = count_ones(stream, counters, checkpoint)
    finish(query)
    return query


def test_empty(spark, folder):
    counters = Counters(spark, folder)
    assert totals(counters) == {}
    counters.compact()
    counters.reset()
    assert totals(counters) == {}


def test_sums_within_and_across_batches(spark, folder):
    counters = Counters(spark, folder)
    assert counters.add(increments(spark, ("r", "a", 1), ("r", "a", 2), ("r", "b", 5)), 0, "w")
    assert counters.add(increments(spark, ("r", "a", -4), ("s", "a", 2**40)), 1, "w")
    assert totals(counters) == {("r", "a"): -1, ("r", "b"): 5, ("s", "a"): 2**40}


def test_a_batch_counts_once(spark, folder):
    counters = Counters(spark, folder)
    assert counters.add(increments(spark, ("r", "a", 1)), 0, "w")
    assert not counters.add(increments(spark, ("r", "a", 1)), 0, "w")
    assert counters.add(increments(spark, ("r", "a", 1)), 0, "other")
    assert totals(counters) == {("r", "a"): 2}


def test_an_unfinished_batch_is_not_seen_and_then_replaced(spark, folder):
    counters = Counters(spark, folder)
    counters.add(increments(spark, ("r", "a", 1)), 0, "w")
    half = f"{counters.root}/data/writer_id=w/batch_id=1"
    increments(spark, ("r", "a", 100)).write.parquet(half)
    assert totals(counters) == {("r", "a"): 1}
    counters.add(increments(spark, ("r", "a", 7)), 1, "w")
    assert totals(counters) == {("r", "a"): 8}


def test_tables_and_families_are_apart(spark, folder):
    Counters(spark, folder, "t", "f").add(increments(spark, ("r", "a", 1)), 0, "w")
    assert totals(Counters(spark, folder, "t", "g")) == {}
    assert totals(Counters(spark, folder, "u", "f")) == {}


def test_snapshot(spark, folder):
    counters = Counters(spark, folder)
    counters.add(increments(spark, ("r", "a", 1), ("r", "b", 1)), 0, "w")
    counters.compact()
    counters.add(increments(spark, ("r", "a", 10)), 1, "w")
    counters.add(increments(spark, ("r", "a", 100)), 0, "late")
    expected = {("r", "a"): 111, ("r", "b"): 1}
    assert totals(counters) == expected
    counters.compact()
    counters.compact()
    assert totals(counters) == expected
    assert counters.log.done({"w": 1, "late": 0}) == {}
    assert counters.log.done({"w": 0}) == {"w": [1], "late": [0]}
    assert not counters.add(increments(spark, ("r", "a", 10)), 1, "w")
    assert totals(counters) == expected


def test_a_late_batch_is_refused_after_compaction(spark, folder):
    counters = Counters(spark, folder)
    counters.add(increments(spark, ("r", "a", 1)), 5, "w")
    counters.compact(grace=timedelta())
    with pytest.raises(ValueError):
        counters.add(increments(spark, ("r", "a", 10)), 3, "w")
    assert not counters.add(increments(spark, ("r", "a", 1)), 5, "w")
    assert counters.add(increments(spark, ("r", "a", 100)), 6, "w")
    assert totals(counters) == {("r", "a"): 101}


def test_compaction_removes_what_it_covers(spark, folder):
    """What a reader lists after a compaction does not grow with the batches before it."""
    counters = Counters(spark, folder)
    for turn in range(3):
        for batch in range(4):
            counters.add(increments(spark, ("r", "a", 1)), 4 * turn + batch, "w")
        counters.compact(grace=timedelta())
        assert counters.log.done() == {}
        assert not list(Path(counters.root).glob("data/*/batch_id=*"))
        assert len(list(Path(counters.root).glob("snapshots/*/as_of=*"))) == 2
    assert totals(counters) == {("r", "a"): 12}
    counters.add(increments(spark, ("r", "a", 1)), 12, "w")
    counters.compact()
    assert counters.log.done({}) == {"w": [12]}
    assert totals(counters) == {("r", "a"): 13}


def test_totals_of_two_checkpoints(spark, folder):
    log = totals_log(spark, f"{folder}/totals")
    for name, delta in (("one", 12), ("two", 100)):
        land(spark, f"{folder}/{name}", ("r", "a", delta))
        stream = read_files(spark, f"{folder}/{name}", INCREMENT, stream=True)
        finish(keep_totals(stream, log, f"{folder}/checkpoint-{name}"))
    assert [r["value"] for r in last_totals(log).collect()] == [112]


def test_a_snapshot_without_its_last_step_is_not_used(spark, folder):
    counters = Counters(spark, folder)
    counters.add(increments(spark, ("r", "a", 1)), 0, "w")
    counters.totals().withColumn("value", F.lit(99).cast("bigint")).write.parquet(
        f"{counters.root}/snapshots/totals/as_of=1")
    assert totals(counters) == {("r", "a"): 1}
    counters.compact()
    assert totals(counters) == {("r", "a"): 1}


def test_reset(spark, folder):
    counters = Counters(spark, folder)
    counters.add(increments(spark, ("r", "a", 1)), 0, "w")
    counters.reset()
    assert totals(counters) == {}
    assert not counters.add(increments(spark, ("r", "a", 1)), 0, "w")
    counters.add(increments(spark, ("r", "a", 3)), 1, "w")
    assert totals(counters) == {("r", "a"): 3}


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_steps(spark, folder, seed):
    """Adding, repeating, compacting and resetting at random, against plain sums."""
    pick = random.Random(seed)
    counters, expected, batches = Counters(spark, folder), {}, {"v": [], "w": []}
    for _ in range(14):
        step = pick.choice(["add", "add", "add", "repeat", "compact", "reset"])
        writer = pick.choice("vw")
        if step == "add":
            rows = [("r", pick.choice("abc"), pick.randint(-3, 9)) for _ in range(3)]
            assert counters.add(increments(spark, *rows), len(batches[writer]), writer)
            batches[writer].append(rows)
            for row_key, qualifier, delta in rows:
                expected[row_key, qualifier] = expected.get((row_key, qualifier), 0) + delta
        elif step == "repeat" and batches[writer]:
            last = len(batches[writer]) - 1
            assert not counters.add(increments(spark, *batches[writer][last]), last, writer)
        elif step == "compact":
            counters.compact()
        elif step == "reset":
            counters.reset()
            expected = {}
    assert totals(counters) == expected


def test_lookup(spark, folder):
    counters = Counters(spark, folder)
    counters.add(increments(spark, ("r", "a", 4)), 0, "w")
    keys = spark.createDataFrame(
        [("r", "a"), ("r", "a"), ("r", "absent"), ("absent", "a")], "row_key string, qualifier string")
    found = {tuple(r) for r in counters.lookup(keys).collect()}
    assert found == {("r", "a", 4), ("r", "absent", 0), ("absent", "a", 0)}
    assert counters.lookup(keys).count() == 3


def test_wide_rows(spark):
    rows = [("r", f"q{i}", i) for i in range(200)] + [("s", "q", 1), ("s", "p", 2)]
    found = spark.createDataFrame(rows, "row_key string, qualifier string, value bigint")
    parts = wide_rows(found, most=30).collect()
    assert sorted((p["row_key"], p["part"], len(p["cells"])) for p in parts) == [
        *[("r", n, 30 if n < 6 else 20) for n in range(7)], ("s", 0, 2)]
    assert sorted((p["row_key"], q, v) for p in parts for q, v in p["cells"].items()) == sorted(rows)
    assert len(wide_rows(found).collect()) == 2
    with pytest.raises(ValueError):
        wide_rows(found, most=0)


def test_restart_and_lost_commit(spark, folder):
    counters = Counters(spark, f"{folder}/counters")
    land(spark, f"{folder}/landing", ("r", "a", 1), ("r", "b", 2))
    first = run(spark, counters, f"{folder}/landing", f"{folder}/checkpoint")
    land(spark, f"{folder}/landing", ("r", "a", 10))
    again = run(spark, counters, f"{folder}/landing", f"{folder}/checkpoint")
    assert first.id == again.id
    assert counters.log.done() == {first.id: [0, 1]}
    expected = {("r", "a"): 11, ("r", "b"): 2}
    assert totals(counters) == expected
    # As if the driver had died after the write and before the commit of batch 1.
    for name in ("1", ".1.crc"):
        os.remove(f"{folder}/checkpoint/commits/{name}")
    run(spark, counters, f"{folder}/landing", f"{folder}/checkpoint")
    assert totals(counters) == expected
    run(spark, counters, f"{folder}/landing", f"{folder}/checkpoint")
    assert totals(counters) == expected


def test_a_new_checkpoint_is_a_new_writer(spark, folder):
    counters = Counters(spark, f"{folder}/counters")
    land(spark, f"{folder}/landing", ("r", "a", 1))
    run(spark, counters, f"{folder}/landing", f"{folder}/checkpoint1")
    land(spark, f"{folder}/other", ("r", "a", 5))
    run(spark, counters, f"{folder}/other", f"{folder}/checkpoint2")
    assert totals(counters) == {("r", "a"): 6}
    assert len(counters.log.done()) == 2


def test_many_batches(spark, folder):
    counters = Counters(spark, f"{folder}/counters")
    for i in range(3):
        land(spark, f"{folder}/landing", ("r", "a", 10**i), ("r", f"q{i}", 1))
    stream = read_files(spark, f"{folder}/landing", INCREMENT, stream=True, batch_bytes=1)
    query = count_ones(stream, counters, f"{folder}/checkpoint")
    finish(query)
    assert counters.log.done() == {query.id: [0, 1, 2]}
    assert totals(counters) == {("r", "a"): 111, ("r", "q0"): 1, ("r", "q1"): 1, ("r", "q2"): 1}


def test_state_totals(spark, folder):
    log = totals_log(spark, f"{folder}/totals")
    for delta in (1, 10):
        land(spark, f"{folder}/landing", ("r", "a", delta), ("r", f"q{delta}", delta))
        stream = read_files(spark, f"{folder}/landing", INCREMENT, stream=True)
        finish(keep_totals(stream, log, f"{folder}/checkpoint"))
    found = {(r["row_key"], r["qualifier"]): r["value"] for r in last_totals(log).collect()}
    assert found == {("r", "a"): 11, ("r", "q1"): 1, ("r", "q10"): 10}


def test_a_writer_needs_a_name_outside_a_stream(spark, folder):
    log = BatchLog(spark, folder, INCREMENT)
    with pytest.raises(ValueError):
        log.add(increments(spark, ("r", "a", 1)), 0)
    with pytest.raises(ValueError):
        log.add(increments(spark, ("r", "a", 1)), 0, "../elsewhere")
