from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from relaybook.operators import windows
from relaybook.operators.windows import fill_windows, interval, sliding_count, windowed_count

SECOND = timedelta(seconds=1)
HOUR = timedelta(hours=1)


def stamps(spark, *seconds):
    start = datetime(2024, 1, 1)
    rows = [(start + timedelta(seconds=s), f"w{int(s) % 2}") for s in seconds]
    return spark.createDataFrame(rows, "ts timestamp_ntz, word string")


def found(df):
    return {tuple(r) for r in df.collect()}


def test_batches_of_two_seconds(spark):
    counts = windowed_count(stamps(spark, 0, 1.9, 2, 7), "ts", 2 * SECOND)
    starts = {(r["window_start"] - datetime(2024, 1, 1)).seconds: r["n"] for r in counts.collect()}
    assert starts == {0: 2, 2: 1, 6: 1}


def test_empty_windows_read_zero(spark):
    filled = fill_windows(windowed_count(stamps(spark, 0, 7), "ts", 2 * SECOND), 2 * SECOND)
    starts = {(r["window_start"] - datetime(2024, 1, 1)).seconds: r["n"] for r in filled.collect()}
    assert starts == {0: 1, 2: 0, 4: 0, 6: 1}


def test_fill_nothing(spark):
    counts = windowed_count(stamps(spark, 0).where("false"), "ts", HOUR)
    assert fill_windows(counts, HOUR).collect() == []


def test_fill_one_window(spark):
    assert fill_windows(windowed_count(stamps(spark, 5), "ts", HOUR), HOUR).count() == 1


@pytest.mark.parametrize("chunk", [1, 2, 3, 4, 5])
def test_fill_in_chunks(spark, monkeypatch, chunk):
    monkeypatch.setattr(windows, "GRID_CHUNK", chunk)
    filled = fill_windows(windowed_count(stamps(spark, 0, 9, 9), "ts", SECOND), SECOND)
    assert sorted((r["window_start"].second, r["n"]) for r in filled.collect()) == [
        (s, {0: 1, 9: 2}.get(s, 0)) for s in range(10)]


def test_fill_many(spark):
    filled = fill_windows(windowed_count(stamps(spark, 0, 20000), "ts", SECOND), SECOND)
    assert filled.count() == 20001
    assert filled.agg(F.sum("n")).first()[0] == 2


@pytest.mark.parametrize("width, slide", [(3, 1), (4, 2), (1, 1), (3, 2), (5, 2)])
def test_sliding_equals_plain_sliding(spark, width, slide):
    rows = stamps(spark, 0, 0.5, 1, 2, 2, 3.25, 9, 30)
    plain = windowed_count(rows, "ts", width * SECOND, slide * SECOND, keys=("word",))
    fast = sliding_count(rows, "ts", width * SECOND, slide * SECOND, keys=("word",))
    assert found(fast) == found(plain)
    assert fast.dtypes == plain.dtypes


def test_null_times_are_in_no_window(spark):
    rows = stamps(spark, 0).unionByName(
        spark.createDataFrame([(None, "w")], "ts timestamp_ntz, word string"))
    assert windowed_count(rows, "ts", HOUR).count() == 1


def test_interval():
    assert interval(timedelta(hours=1)) == "3600000 milliseconds"
    for bad in (timedelta(0), timedelta(seconds=-1), timedelta(microseconds=1)):
        with pytest.raises(ValueError):
            interval(bad)
