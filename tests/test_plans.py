"""The shape of physical plans: what reaches the scan, and what shuffles."""

import re

from relaybook.operators.cells import get_row, read_cells, recreate_cells
from relaybook.operators.messages import fan_out
from relaybook.operators.windows import fill_windows, windowed_count
from relaybook.operators.words import top_words, values, word_count
from relaybook.plans import bridge, enveloped_bridge
from relaybook.queries.fixtures import document_messages, landed_events, table
from relaybook.queries.windows import HOUR
from relaybook.sources import read_landed

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df) -> int:
    return len(re.findall(r"\bExchange ", plan(df)))


def test_word_count_shuffles_once_after_partial_counts(spark):
    counts = document_messages(table(spark, SF_DIR, "documents")).transform(values).transform(word_count)
    assert shuffles(counts) == 1
    assert "partial_count" in plan(counts).split("Exchange")[1]
    assert "ReadSchema: struct<text:string>" in plan(counts)
    assert "TakeOrderedAndProject" in plan(top_words(counts))


def test_bridges_do_not_shuffle(spark):
    rows = landed_events(table(spark, SF_DIR, "events"))
    for made in (bridge(rows), enveloped_bridge(rows), fan_out(rows)):
        assert shuffles(made) == 0


def test_filters_reach_the_scan(spark, folder):
    landed_events(table(spark, SF_DIR, "events")).write.parquet(folder + "/l")
    exact = plan(read_landed(spark, folder + "/l", ["a/b", "c"]))
    assert "PushedFilters: [In(topic, [a/b,c])]" in exact
    below = plan(read_landed(spark, folder + "/l", ["a/#", "b"]))
    assert "StringStartsWith(topic,a/)" in below and "In(topic, [a,b])" in below


def test_point_read_reaches_the_scan(spark, folder):
    recreate_cells(spark.createDataFrame([("r", "f", "q", b"1", None, 1)],
                   "row_key string, family string, qualifier string, value binary, ts timestamp, seq bigint"),
                   folder + "/c")
    assert "EqualTo(row_key,r)" in plan(get_row(read_cells(spark, folder + "/c"), "r"))


def test_filling_windows_reads_the_rows_once(spark):
    filled = fill_windows(windowed_count(table(spark, SF_DIR, "events"), "ts", HOUR), HOUR)
    filled.collect()
    final = plan(filled).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
    assert final.count("FileScan") == 1
