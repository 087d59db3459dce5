from datetime import datetime

import pytest
from pyspark.sql import functions as F

from relaybook.operators.cells import (
    get_row,
    int_cells,
    latest_cells,
    put_cells,
    read_cells,
    recreate_cells,
)
from relaybook.operators.documents import document_lines
from relaybook.operators.placement import place, split_rejects
from relaybook.schemas import CELL, DOCUMENT
from relaybook.session import work_dir
from relaybook.sources import read_jdbc, read_table, typed_columns

AT, THEN = datetime(2024, 1, 1), datetime(2024, 1, 2)


def cells(spark, *rows):
    return spark.createDataFrame(list(rows), CELL)


def latest(df):
    return {(r["row_key"], r["family"], r["qualifier"]): bytes(r["value"]) for r in df.collect()}


def test_the_last_put_counts(spark, folder):
    put_cells(cells(spark, ("r", "f", "q", b"1", AT, 1), ("r", "f", "q", b"2", AT, 2)), folder + "/c")
    assert latest(latest_cells(read_cells(spark, folder + "/c"))) == {("r", "f", "q"): b"2"}
    put_cells(cells(spark, ("r", "f", "q", b"3", THEN, 0), ("r", "g", "q", b"x", AT, 0)), folder + "/c")
    assert latest(latest_cells(read_cells(spark, folder + "/c"))) == {
        ("r", "f", "q"): b"3", ("r", "g", "q"): b"x"}


def test_recreate(spark, folder):
    put_cells(cells(spark, ("old", "f", "q", b"1", THEN, 1)), folder + "/c")
    for _ in range(2):
        recreate_cells(cells(spark, ("Counter", "info", "id11", b"001", AT, 1)), folder + "/c")
    assert latest(read_cells(spark, folder + "/c")) == {("Counter", "info", "id11"): b"001"}
    assert read_cells(spark, folder + "/c").count() == 1


def test_get(spark, folder):
    recreate_cells(cells(spark, ("r", "f", "q", b"a\xff", AT, 1), ("s", "f", "q", b"no", AT, 1)), folder + "/c")
    table = read_cells(spark, folder + "/c")
    assert [tuple(r) for r in get_row(table, "r").collect()] == [("r", "f", "q", "a\ufffd")]
    assert get_row(table, "absent").collect() == []


def test_int_cells(spark):
    rows = spark.createDataFrame([("r", "q", -5)], "k string, q string, n int")
    made = int_cells(rows, F.col("k"), F.col("q"), F.col("n"), F.lit(AT), F.lit(1).cast("bigint"))
    assert latest(made) == {("r", "f", "q"): b"\xff\xff\xff\xfb"}
    assert made.columns == CELL.fieldNames()


def test_document_lines(spark):
    rows = spark.createDataFrame([(7, "t", "a", "x", 2001), (None, None, None, None, None)], DOCUMENT)
    assert [r["line"] for r in document_lines(rows).collect()] == [
        "id: 7\ttype: t\tauthors: a\ttitle: x\tyear:2001",
        "id: 0\ttype: null\tauthors: null\ttitle: null\tyear:0",
    ]


def test_columns_by_position(spark):
    rows = spark.createDataFrame([("1", "a", "b", "c", "no year", "more")], ["x", "x2", "x3", "x4", "x5", "x6"])
    assert [tuple(r) for r in typed_columns(rows, DOCUMENT).collect()] == [(1, "a", "b", "c", None)]
    with pytest.raises(ValueError):
        typed_columns(rows.select("x"), DOCUMENT)


def test_catalog_table(spark):
    spark.range(3).write.mode("overwrite").saveAsTable("three")
    assert read_table(spark, "three").count() == 3


def test_jdbc_arguments(spark):
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:x:", "t", partitions=4)
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:x:", "t", split_on="id", partitions=4)


@pytest.mark.parametrize("splits", [1, 3])
def test_place(spark, splits):
    numbered = spark.range(400).select("id", (F.col("id") % 5).cast("int").alias("partition"))
    placed = place(numbered, 5, splits=splits, salt="id").select("partition", F.spark_partition_id().alias("at"), "id")
    assert placed.rdd.getNumPartitions() == 5 * splits
    found = placed.collect()
    assert len(found) == 400
    assert all(r["at"] // splits == r["partition"] for r in found)
    assert len({r["at"] for r in found}) == 5 * splits


def test_place_needs_numbers_and_a_salt(spark):
    rows = spark.createDataFrame([(1, 0), (2, None)], "id int, partition int")
    with pytest.raises(Exception, match="no partition"):
        place(rows, 2).collect()
    with pytest.raises(ValueError):
        place(rows, 2, splits=2)


def test_wide_ids_keep_their_value_and_order(spark):
    rows = spark.createDataFrame([(3_000_000_000, "t", "a", "x", 2001), (7, "t", "a", "x", 2001)], DOCUMENT)
    lines = document_lines(typed_columns(rows, DOCUMENT).orderBy("id")).collect()
    assert [r["line"].split("\t")[0] for r in lines] == ["id: 7", "id: 3000000000"]


def test_rejects(spark):
    rows = spark.createDataFrame([(1, 0), (2, None)], "id int, partition int")
    good, bad = split_rejects(rows)
    assert [r["id"] for r in good.collect()] == [1]
    assert [r["id"] for r in bad.collect()] == [2]


def test_work_dir(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert work_dir(spark, "x").startswith(base)
    assert work_dir(spark, "x") != work_dir(spark, "x")
