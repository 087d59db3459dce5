"""Cells ``(row_key, family, qualifier) -> value`` kept as versions; the last one written counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relaybook.functions import decode_text, int_bytes
from relaybook.schemas import CELL


def int_cells(
    rows: DataFrame, row_key: Column, qualifier: Column, number: Column, ts: Column, seq: Column,
    family: str = "f", encode: Callable[[Column], Column] = int_bytes,
) -> DataFrame:
    """Cells that hold a plain integer in four bytes; ``long_bytes`` makes it eight."""
    return rows.select(
        row_key.alias("row_key"), F.lit(family).alias("family"), qualifier.alias("qualifier"),
        encode(number).alias("value"), ts.alias("ts"), seq.alias("seq"),
    )


def put_cells(cells: DataFrame, path: str, row_keys: int | None = None) -> None:
    """Add versions; nothing already written is touched.

    ``row_keys`` is the number of different row keys that a file holds, about: files then carry a Bloom
    filter on the row key, and :func:`get_row` skips the parts of unsorted files that lack the key, which
    the least and greatest key of a part can not tell.
    """
    writer = cells.select(CELL.fieldNames()).write.mode("append")
    if row_keys is not None:
        writer = writer.option("parquet.bloom.filter.enabled#row_key", "true").option(
            "parquet.bloom.filter.expected.ndv#row_key", str(row_keys)
        )
    writer.parquet(path)


def recreate_cells(cells: DataFrame, path: str) -> None:
    """Drop the table and write it anew, sorted so that a point read skips most row groups.

    Version and sequence take part in the ranges, so one busy cell spreads over many tasks.
    """
    cell = ["row_key", "family", "qualifier"]
    spread = cells.select(CELL.fieldNames()).repartitionByRange(*cell, "ts", "seq")
    laid_out = spread.sortWithinPartitions(*cell)
    laid_out.write.mode("overwrite").parquet(path)


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CELL).parquet(path)


def latest_cells(cells: DataFrame, order: tuple[str, ...] = ("ts", "seq")) -> DataFrame:
    """The last version of each cell, by time and then by sequence.

    Cells of one writer are better ordered by sequence first: its clock may step back.
    """
    newest = F.max_by("value", F.struct(*order)).alias("value")
    cell = ["row_key", "family", "qualifier"]
    # Spark sorts to group here; with a number first it rarely has to compare the texts.
    return cells.groupBy(F.xxhash64(*cell).alias("hash"), *cell).agg(newest).drop("hash")


def get_row(cells: DataFrame, row_key: str) -> DataFrame:
    """All cells of one row as text; no rows if there is none. The key test reaches the scan."""
    found = latest_cells(cells.where(F.col("row_key") == row_key))
    return found.select("row_key", "family", "qualifier", decode_text(F.col("value")).alias("value"))
