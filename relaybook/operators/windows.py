"""Counts per event-time window."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Windows are laid out in chunks of this many, so that no task builds one long array.
GRID_CHUNK = 4096


def interval(length: timedelta) -> str:
    """The length as Spark writes it, for example ``"3600000 milliseconds"``."""
    millis, rest = divmod(length, timedelta(milliseconds=1))
    if rest or millis <= 0:
        raise ValueError("windows must last a whole number of milliseconds, at least one")
    return f"{millis} milliseconds"


def windowed_count(
    rows: DataFrame,
    ts: str,
    width: timedelta,
    slide: timedelta | None = None,
    *,
    keys: tuple[str, ...] = (),
    late: timedelta | None = None,
) -> DataFrame:
    """Rows ``n`` per window and key, for tables and streams.

    ``late`` sets a watermark, which a stream needs to close windows and forget them; its time
    column must then be a ``timestamp``.
    """
    window = F.window(ts, interval(width), interval(slide or width))
    if late is None:
        return rows.groupBy(window["start"].alias("window_start"), *keys).agg(F.count("*").alias("n"))
    # Only a group by the whole window keeps the watermark.
    seen = rows.withWatermark(ts, interval(late)).groupBy(window.alias("window"), *keys)
    counted = seen.agg(F.count("*").alias("n"))
    return counted.select(F.col("window.start").alias("window_start"), *keys, "n")


def sliding_count(
    rows: DataFrame,
    ts: str,
    width: timedelta,
    slide: timedelta,
    *,
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """Sliding windows over a table, through tumbling counts as long as one slide.

    Each row is counted once; only the far fewer tumbling counts are copied into the windows
    that hold them, where a plain sliding window copies every row.
    """
    if width % slide:
        return windowed_count(rows, ts, width, slide, keys=keys)
    slices = windowed_count(rows, ts, slide, keys=keys).withColumnRenamed("n", "slice_n")
    step = F.expr(f"interval {interval(slide)}")
    back = F.explode(F.sequence(F.lit(0), F.lit(width // slide - 1)))
    copies = slices.select("window_start", *keys, "slice_n", back.alias("back"))
    started = (F.col("window_start") - F.col("back") * step).alias("window_start")
    return copies.groupBy(started, *keys).agg(F.sum("slice_n").alias("n"))


def fill_windows(counts: DataFrame, width: timedelta) -> DataFrame:
    """Add the windows without rows, as 0, between the first and the last counted window.

    Expects ``window_start`` and ``n`` of tumbling windows.
    """
    step = F.expr(f"interval {interval(width)}")
    chunk = F.expr(f"interval {interval(width * GRID_CHUNK)}")
    # Taking the ends from the same columns as the union lets both share one scan and shuffle.
    pair = F.struct("window_start", "n")
    ends = counts.agg(F.min(pair).alias("low"), F.max(pair).alias("high")).select(
        F.col("low.window_start").alias("first"), F.col("high.window_start").alias("last")
    )
    chunks = ends.where(F.col("first").isNotNull()).select(
        "last", F.explode(F.sequence("first", "last", chunk)).alias("chunk_start")
    )
    chunk_end = F.least(F.col("last"), F.col("chunk_start") + chunk - step)
    grid = chunks.repartition("chunk_start").select(
        F.explode(F.sequence("chunk_start", chunk_end, step)).alias("window_start"),
        F.lit(0).cast("bigint").alias("n"),
    )
    together = counts.select("window_start", "n").unionByName(grid)
    return together.groupBy("window_start").agg(F.sum("n").alias("n"))


def first_of_each(
    counts: DataFrame, batch: str = "window_start", limit: int = 10
) -> DataFrame:
    """The ``limit`` most frequent words of every batch, cut down inside each task first."""
    order = Window.partitionBy(batch).orderBy(F.desc("n"), "word")
    ranked = counts.withColumn("place", F.row_number().over(order))
    return ranked.where(F.col("place") <= limit)
