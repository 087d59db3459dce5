"""Rows into partitions chosen by an expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_rejects(rows: DataFrame, partition: str = "partition") -> tuple[DataFrame, DataFrame]:
    """Rows with a partition, and those whose key gave none."""
    return rows.where(F.col(partition).isNotNull()), rows.where(F.col(partition).isNull())


def place(
    rows: DataFrame, partitions: int, partition: Column | str = "partition", splits: int = 1,
    salt: Column | str | None = None,
) -> DataFrame:
    """Move each row to the Spark partition of its number.

    The Kafka sink needs no such move: it reads the ``partition`` column. With ``splits`` above 1,
    number ``p`` is spread over Spark partitions ``p * splits`` up to ``p * splits + splits - 1``
    by ``salt``, so that one busy number does not end in one task; the salt must differ from row to
    row, as an id or an offset does. A row without a number is an error: see ``split_rejects``.
    """
    number = F.col(partition) if isinstance(partition, str) else partition
    number = F.coalesce(number, F.raise_error(F.lit("a row has no partition")).cast("int"))
    if splits > 1 and salt is None:
        raise ValueError("splits need a salt")
    if splits == 1:
        return rows.repartitionById(partitions, number)
    part = F.pmod(F.xxhash64(salt), F.lit(splits))
    spot = (number * splits + part).cast("int")
    return rows.repartitionById(partitions * splits, spot)
