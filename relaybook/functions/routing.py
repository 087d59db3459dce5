"""Where a message goes: a partition from its key, a topic from its vehicle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_partition(key: Column, partitions: int) -> Column:
    """Number after the key's last dot, modulo the partitions.

    A key without a dot, or whose only dot comes first, goes to 0. A suffix that is no 32-bit
    number gives null, for the caller to route to its reject output. Negative numbers wrap
    around, so the result is always a valid partition.
    """
    if partitions < 1:
        raise ValueError("there must be at least one partition")
    suffix = F.substring_index(key, ".", -1)
    last_dot = F.length(key) - F.length(suffix) - 1
    number = F.when(suffix.rlike(r"^[+-]?[0-9]+\z"), suffix.try_cast("int"))
    return (
        F.when(last_dot > 0, F.pmod(number, F.lit(partitions)))
        .when(key.isNotNull(), F.lit(0))
    )


def vin_topic(vin: Column) -> Column:
    """The routing name of a vehicle: what follows the first 14 characters of its VIN."""
    return F.substr(vin, F.lit(15))
