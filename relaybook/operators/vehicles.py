"""Messages of a vehicle fleet, built from lines of text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relaybook.functions import vin_topic

# The fleet, and how many of its first vehicles take turns.
VINS = [
    "1J9FN78S5VL123456",
    "1J9FN78S5VL123457",
    "1J9FN78S5VL123458",
    "1J9FN78S5VL123459",
    "1J9FN78S5VL123460",
    "1J9FN78S5VL123461",
    "1J9FN78S5VL123462",
]
TURNS = 3


def vehicle_messages(
    lines: DataFrame,
    passed_at: Column,
    pass_id: Column,
    *,
    line: str = "value",
    vins: Sequence[str] = VINS,
    turns: int = TURNS,
) -> DataFrame:
    """Add ``vin``, ``topic`` and ``message``, which is VIN, space, line and time of the pass.

    All lines of a pass over the input share its time and its vehicle. The pass number picks the
    vehicle, so a replayed pass gives the same messages.
    """
    if not 1 <= turns <= len(vins):
        raise ValueError("turns must be between 1 and the number of vehicles")
    turn = F.pmod(pass_id, F.lit(turns)).cast("int")
    vin = F.element_at(F.array(*[F.lit(v) for v in vins]), turn + 1)
    picked = lines.withColumn("vin", vin)
    time = F.date_format(passed_at, "HH:mm:ss")
    return picked.withColumn("topic", vin_topic(F.col("vin"))).withColumn(
        "message", F.concat("vin", F.lit(" "), F.col(line), time)
    )
