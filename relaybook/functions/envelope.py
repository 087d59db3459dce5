"""The JSON envelope ``{"payload": ..., "timestamp": "<epoch ms>"}``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from relaybook.schemas import ENVELOPE


def epoch_millis(ts: Column) -> Column:
    """Whole milliseconds since 1970, cut off and not rounded."""
    return F.unix_millis(ts.cast("timestamp"))


def envelope(payload: Column, ts: Column) -> Column:
    """Wrap a payload; a null payload stays visible as ``"payload":null``."""
    fields = F.struct(payload.alias("payload"), epoch_millis(ts).cast("string").alias("timestamp"))
    return F.to_json(fields, {"ignoreNullFields": "false"})


def open_envelope(value: Column) -> Column:
    """The struct inside an envelope; the fields are null where the text is no envelope."""
    return F.from_json(value, ENVELOPE)
