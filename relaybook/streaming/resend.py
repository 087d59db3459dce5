"""Messages that a bridge sent twice, counted once."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relaybook.operators.windows import interval


def once(
    messages: DataFrame, within: timedelta, ts: str = "timestamp",
    keys: Sequence[str] = ("topic", "key", "id"),
) -> DataFrame:
    """The first of the messages that are equal in ``keys`` and at most ``within`` apart in event time.

    A batch whose send failed runs again, so a topic behind a bridge may hold its messages twice. The
    stream remembers the keys of messages until its watermark, ``within`` behind the newest message, has
    passed them; so state holds the keys of that span and no more. A message that comes later than that
    is dropped if it is behind the watermark, as its keys may have been forgotten: choose ``within``
    longer than a send is tried. Null keys are keys like others.
    """
    marked = messages.withWatermark(ts, interval(within))
    return marked.dropDuplicatesWithinWatermark(list(keys))


def message_ids(messages: DataFrame, *names: str) -> DataFrame:
    """``messages`` with ``id``, a hash of what was sent, where the sender gave no id of its own."""
    return messages.withColumn("id", F.sha2(F.to_json(F.struct(*names)), 256))
