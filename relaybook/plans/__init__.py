"""Whole jobs, from source to sink, that run the same over a backlog and over a live stream."""

from relaybook.plans.bridge import bridge, enveloped_bridge, replay_bridge
from relaybook.plans.closing import ClosingWindows, close_windows
from relaybook.plans.counting import (
    count_batch_words,
    count_batches,
    count_messages,
    count_words,
    fold_batch_words,
    fold_totals,
    put_batch_words,
    state_totals,
)
from relaybook.plans.fleet import feed_vehicles
from relaybook.plans.retaining import keep_retained, kept_messages, kept_table

__all__ = [
    "bridge", "enveloped_bridge", "replay_bridge",
    "ClosingWindows", "close_windows",
    "count_batch_words", "count_batches", "count_messages", "count_words",
    "fold_batch_words", "fold_totals", "put_batch_words", "state_totals",
    "keep_retained", "kept_messages", "kept_table",
    "feed_vehicles",
]
