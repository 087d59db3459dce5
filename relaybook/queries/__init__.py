"""The registered queries, each over whole tables, with the SQL that must give the same rows."""

from relaybook.queries import cells, counters, messages, tables, windows, words  # noqa: F401
from relaybook.queries.registry import REGISTRY

__all__ = ["REGISTRY"]
