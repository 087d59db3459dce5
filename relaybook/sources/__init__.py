"""Readers for messages, text files and tables."""

from relaybook.sources.files import read_lines
from relaybook.sources.messages import read_landed, read_messages
from relaybook.sources.tables import read_jdbc, read_table, typed_columns

__all__ = ["read_landed", "read_lines", "read_jdbc", "read_messages", "read_table", "typed_columns"]
