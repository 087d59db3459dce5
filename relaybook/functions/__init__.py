"""Column expressions; all are built-ins that stay inside generated code."""

from relaybook.functions.encoding import decode_text, int_bytes, long_bytes, text_bytes
from relaybook.functions.envelope import envelope, epoch_millis, open_envelope
from relaybook.functions.routing import key_partition, vin_topic
from relaybook.functions.text import tokenize
from relaybook.functions.topics import normalize_topic, split_topics, topic_matches

__all__ = [
    "decode_text", "int_bytes", "long_bytes", "text_bytes",
    "envelope", "epoch_millis", "open_envelope",
    "key_partition", "vin_topic",
    "tokenize",
    "normalize_topic", "split_topics", "topic_matches",
]
