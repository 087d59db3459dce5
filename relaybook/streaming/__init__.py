"""Streams: triggers, sinks, and logs that stay exact when a batch runs twice."""
