"""Topic names: lists, normalising, and subscription filters."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_topics(names: str) -> list[str]:
    """``"a,b"`` to ``["a", "b"]``; empty names at the end are dropped."""
    kept = names.rstrip(",")
    return kept.split(",") if kept or not names else []


def normalize_topic(topic: Column) -> Column:
    """The Kafka name of an MQTT topic, whose levels are joined by dots instead of slashes."""
    return F.replace(topic, F.lit("/"), F.lit("."))


def topic_matches(topic: Column, filters: Iterable[str]) -> Column:
    """True where the topic matches any of the MQTT subscription filters.

    Filters without a wildcard become one IN list and ``a/b/#`` becomes a prefix test, which both
    reach the Parquet scan; those with ``+`` share one regular expression.
    """
    exact, patterns, tests = [], [], []
    for each in dict.fromkeys(filters):
        levels = each.split("/")
        _check_filter(each, levels)
        if levels == ["#"]:
            tests.append(~topic.startswith("$"))
        elif "+" in levels:
            patterns.append(_filter_pattern(levels))
        elif levels[-1] == "#":
            parent = each[:-2]
            exact.append(parent)
            tests.append(topic.startswith(parent + "/"))
        else:
            exact.append(each)
    if exact:
        tests.append(topic.isin(exact))
    if patterns:
        tests.append(topic.rlike(rf"(?s)^(?:{'|'.join(patterns)})\z"))
    return _any(tests)


def _any(tests: list[Column]) -> Column:
    """The tests joined by OR, halved again and again so that thousands do not nest too deep."""
    if len(tests) < 2:
        return tests[0] if tests else F.lit(False)
    half = len(tests) // 2
    return _any(tests[:half]) | _any(tests[half:])


def _check_filter(each: str, levels: list[str]) -> None:
    if not each:
        raise ValueError("a topic filter must not be empty")
    if "#" in levels[:-1] or any(len(l) > 1 and ("#" in l or "+" in l) for l in levels):
        raise ValueError(f"wildcards must fill a level, and '#' the last one: {each!r}")


def _filter_pattern(levels: list[str]) -> str:
    rest = levels[-1] == "#"
    named = levels[:-1] if rest else levels
    body = "/".join("[^/]*" if level == "+" else _quote(level) for level in named)
    system = r"(?!\$)" if levels[0] == "+" else ""
    return rf"{system}{body}{'(?:/.*)?' if rest else ''}"


def _quote(level: str) -> str:
    """Escape regex characters; only ASCII punctuation, which Java and Python read alike."""
    return re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", level)
