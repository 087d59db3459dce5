from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
import pytest
from pyspark.sql import functions as F

from relaybook.functions import (
    decode_text,
    envelope,
    int_bytes,
    key_partition,
    long_bytes,
    normalize_topic,
    open_envelope,
    split_topics,
    text_bytes,
    tokenize,
    topic_matches,
    vin_topic,
)

SOME = settings(
    max_examples=12, deadline=None, derandomize=True,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)


def apply(spark, values, kind, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    found = rows.select("i", expression(F.col("v")).alias("r")).collect()
    return [row["r"] for row in sorted(found, key=lambda row: row["i"])]


# --- words

WORDS = {
    "a  b ": ["a", "", "b"],
    "": [""],
    "   ": [],
    " a": ["", "a"],
    "a \n": ["a", "\n"],
    "a\tb": ["a\tb"],
    "Ab aB": ["Ab", "aB"],
    "\u00a0 \u3000": ["\u00a0", "\u3000"],
    None: None,
}


def test_words(spark):
    assert apply(spark, WORDS, "string", tokenize) == list(WORDS.values())


def split_model(text):
    """Split at each space; empty parts at the end do not count, a text without spaces is whole."""
    parts = text.split(" ")
    while len(parts) > 1 and parts[-1] == "":
        parts.pop()
    return [] if parts == [""] and text else parts


@SOME
@given(st.lists(st.text(st.sampled_from(" ab\n\té漢")), min_size=20, max_size=60))
def test_words_like_model(spark, texts):
    assert apply(spark, texts, "string", tokenize) == [split_model(t) for t in texts]


# --- routing

PARTITIONS = {
    "a.5": 1, ".5": 0, ".a.5": 1, "abc": 0, "a.": None, "a.x": None, "a. 7": None,
    "a.99999999999": None, "a.-3": 1, "a.+3": 3, "a.5\n": None, "a.2147483647": 3,
    "a.-2147483648": 0, "a.2147483648": None, "": 0, ".": 0, "a..6": 2, None: None,
}


def test_partitions(spark):
    found = apply(spark, PARTITIONS, "string", lambda k: key_partition(k, 4))
    assert found == list(PARTITIONS.values())


def partition_model(key, n):
    dot = key.rfind(".")
    if dot <= 0:
        return 0
    suffix = key[dot + 1:]
    digits = suffix[1:] if suffix[:1] in ("+", "-") else suffix
    if not digits or any(c not in "0123456789" for c in digits):
        return None
    return int(suffix) % n if -2**31 <= int(suffix) < 2**31 else None


@SOME
@given(st.lists(st.text(st.sampled_from("ab..019+- \n")), min_size=20, max_size=60), st.integers(1, 9))
def test_partitions_like_model(spark, keys, n):
    found = apply(spark, keys, "string", lambda k: key_partition(k, n))
    assert found == [partition_model(k, n) for k in keys]


def test_partitions_need_one(spark):
    with pytest.raises(ValueError):
        key_partition(F.lit("a.1"), 0)


def test_vin_topic(spark):
    assert apply(spark, ["1J9FN78S5VL123456"], "string", vin_topic) == ["456"]


# --- topics

def test_normalize(spark):
    assert apply(spark, ["a/b/c", "plain", "/a//", None], "string", normalize_topic) == [
        "a.b.c", "plain", ".a..", None]


def test_split_topics():
    assert split_topics("a,b") == ["a", "b"]
    assert split_topics("a") == ["a"]
    assert split_topics(",a,,") == ["", "a"]
    assert split_topics("") == [""]
    assert split_topics(",") == []


FILTER_CASES = [
    ("#", "a/b", True), ("#", "$SYS/x", False), ("#", "/", True),
    ("a/#", "a", True), ("a/#", "a/b/c", True), ("a/#", "ab", False), ("a/#", "b/a", False),
    ("+", "a", True), ("+", "a/b", False), ("+", "$SYS", False), ("+", "", True),
    ("+/#", "$SYS/x", False), ("+/#", "a", True), ("+/b", "a/b", True), ("+/b", "/b", True),
    ("a/+/c", "a/b/c", True), ("a/+/c", "a//c", True), ("a/+/c", "a/c", False),
    ("a/+", "a/b/c", False), ("a/+/#", "a/b", True), ("a/+/#", "a", False),
    ("$SYS/#", "$SYS/x", True), ("$SYS/+", "$SYS/x", True),
    ("a.c", "abc", False), ("a.c", "a.c", True), ("+/a.(c)", "x/a.(c)", True),
    ("+/a.(c)", "x/abc", False), ("+/[a]\\E", "x/[a]\\E", True),
    ("a/b", "a/b\n", False), ("+/b", "a/b\n", False), ("a/+", "a/b\n", True), ("+/b", "a\n/b", True),
]


def test_filters(spark):
    row = spark.range(1)
    found = row.select(*[
        topic_matches(F.lit(topic), [each]).alias(f"c{i}")
        for i, (each, topic, _) in enumerate(FILTER_CASES)
    ]).first()
    wrong = [case for case, got in zip(FILTER_CASES, found) if case[2] != got]
    assert not wrong


def filter_model(each, topic):
    if topic.startswith("$") and each[0] in "+#":
        return False
    wanted, levels = each.split("/"), topic.split("/")
    for i, level in enumerate(wanted):
        if level == "#":
            return True
        if i >= len(levels):
            return False
        if level != "+" and level != levels[i]:
            return False
    return len(wanted) == len(levels)


LEVEL = st.sampled_from(["a", "b", "$", "a.b", ""])
TOPIC = st.lists(LEVEL, min_size=1, max_size=4).map("/".join).filter(bool)
FILTER = st.tuples(
    st.lists(st.one_of(LEVEL, st.just("+")), min_size=1, max_size=4), st.booleans()
).map(lambda p: "/".join(p[0] + (["#"] if p[1] else []))).filter(bool)


@SOME
@given(st.lists(TOPIC, min_size=20, max_size=40), st.lists(FILTER, min_size=1, max_size=4))
def test_filters_like_model(spark, topics, filters):
    found = apply(spark, topics, "string", lambda t: topic_matches(t, filters))
    assert found == [any(filter_model(f, t) for f in filters) for t in topics]


@pytest.mark.parametrize("bad", ["", "a/#/b", "a#", "a/b+", "#/a"])
def test_bad_filters(bad):
    with pytest.raises(ValueError):
        topic_matches(F.lit("a"), [bad])


def test_many_filters(spark):
    filters = [f"a/{i}/#" for i in range(3000)] + [f"b/+/{i}" for i in range(3000)] + ["c"]
    topics = ["a/2999/x", "a/3000", "b/x/0", "b/x/3000", "c", "d"]
    found = apply(spark, topics, "string", lambda t: topic_matches(t, filters))
    assert found == [True, False, True, False, True, False]


def test_no_filter_matches_nothing(spark):
    assert spark.range(1).where(topic_matches(F.lit("a"), [])).count() == 0


# --- envelopes

def test_envelope(spark):
    stamp = F.timestamp_micros(F.lit(1500000000123999))
    found = apply(spark, ['say "a/b"\n', "é漢", None, ""], "string", lambda v: envelope(v, stamp))
    assert found == [
        '{"payload":"say \\"a/b\\"\\n","timestamp":"1500000000123"}',
        '{"payload":"é漢","timestamp":"1500000000123"}',
        '{"payload":null,"timestamp":"1500000000123"}',
        '{"payload":"","timestamp":"1500000000123"}',
    ]


def test_envelope_before_1970(spark):
    stamp = F.timestamp_micros(F.lit(-1))
    assert apply(spark, ["a"], "string", lambda v: envelope(v, stamp)) == [
        '{"payload":"a","timestamp":"-1"}']


@SOME
@given(st.lists(st.one_of(st.none(), st.text(st.characters(exclude_categories=["Cs"]))), min_size=5))
def test_envelope_round_trip(spark, payloads):
    stamp = F.timestamp_millis(F.lit(7))
    found = apply(spark, payloads, "string", lambda v: open_envelope(envelope(v, stamp)))
    assert [tuple(r) for r in found] == [(p, "7") for p in payloads]


def test_open_no_envelope(spark):
    found = apply(spark, ["no json", "{}"], "string", open_envelope)
    assert [tuple(r) for r in found] == [(None, None), (None, None)]


# --- bytes

def test_decode(spark):
    assert apply(spark, [b"a\xffb", b"", "é".encode(), None], "binary", decode_text) == [
        "a\ufffdb", "", "é", None]


def test_text_bytes(spark):
    assert [bytes(b) for b in apply(spark, ["é"], "string", text_bytes)] == ["é".encode()]


NUMBERS = [0, 7, -5, 2**31 - 1, -(2**31)]


def test_int_bytes(spark):
    found = apply(spark, NUMBERS, "int", int_bytes)
    assert [bytes(b) for b in found] == [n.to_bytes(4, "big", signed=True) for n in NUMBERS]


@pytest.mark.parametrize("number", [2**31, -(2**31) - 1, 2**32 + 7])
def test_int_bytes_of_wide_numbers(spark, number):
    with pytest.raises(Exception, match="no 32-bit number"):
        apply(spark, [number], "bigint", int_bytes)


def test_int_bytes_of_null(spark):
    assert apply(spark, [None], "bigint", int_bytes) == [None]


def test_long_bytes(spark):
    numbers = NUMBERS + [2**63 - 1, -(2**63)]
    found = apply(spark, numbers, "bigint", long_bytes)
    assert [bytes(b) for b in found] == [n.to_bytes(8, "big", signed=True) for n in numbers]
