"""Chat formatting by expressions: turns are sorted, merged by role and concatenated.

Control strings begin with ``<``: ``<turn role>`` opens a block, ``<+>`` parts two turns of one block,
``</turn>`` closes it. In roles and texts a backslash stands before every ``\\``, ``<`` and ``>``, so no
control string can come from a text, and taking the backslashes away gives the text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relaybook.llm.common import let

OPEN, NEXT, CLOSE = "<turn ", "<+>", "</turn>"
#: Turns whose lengths are summed together, so that long conversations cost no square of turns.
RUN = 256
_CONTROL = r"([\\<>])"
#: A stretch without a control string; it is never given back, so long texts need no stack.
_FREE = r"(?:[^\\<>]++|\\.)*+"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _blocks(turns: Column) -> Column:
    """Adjacent turns of one role as one struct (role, texts)."""
    places = F.filter(
        F.sequence(F.lit(0), F.size(turns) - 1),
        lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"]),
    )
    return let(places, lambda starts: F.transform(starts, lambda at, k: F.struct(
        F.get(turns, at)["role"].alias("role"),
        F.transform(
            F.slice(turns, at + 1, F.coalesce(F.get(starts, k + 1), F.size(turns)) - at),
            lambda turn: turn["text"],
        ).alias("texts"),
    )))


def _lengths(blocks: Column, learns: str) -> Column:
    """Per turn, in order: the characters before its text, its own and after it, and if it is learnt."""
    def of(block: Column) -> Column:
        opening = F.length(escape(block["role"])) + len(OPEN) + 1
        return F.transform(block["texts"], lambda text, i: F.struct(
            F.when(i == 0, opening).otherwise(F.lit(len(NEXT))).alias("before"),
            F.length(text).alias("chars"),
            F.when(i == F.size(block["texts"]) - 1, len(CLOSE)).otherwise(0).alias("after"),
            (block["role"] == learns).alias("learnt"),
        ))

    return F.flatten(F.transform(blocks, of))


def _total(sizes: Column) -> Column:
    return F.aggregate(sizes, F.lit(0), lambda total, size: total + size)


def _mask(turns: Column) -> Column:
    """(start from 0, chars) of every learnt text in the formatted string.

    A text starts after the sums of the whole runs of turns before it and the turns of its own run.
    """
    sizes = F.transform(turns, lambda t: t["before"] + t["chars"] + t["after"])

    def spans(sizes: Column, runs: Column) -> Column:
        def span(turn: Column, i: Column) -> Column:
            run = F.floor(i / RUN).cast("int")
            start = F.get(runs, run) + _total(F.slice(sizes, run * RUN + 1, i - run * RUN))
            return F.struct((start + turn["before"]).alias("start"), turn["chars"].alias("chars"),
                            turn["learnt"].alias("learnt"))

        kept = F.filter(F.transform(turns, span), lambda s: s["learnt"])
        return F.transform(kept, lambda s: F.struct(s["start"], s["chars"]))

    def summed(sizes: Column) -> Column:
        runs = F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / RUN).cast("int"))
        totals = F.transform(runs, lambda run: _total(F.slice(sizes, run * RUN + 1, F.lit(RUN))))
        before = let(totals, lambda found: F.transform(
            found, lambda total, run: _total(F.slice(found, F.lit(1), run))
        ))
        return let(before, lambda found: spans(sizes, found))

    return let(sizes, summed)


def format_chats(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text", learns: str = "assistant",
) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted`` and ``loss_mask``.

    Turns stand in the order of ``turn`` (null first), ties by role and text; rows that repeat are
    all kept. Adjacent turns of one role share a block. ``loss_mask`` lists (start, chars), in
    characters of ``formatted`` from 0, of each text of the role ``learns``, still escaped. A null
    role or text is empty; a null ``conv_id`` is a conversation of its own. An empty table gives an empty
    one. Other columns, whatever their names, are left.

    A conversation is one row of the result, so it is gathered in one task and can not pass Spark's
    limit for one value (2 GB).
    """
    gathered = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("t"),
    ).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    # Escaped only now: a backslash before a character would change the order of ties.
    gathered = gathered.withColumn("turns", F.transform("turns", lambda t: F.struct(
        t["role"].alias("role"), escape(t["text"]).alias("text")
    )))
    blocks = gathered.select("conv_id", let(F.col("turns"), _blocks).alias("blocks"))
    formatted = F.array_join(
        F.transform("blocks", lambda b: F.concat(
            F.lit(OPEN), escape(b["role"]), F.lit(">"), F.array_join(b["texts"], NEXT), F.lit(CLOSE)
        )),
        "",
    )
    return blocks.select(
        "conv_id", formatted.alias("formatted"),
        let(_lengths(F.col("blocks"), learns), _mask).alias("loss_mask"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) read back from a formatted string."""
    whole = F.regexp_extract_all(formatted, F.lit(rf"(?s){OPEN}{_FREE}>{_FREE}(?:<\+>{_FREE})*+</turn>"), F.lit(0))

    def of(block: Column) -> Column:
        name = unescape(F.regexp_extract(block, rf"(?s)^{OPEN}({_FREE})>", 1))
        inner = F.regexp_replace(block, rf"(?s)^{OPEN}{_FREE}>|</turn>$", "")
        # Every text follows a control string once the closing one is gone.
        texts = F.regexp_extract_all(F.concat(F.lit(NEXT), inner), F.lit(rf"(?s)<\+>({_FREE})"), F.lit(1))
        return F.transform(texts, lambda t: F.struct(name.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(whole, of))


def learnt_texts(formatted: Column, loss_mask: Column) -> Column:
    """The texts under the loss mask, read from the formatted string and unescaped."""
    return F.transform(loss_mask, lambda span: unescape(
        F.substring(formatted, span["start"] + 1, span["chars"])
    ))


def digests(chats: DataFrame) -> DataFrame:
    """What is read back from formatted conversations, as counts and digests."""
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    back = chats.select(
        "conv_id", read_turns(F.col("formatted")).alias("turns"),
        F.array_join(learnt_texts(F.col("formatted"), F.col("loss_mask")), "").alias("learnt"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2(F.col("learnt"), 256).alias("loss_sha256"), "formatted_chars",
    )
