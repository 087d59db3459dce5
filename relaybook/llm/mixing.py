"""Mixing sources to target weights along a curriculum that changes over the training run.

Each source has a target number of words and a schedule of weights over training time 0 to 1. The
integral of the schedule is the source's token demand; a document that begins at word ``c`` of its
source's stream is due when that demand reaches ``c``. Inverting the integral gives its position.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relaybook.llm.common import carried, columns, stash, words

#: Weights and schedules go round over the sources in code point order, null last.
WEIGHTS = (3.0, 1.0, 2.0)
#: Knots (time, weight), linear in between: early sources fade, late ones grow, the rest stay.
SCHEDULES = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 0.5), (0.5, 0.8), (1.0, 1.9)),
    ((0.0, 1.0), (1.0, 1.0)),
)
SHARE = 1.5
MOST = 2
#: Buckets of one source, as hex digits of a document's key: 4096.
DIGITS = 3


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """From rows (stream, source, source_size), add ``turn`` (which weight) and ``target``.

    All targets sum to ``share`` of all sizes, unless ``most`` times the sizes is less. A target
    stops at ``most`` times its source's size and what it leaves goes to the others by weight. The
    level they share is found in closed form: sources are sorted by how soon they fill up. There is
    one row per source, and only these rows meet in one task.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("turn", F.pmod(F.row_number().over(in_order) - 1, F.lit(len(weights))))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("turn") + 1)
    ranked = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    every = Window.partitionBy(F.lit(0))
    soonest = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = soonest.rowsBetween(Window.unboundedPreceding, -1)
    level = (
        F.sum("source_size").over(every) * F.lit(float(share))
        - F.coalesce(F.sum("cap").over(before), F.lit(0))
    ) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    leveled = ranked.withColumn("level", level).withColumn("rank", F.row_number().over(soonest))
    fits = F.col("cap") >= F.col("level") * F.col("weight")
    chosen = F.min_by("level", F.when(fits, F.col("rank"))).over(every)
    wanted = F.coalesce(chosen * F.col("weight"), F.col("cap").cast("double"))
    target = F.least(F.col("cap").cast("double"), wanted)
    return leveled.select("stream", "turn", "source_size", target.alias("target"))


def due(share_done: Column, knots) -> Column:
    """When a schedule's integral, scaled to 1, reaches a share: the inverse, piece by piece."""
    pieces, total = [], 0.0
    for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False):
        area = (w0 + w1) / 2 * (t1 - t0)
        pieces.append((t0, t1, w0, w1, total, total + area))
        total += area
    if total <= 0 or any(w < 0 for _, w in knots):
        raise ValueError("a schedule needs weights of 0 or more and some weight above 0")
    amount, found = share_done * total, None
    for t0, t1, w0, w1, low, high in reversed(pieces):
        if high <= low:
            continue
        slope = (w1 - w0) / (t1 - t0)
        left = F.greatest(amount - F.lit(low), F.lit(0.0))
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + left * (2 * slope), F.lit(0.0)))
        at = F.least(
            F.when(left > 0, F.lit(t0) + left * 2 / (F.lit(w0) + root)).otherwise(F.lit(t0)),
            F.lit(t1),
        )
        found = at if found is None else F.when(amount < high, at).otherwise(found)
    return found


ADDED = ("size", "source_size", "target", "copies", "taken", "positions")


def _keyed(docs: DataFrame, doc_id: str, text: str, source: str, carry) -> DataFrame:
    """The whole row, and what the mix needs of it. The key says where in its stream a row stands."""
    marked = [F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit("-"))
              for name in (doc_id, source, text)]
    key = F.md5(F.concat_ws("\n", *marked))
    return docs.select(
        carried(docs, carry, *ADDED).alias("row"),
        F.col(source).cast("string").alias("source"),
        F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("-")).alias("stream"),
        F.size(words(F.col(text))).cast("long").alias("size"),
        F.unhex(key).alias("key"),
        F.substring(key, 1, DIGITS).alias("bucket"),
    )


def mix(
    docs: DataFrame, weights=WEIGHTS, schedules=SCHEDULES, share: float = SHARE, most: int = MOST,
    doc_id: str = "doc_id", text: str = "text", source: str = "source",
    carry: list[str] | None = None,
) -> DataFrame:
    """Documents with ``size``, ``source_size``, ``target``, ``copies``, ``taken`` and ``positions``.

    Within a source, documents stand in the order of a hash of their id, source and text, repeated
    ``most`` times; those are taken whose middle word comes before the target. So a source's taken
    words miss its target by half a document at most, and ``positions`` holds the training time
    (0 to 1) of each copy. Running sums are taken in two steps, over 4096 buckets of a source and
    inside each bucket, so a source with most of the rows is spread over all tasks.

    Texts are counted whole, however long. Null texts and texts without words have size 0 and are not taken. Null sources are one source,
    the last. Rows equal in id, source and text follow each other; which of them is taken twice does
    not show in the result. An empty table gives an empty one. ``carry`` names the columns of
    ``docs`` to return (default: all); texts that are not carried are not shuffled. Columns of the
    input with the names of result columns are replaced.
    """
    if len(weights) != len(schedules):
        raise ValueError("weights and schedules must pair up")
    if any(not w > 0 or math.isinf(w) for w in weights):
        raise ValueError("weights must be above 0")
    keyed = _keyed(docs, doc_id, text, source, carry)
    sums = stash(
        keyed.groupBy("stream", "source", "bucket").agg(F.sum("size").alias("bucket_size")),
        "mix-sums",
    )
    per_source = targets(
        sums.groupBy("stream", "source").agg(F.sum("bucket_size").alias("source_size")),
        weights, share, most,
    )
    earlier = Window.partitionBy("stream").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sums.withColumn(
        "bucket_start", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0))
    ).join(per_source, "stream").select(
        "stream", "bucket", "bucket_start", "turn", "source_size", "target"
    )
    inside = Window.partitionBy("stream", "bucket").orderBy("key").rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = keyed.join(offsets, ["stream", "bucket"]).withColumn(
        "start", F.col("bucket_start") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    )
    starts = [F.col("source_size") * turn + F.col("start") for turn in range(most)]
    copies = sum(
        (F.when((F.col("size") > 0) & (at + F.col("size") / 2 < F.col("target")), 1).otherwise(0)
         for at in starts),
        F.lit(0),
    )

    def position(at: Column) -> Column:
        done = F.least(at / F.col("target"), F.lit(1.0))
        found = due(done, schedules[-1])
        for turn, knots in enumerate(schedules[:-1]):
            found = F.when(F.col("turn") == turn, due(done, knots)).otherwise(found)
        return found

    positions = F.array(*[F.when(F.col("copies") > n, position(at)) for n, at in enumerate(starts)])
    counted = placed.withColumn("copies", copies).withColumn(
        "positions", F.filter(positions, lambda at: at.isNotNull())
    )
    return counted.withColumn("taken", F.col("size") * F.col("copies")).select("row.*", *ADDED)


def arrange(mixed: DataFrame) -> DataFrame:
    """One row per copy taken, sorted by training position, from a mix that carries structs ``row``.

    Copies are dealt by range of position, ties by a hash of the row, and sorted.
    """
    copies = mixed.select("row", F.explode("positions").alias("position"))
    ordered = copies.withColumn("tie", F.xxhash64("row"))
    return ordered.repartitionByRange("position", "tie").sortWithinPartitions(
        "position", "tie"
    ).select("row.*")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix in training order, each as often as it is taken.

    Columns of any name are given back as they were. Equal positions are ordered by a hash of the row; the
    other edge cases are those of ``mix``.
    """
    names = {name: options.pop(name, name) for name in ("doc_id", "text", "source")}
    wrapped = docs.select(
        F.struct(*columns(docs)).alias("row"),
        *[F.col(name).alias(f"mix_{role}") for role, name in names.items()],
    )
    mixed = mix(wrapped, doc_id="mix_doc_id", text="mix_text", source="mix_source", carry=["row"], **options)
    return arrange(mixed)
