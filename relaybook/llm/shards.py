"""Sharding by fixed virtual slots and a versioned map from slots to shards."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from relaybook.llm.common import carried
from relaybook.session import work_dir

#: Slots never change in number, so a map has this many rows at most, whatever the data.
SLOTS = 8192
OVERHEAD = 16
ADDED = ("size", "text_crc32", "law", "virtual_slot", "shard", "slot", "grown_shard", "next_shard")


class SlotMap:
    """Versions of a slot-to-shard map, each in its own folder and never changed afterwards."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def write(self, version: int, shard_of: list[int]) -> None:
        rows = [(slot, shard) for slot, shard in enumerate(shard_of)]
        made = self.spark.createDataFrame(rows, "slot int, shard int")
        made.coalesce(1).write.mode("errorifexists").parquet(f"{self.path}/version={version}")

    def read(self, version: int) -> list[int]:
        found = self.spark.read.schema("slot int, shard int").parquet(
            f"{self.path}/version={version}"
        )
        return [row.shard for row in found.orderBy("slot").collect()]


    def versions(self) -> list[int]:
        found = self.spark.read.schema("slot int, shard int, version int").parquet(self.path)
        return sorted(row.version for row in found.select("version").distinct().collect())


def spread(slot_bytes: list[int], shards: int) -> list[int]:
    """A first map: the largest slot left goes to the shard with the fewest bytes."""
    if shards < 1:
        raise ValueError("there must be a shard")
    load = [(0, shard) for shard in range(shards)]
    shard_of = [0] * len(slot_bytes)
    for slot in sorted(range(len(slot_bytes)), key=lambda s: (-slot_bytes[s], s)):
        size, shard = heapq.heappop(load)
        shard_of[slot] = shard
        heapq.heappush(load, (size + slot_bytes[slot], shard))
    return shard_of


def grown(shard_of: list[int], slot_bytes: list[int], shards: int) -> list[int]:
    """The map edited for one more shard: slots move into the new shard and nowhere else.

    The fullest shard gives its largest slot that fits, until the new one has an equal share.
    """
    edited, share = list(shard_of), sum(slot_bytes) / (shards + 1)
    owned: list[list[int]] = [[] for _ in range(shards)]
    for slot in sorted(range(len(slot_bytes)), key=lambda s: (slot_bytes[s], s)):
        if slot_bytes[slot]:
            owned[shard_of[slot]].append(slot)
    load = [(-sum(slot_bytes[s] for s in slots), shard) for shard, slots in enumerate(owned)]
    heapq.heapify(load)
    room = share
    while load:
        held, shard = heapq.heappop(load)
        if -held <= share:
            break
        fits = next((s for s in reversed(owned[shard]) if slot_bytes[s] <= room), None)
        if fits is None:
            continue
        owned[shard].remove(fits)
        edited[fits], room = shards, room - slot_bytes[fits]
        heapq.heappush(load, (held + slot_bytes[fits], shard))
    return edited


def rebalanced(shard_of: list[int], slot_bytes: list[int], shards: int, slack: float = 0.01):
    """The map edited for bytes that have drifted: slots leave shards that hold over ``slack`` too
    much for the emptiest one, as long as that evens them out."""
    edited, share = list(shard_of), sum(slot_bytes) / shards
    load = [0] * shards
    owned: list[list[int]] = [[] for _ in range(shards)]
    for slot in sorted(range(len(slot_bytes)), key=lambda s: (-slot_bytes[s], s)):
        load[shard_of[slot]] += slot_bytes[slot]
        owned[shard_of[slot]].append(slot)
    for _ in range(len(slot_bytes)):
        most = max(range(shards), key=load.__getitem__)
        least = min(range(shards), key=load.__getitem__)
        gap = load[most] - load[least]
        if load[most] <= share * (1 + slack):
            break
        moved = next((s for s in owned[most] if 0 < slot_bytes[s] < gap), None)
        if moved is None:
            break
        owned[most].remove(moved)
        owned[least].append(moved)
        edited[moved] = least
        load[most] -= slot_bytes[moved]
        load[least] += slot_bytes[moved]
    return edited


def _records(docs: DataFrame, doc_id: str, text: str, carry: list[str] | None) -> DataFrame:
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        carried(docs, carry, *ADDED).alias("row"), F.col(doc_id).alias("id"),
        (F.octet_length(whole) + OVERHEAD).cast("long").alias("size"),
        F.crc32(whole).alias("text_crc32"),
        F.pmod(F.xxhash64(F.col(doc_id), F.col(text)), F.lit(SLOTS)).cast("int").alias("virtual_slot"),
    )


def _loads(records: DataFrame) -> tuple[list[int], list[int]]:
    """Bytes and rows of every slot."""
    slot_bytes, slot_rows = [0] * SLOTS, [0] * SLOTS
    per_slot = records.groupBy("virtual_slot").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    for row in per_slot.collect():
        slot_bytes[row.virtual_slot], slot_rows[row.virtual_slot] = row["size"], row.n
    return slot_bytes, slot_rows


def rebalance(
    docs: DataFrame, shards: int, slot_map: SlotMap, version: int, doc_id: str = "doc_id",
    text: str = "text", slack: float = 0.01,
) -> int:
    """Edit a version of the map for documents whose bytes have drifted, and return the version to use.

    That is a new one, the next of the map, in which only slots of overfull shards have moved; or
    ``version`` itself where no shard holds over ``slack`` too much or nothing can be evened out.
    ``shard`` with the returned version places the documents by it. Edge cases are those of ``shard``; an
    empty table moves nothing.
    """
    slot_bytes, _ = _loads(_records(docs, doc_id, text, []))
    before = slot_map.read(version)
    after = rebalanced(before, slot_bytes, shards, slack)
    if after == before:
        return version
    following = max(slot_map.versions()) + 1
    slot_map.write(following, after)
    return following


def shard(
    docs: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text",
    slot_map: SlotMap | None = None, version: int | None = None, carry: list[str] | None = None,
) -> DataFrame:
    """Documents with ``size``, ``text_crc32``, ``law``, ``virtual_slot``, ``shard``, ``slot``,
    ``grown_shard`` and ``next_shard``.

    A record goes to the virtual slot of a hash of its id and text. Bytes are summed per slot and
    the slots are dealt to shards evenly, so the law is ``bytes``; ``grown_shard`` is null under it,
    and ``next_shard`` is where the next version of the map, for one more shard, puts the row. Both
    versions are stored in ``slot_map``, by default in the shared folder. With ``version`` that
    version is read and not made anew. ``slot`` numbers the rows of a shard from 0 without a gap:
    the counts of its earlier virtual slots, and the row's number in its own.

    What goes to the driver, and back to all tasks, is one row per virtual slot: 8192 at most. Rows
    are numbered in thousands of groups. Only rows equal in id and text always share a slot.

    A null text has no bytes (size 16, crc 0); null ids are hashed like a value. An empty table
    gives an empty one. ``carry`` names the columns of ``docs`` to return (default: all); texts that
    are not carried are not shuffled. Columns of the input with the names of result columns are
    replaced.
    """
    spark = docs.sparkSession
    records = _records(docs, doc_id, text, carry)
    slot_bytes, slot_rows = _loads(records)
    store = slot_map or SlotMap(spark, work_dir(spark, "slot-map"))
    if version is None:
        shard_of = spread(slot_bytes, shards)
        version = 1
        store.write(version, shard_of)
        after = grown(shard_of, slot_bytes, shards)
        store.write(version + 1, after)
    else:
        shard_of = store.read(version)
        after = grown(shard_of, slot_bytes, shards)
    first, filled = [0] * SLOTS, [0] * (max(shard_of, default=0) + 1)
    for at in range(SLOTS):
        first[at], filled[shard_of[at]] = filled[shard_of[at]], filled[shard_of[at]] + slot_rows[at]
    rows = list(zip(range(SLOTS), shard_of, after, first, strict=True))
    places = spark.createDataFrame(
        rows, "virtual_slot int, shard int, next_shard int, first long"
    )
    numbered = Window.partitionBy("virtual_slot").orderBy(
        F.col("id").asc_nulls_last(), "text_crc32", "size"
    )
    # SLOTS rows, whatever the data.
    placed = records.join(F.broadcast(places), "virtual_slot").withColumn(
        "slot", F.col("first") + F.row_number().over(numbered) - 1
    ).withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))
    return placed.select("row.*", *ADDED)
