"""SimHash near-duplicates: fingerprints, bit-sliced comparison of blocks, connected classes."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relaybook.llm.common import columns, map_arrow, stash

SHINGLE = 3
RADIUS = 3
SEED = 42
#: Fingerprints compared within one bucket at most; fuller buckets are cut by more bits first.
BUCKET = 4096

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_ONE, _FULL = np.uint64(1), np.uint64(0xFFFFFFFFFFFFFFFF)


# Fingerprints -----------------------------------------------------------------------------------


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """64 bits; bit b is set if over half the shingles' hashes, repeats included, have it set.

    Words are parted by white space (characters 9 to 13 and 32), A-Z is lowered. A text of fewer
    words than a shingle is one shingle, one of no words has fingerprint 0.
    """
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - width + 1)
    starts = np.concatenate([[0], ends[: n - 1] + 1]).tolist()
    stops = ends[-n:].tolist()
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)])
    # Big-endian bytes: column 0 is the highest byte. Count each byte value per column, then its bits.
    seen = np.frombuffer(hashes, np.uint8).reshape(n, 8) + (256 * np.arange(8))
    counts = np.bincount(seen.ravel(), minlength=2048).reshape(8, 256) @ _BITS
    bits = (counts * 2 > n)[::-1]  # now byte 0 is the lowest
    return int(np.packbits(bits, axis=1, bitorder="little").ravel().view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", width: int = SHINGLE) -> DataFrame:
    """``docs`` with ``text`` replaced by its ``fingerprint``, a signed long of the 64 bits."""
    names = [name for name in docs.columns if name != text]
    kept = [docs.schema[name] for name in names]
    schema = T.StructType([*kept, T.StructField("fingerprint", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text).cast(pa.binary())
            found = np.fromiter((fingerprint(t.as_py() or b"", width) for t in texts), np.uint64, len(batch))
            arrays = [batch.column(name) for name in names] + [pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, names=[field.name for field in schema])

    return map_arrow(docs, run, schema)


# Comparison -------------------------------------------------------------------------------------


def planes(blocks: np.ndarray) -> np.ndarray:
    """Bit planes of blocks of 64 fingerprints: word p of a block has bit p of each of them."""
    bits = np.unpackbits(blocks.astype("<u8").view(np.uint8).reshape(-1, 64, 8), axis=2, bitorder="little")
    turned = np.ascontiguousarray(bits.transpose(0, 2, 1))
    return np.packbits(turned, axis=2, bitorder="little").view("<u8").reshape(-1, 64).astype(np.uint64)


def within(queries: np.ndarray, sliced: np.ndarray, radius: int) -> np.ndarray:
    """For each query and its block of 64, a word with the lanes at most ``radius`` bits away.

    Distances of all lanes grow together in bit-sliced counters: one carry-save step a plane. The
    counters hold up to ``radius`` and then an overflow that stays; a block whose lanes have all
    overflowed is abandoned.
    """
    n, digits = len(queries), max(1, radius.bit_length())
    found, open_ = np.zeros(n, np.uint64), np.arange(n)
    # Counters start so that radius + 1 differences carry out of the top digit.
    start = (1 << digits) - (radius + 1)
    counters = [np.full(n, _FULL if start >> d & 1 else 0, np.uint64) for d in range(digits)]
    over, sliced_open = np.zeros(n, np.uint64), sliced
    for plane in range(64):
        bit = (queries >> np.uint64(plane)) & np.uint64(1)
        carry = sliced_open[:, plane] ^ (np.uint64(0) - bit)
        for d in range(digits):
            counters[d], carry = counters[d] ^ carry, counters[d] & carry
        over |= carry
        if plane % 8 == 7:
            alive = over != _FULL
            if not alive.all():
                open_, queries, over = open_[alive], queries[alive], over[alive]
                sliced_open = sliced_open[alive]
                counters = [c[alive] for c in counters]
            if not len(open_):
                return found
    found[open_] = ~over
    return found


def links(
    values: np.ndarray, offsets: np.ndarray, radius: int, pairs: int = 1 << 16
) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links within buckets of distinct fingerprints, as pairs of places.

    The members of bucket k are ``values[offsets[k]:offsets[k + 1]]``. They lie side by side in blocks
    of 64 lanes; every member meets the blocks that hold later members of its bucket. Links are merged
    as they are found, so what is given back has fewer rows than the buckets and the same classes.
    """
    n = len(values)
    padded = np.zeros(-(-n // 64) * 64, np.uint64)
    padded[:n] = values
    sliced = planes(padded.reshape(-1, 64))
    end = np.repeat(offsets[1:], np.diff(offsets))
    blocks = ((end - 1) >> 6) - (np.arange(n) >> 6) + 1
    done = np.cumsum(blocks)
    parent = list(range(n))

    def root(at: int) -> int:
        while parent[at] != at:
            parent[at] = parent[parent[at]]
            at = parent[at]
        return at

    low = 0
    while low < n:
        before = int(done[low - 1]) if low else 0
        high = max(low + 1, int(np.searchsorted(done, before + pairs, side="right")))
        counts = blocks[low:high]
        query = np.repeat(np.arange(low, high), counts)
        step = np.arange(len(query)) - np.repeat(np.cumsum(counts) - counts, counts)
        block = (query >> 6) + step
        lanes = within(padded[query], sliced[block], radius)
        # Only later members of the same bucket count.
        first = np.clip(query + 1 - block * 64, 0, 64)
        last = np.clip(end[query] - block * 64, 0, 64)
        lanes &= _below(last) & ~_below(first)
        hit = np.flatnonzero(lanes)
        for q, b, word in zip(query[hit].tolist(), block[hit].tolist(), lanes[hit].tolist(), strict=True):
            while word:
                other = b * 64 + (word & -word).bit_length() - 1
                word &= word - 1
                a, c = root(q), root(other)
                if a != c:
                    parent[max(a, c)] = min(a, c)
                    yield q, other
        low = high


def _below(lanes: np.ndarray) -> np.ndarray:
    """Words with the lowest 0 to 64 bits set."""
    whole = lanes >= 64
    return np.where(whole, _FULL, (_ONE << np.where(whole, 0, lanes).astype(np.uint64)) - _ONE)


def _pieces(bits: list[int], count: int) -> list[list[int]]:
    size, more = divmod(len(bits), count)
    out, at = [], 0
    for n in range(count):
        step = size + (n < more)
        out.append(bits[at:at + step])
        at += step
    return [piece for piece in out if piece]


def _signed(bits) -> int:
    mask = sum(1 << b for b in bits)
    return mask - (1 << 64) if mask >> 63 else mask


def first_masks(radius: int) -> list[int]:
    """Masks of which two fingerprints within ``radius`` agree in one at least.

    The 64 bits are cut into ``radius + 2`` pieces; differences touch ``radius`` of them at most, so
    two pieces are equal.
    """
    pieces = _pieces(list(range(64)), radius + 2)
    return [_signed([*a, *b]) for a, b in itertools.combinations(pieces, 2)]


def next_masks(mask: int, radius: int) -> list[int]:
    """The mask with one more of ``radius + 1`` pieces of its free bits: one of them is equal too."""
    free = [b for b in range(64) if not (mask >> b) & 1]
    fixed = [b for b in range(64) if (mask >> b) & 1]
    return [_signed([*fixed, *piece]) for piece in _pieces(free, radius + 1)]


LINK = "a long, b long"


def _compare(buckets: DataFrame, radius: int) -> DataFrame:
    """Links of buckets (a column of arrays of fingerprints)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("members")
            offsets = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())])
            values = column.flatten().to_numpy()
            found = np.array(list(links(values.view(np.uint64), offsets, radius)), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values[found[:, side]]) for side in (0, 1)], names=["a", "b"]
            )

    return map_arrow(buckets.select("members"), run, LINK)


def all_links(distinct: DataFrame, radius: int = RADIUS, most: int = BUCKET) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints (column ``fingerprint``) within ``radius``.

    Fingerprints that agree in a mask share a bucket. Buckets are counted first: one of a single
    member is left out, and one of more than ``most`` goes to the next level, where each of its
    members gets a few longer masks, until buckets are small. With few free bits left a bucket can
    not be fuller, so this ends, and no pair is lost on the way.
    """
    masks = first_masks(radius)
    keyed = distinct.select("fingerprint", F.explode(F.array(*[F.lit(m) for m in masks])).alias("mask"))
    found = []
    while True:
        keyed = keyed.withColumn("value", F.col("fingerprint").bitwiseAND(F.col("mask")))
        counts = stash(
            keyed.groupBy("mask", "value").count().filter("count > 1"), "simhash-buckets"
        )
        full = counts.filter(F.col("count") > most).select("mask", "value")
        crowded = not full.isEmpty()
        small = counts.filter(F.col("count") <= most).select("mask", "value")
        if crowded:
            following = keyed.join(full, ["mask", "value"])
            # A crowded bucket is taken out before members of one bucket must meet in a task.
            keyed = stash(keyed.join(full, ["mask", "value"], "left_anti"), "simhash-small")
        buckets = keyed.join(small, ["mask", "value"]).groupBy("mask", "value").agg(
            F.collect_list("fingerprint").alias("members")
        )
        found.append(stash(_compare(buckets, radius), "simhash-links"))
        if not crowded:
            break
        longer = F.col("mask")
        cases = None
        for mask in masks:
            options = F.array(*[F.lit(m) for m in next_masks(mask, radius)])
            cases = F.when(longer == mask, options) if cases is None else cases.when(longer == mask, options)
        masks = sorted({m for mask in masks for m in next_masks(mask, radius)})
        keyed = stash(
            following.select("fingerprint", F.explode(cases).alias("mask")).distinct(),
            "simhash-crowded",
        )
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out.distinct()


# Classes ----------------------------------------------------------------------------------------


def classes(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b): the smallest node of its class.

    Links are contracted in turns of large and small stars until nothing changes. Each turn takes the
    smallest neighbour of every node by partial sums and joins it to the links, and is written to the
    shared folder, so a lost executor costs one turn at most.
    """
    current = stash(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(),
        "classes",
    )
    while True:
        both = current.unionAll(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stash(
            both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "classes-least"
        )
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stash(large.filter("a <> b").distinct(), "classes-large")
        lowest = stash(large.groupBy("a").agg(F.min("b").alias("m")), "classes-lowest")
        small = large.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            lowest.select("a", F.col("m").alias("b"))
        )
        following = stash(small.filter("a <> b").distinct(), "classes")
        changed = following.exceptAll(current)
        same = following.count() == current.count() and changed.isEmpty()
        current = following
        if same:
            break
    return current.select(F.col("a").alias("node"), F.col("b").alias("label")).unionAll(
        current.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )


# Operator ---------------------------------------------------------------------------------------


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = SHINGLE,
    radius: int = RADIUS, most: int = BUCKET,
) -> DataFrame:
    """Per row (doc_id, tie, fingerprint, component_id, class_fingerprint), with fingerprints as
    signed longs.

    ``component_id`` is the smallest id that links lead to, a link being two fingerprints that differ
    in ``radius`` bits or fewer, and ``class_fingerprint`` is the smallest fingerprint of that class.
    Equal fingerprints are compared once, whatever the number of copies. ``tie`` is a hash of the
    text, to tell apart rows of one id.

    Null and empty texts have fingerprint 0, which links like any other. Texts are read whole, however
    long. A null id is never the smallest; a class of null ids alone has a null ``component_id``. Rows that
    repeat are all kept; an empty table gives an empty one. Other columns, whatever their names, are not
    read.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("tie"), F.col(text).alias("whole")
    )
    marked = stash(fingerprints(rows, "whole", width), "simhash")
    distinct = stash(
        marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "simhash-distinct"
    )
    labels = classes(all_links(distinct.select("fingerprint"), radius, most))
    members = stash(
        labels.join(distinct, labels.node == distinct.fingerprint).select("fingerprint", "label", "first_id"),
        "simhash-members",
    )
    smallest = members.groupBy("label").agg(F.min("first_id").alias("component_id"))
    linked = members.join(smallest, "label").select("fingerprint", "component_id", "label")
    # A class of null ids alone has no smallest id, so joined rows are told by their label.
    smallest_id = F.when(F.col("label").isNotNull(), F.col("component_id")).otherwise(F.col("first_id"))
    per_fingerprint = distinct.join(linked, "fingerprint", "left").select(
        "fingerprint", smallest_id.alias("component_id"),
        F.coalesce("label", "fingerprint").alias("class_fingerprint"),
    )
    known = stash(per_fingerprint, "simhash-components")
    return marked.join(known, "fingerprint").select(
        "doc_id", "tie", "fingerprint", "component_id", "class_fingerprint"
    )


def hex_digits(fingerprint_column: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint_column), 16, "0"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each class, with its own columns: the one with the smallest id.

    Of rows with that id, the one with the smallest hash of its text stays; so it is in a class of
    null ids alone, which keeps one row as well. Classes that share an id keep one row each. Of rows equal
    in id and text, the one whose other columns have the smallest hash stays, so reruns agree. Columns of
    any name are given back as they were; an empty table gives an empty one.
    """
    found = stash(near_duplicates(docs, doc_id, text, **options), "simhash-found")
    chosen = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    # One row for each class; ids are unique as a rule, so this is a check by id only.
    repeated = not found.groupBy("doc_id", "tie").count().filter("count > 1").isEmpty()
    keys = chosen.groupBy("class_fingerprint").agg(
        F.min(F.struct("doc_id", "tie")).alias("least")
    ).select(F.col("least.doc_id").alias("chosen_id"), F.col("least.tie").alias("chosen_tie"))
    whole = docs.select(
        F.struct(*columns(docs)).alias("row"), F.col(doc_id).alias("own_id"),
        F.xxhash64(F.col(text)).alias("own_tie"),
    )
    kept = whole.join(
        keys, whole.own_id.eqNullSafe(keys.chosen_id) & (whole.own_tie == keys.chosen_tie), "left_semi"
    )
    if repeated:
        order = F.struct(F.xxhash64(F.to_json("row")), F.to_json("row"))
        kept = kept.groupBy("own_id", "own_tie").agg(F.min_by("row", order).alias("row"))
    return kept.select("row.*")

