"""Benchmark decontamination: an FM-index over every shard of the corpus, searched for windows.

A task takes its documents in shards of some million words. For each it builds an FM-index over the
words, searches all windows of the test items backwards, finds where they occur, and merges them
into spans. Nothing is shuffled, and a lost task is run again from its input alone.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relaybook.llm.common import map_arrow, quoted, stash, without
from relaybook.llm.fmindex import FMIndex

WINDOW = 10
#: Words of a shard of documents.
SHARD_WORDS = 2_000_000
#: Windows, and bytes of item text, that one pass over the documents looks for. A window takes some 150
#: bytes in the driver and in each Python worker, and a distinct word some 120.
BLOCK_WINDOWS = 500_000
BLOCK_BYTES = 32_000_000

SPAN = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())]))
#: Letters A-Z become small, other letters, digits and bytes above 127 stay, the rest are gaps.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
    for b in range(256)
)
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def split_words(text: bytes) -> list[bytes]:
    """The words of UTF-8 text: runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z is lowered."""
    return text.translate(_FOLD).split()


class Phrases(NamedTuple):
    """The distinct windows of some items, over the numbered words that occur in them, in flat arrays."""

    numbers: dict[bytes, int]
    windows: np.ndarray
    lengths: np.ndarray
    #: The ids of items, and for each window where its own begin and end in ``holders``, which are places in ``ids``.
    ids: list[str]
    bounds: np.ndarray
    holders: np.ndarray

    @classmethod
    def of(cls, rows, window: int) -> Phrases:
        numbers: dict[bytes, int] = {}
        names: dict[str, int] = {}
        parts, owners = [], []
        for item, text in rows:
            # 0 ends a text, 1 parts runs, so words are numbered from 2.
            found = np.array([numbers.setdefault(w, len(numbers) + 2) for w in split_words(text)], np.int32)
            if not len(found):
                continue
            if len(found) < window:
                found = np.concatenate([found, np.zeros(window - len(found), np.int32)])
            parts.append(np.lib.stride_tricks.sliding_window_view(found, window).copy())
            owner = -1 if item is None else names.setdefault(item, len(names))
            owners.append(np.full(len(parts[-1]), owner, np.int32))
        every = np.concatenate([*parts, np.zeros((0, window), np.int32)])
        owner = np.concatenate([*owners, np.zeros(0, np.int32)])
        # Rows as opaque bytes sort as fast as numbers do.
        opaque = np.ascontiguousarray(every).view(np.dtype((np.void, 4 * window))).ravel()
        _, first, which = np.unique(opaque, return_index=True, return_inverse=True)
        windows = every[first]
        pairs = np.unique(which.astype(np.int64) * (len(names) + 1) + owner + 1)
        held, holders = np.divmod(pairs, len(names) + 1)
        # An item without an id covers words and is not listed.
        held, holders = held[holders > 0], holders[holders > 0] - 1
        return cls(numbers, windows, (windows > 0).sum(1), list(names),
                   np.searchsorted(held, np.arange(len(windows) + 1)), holders)

    def items(self, which: int) -> list[str]:
        return [self.ids[n] for n in self.holders[self.bounds[which]:self.bounds[which + 1]]]


def _matches(numbers: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, place) of all windows in a shard's word numbers, 0 where no item has the word.

    A window lies inside a run of item words, so runs shorter than the shortest window are left out
    of the index, and one separator stands between two runs.
    """
    nothing = np.zeros(0, np.int64)
    if not len(phrases.lengths):
        return nothing, nothing
    inside = np.concatenate([[False], numbers > 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    long_enough = ends - starts >= phrases.lengths.min()
    starts, ends = starts[long_enough], ends[long_enough]
    if not len(starts):
        return nothing, nothing
    sizes = ends - starts + 1
    place = np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    text = np.ones(len(place), np.int64)
    kept = np.ones(len(place), bool)
    kept[np.cumsum(sizes) - 1] = False
    text[kept] = numbers[place[kept]]
    index = FMIndex(text)
    phrase, at = index.locate(*index.search(phrases.windows, phrases.lengths))
    return phrase, place[at]


def _spans(hit: np.ndarray, first: int, last: int) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit[first:last], [0]])))
    return [{"first": int(a), "last": int(b) - 1} for a, b in zip(edges[::2], edges[1::2], strict=True)]


def _search_shard(batches: list[pa.RecordBatch], tokens, sizes, phrases: Phrases):
    """The batches of a shard with ``n_words``, ``spans`` and ``items`` filled in."""
    numbers = np.concatenate(tokens) if tokens else np.zeros(0, np.int32)
    sizes = np.array(sizes, np.int64)
    ends = np.cumsum(sizes + 1)
    starts = ends - sizes - 1
    phrase, place = _matches(numbers, phrases)
    change = np.zeros(len(numbers) + 1, np.int64)
    np.add.at(change, place, 1)
    np.add.at(change, place + phrases.lengths[phrase], -1)
    hit = (np.cumsum(change)[:-1] > 0).astype(np.int8)
    doc = np.searchsorted(starts, place, side="right") - 1
    found: defaultdict[int, set] = defaultdict(set)
    for pair in np.unique(doc * max(1, len(phrases.lengths)) + phrase):
        at, which = divmod(int(pair), len(phrases.lengths))
        found[at].update(phrases.items(which))
    hits = {int(d): _spans(hit, starts[d], ends[d] - 1) for d in np.unique(doc)}
    row = 0
    for batch in batches:
        yield batch, [
            (int(sizes[i]), hits.get(i, []), sorted(found.get(i, ()))) for i in range(row, row + len(batch))
        ]
        row += len(batch)


def _merged(spans: list[dict]) -> list[dict]:
    out: list[dict] = []
    for span in sorted(spans, key=lambda s: (s["first"], s["last"])):
        if out and span["first"] <= out[-1]["last"] + 1:
            out[-1]["last"] = max(out[-1]["last"], span["last"])
        else:
            out.append(dict(span))
    return out


def cut(text: bytes, spans: list[dict]) -> bytes:
    """The text without the words of these spans and what stands between them."""
    if not spans:
        return text
    places = [m.span() for m in _WORD.finditer(text)]
    kept, at = [], 0
    for span in spans:
        kept.append(text[at:places[span["first"]][0]])
        at = places[span["last"]][1]
    return b"".join([*kept, text[at:]])


def _pass(docs: DataFrame, phrases: Phrases, text: str, carry: list[str], last: bool, cutting: bool,
          shard_words: int) -> DataFrame:
    """One pass over the documents for one block of items; spans and items add up over passes."""
    again = "found_spans" in docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(phrases)
    kept = [docs.schema[name] for name in carry]
    found = [T.StructField("found_words", T.LongType()), T.StructField("found_spans", SPAN),
             T.StructField("found_items", T.ArrayType(T.StringType()))]
    if not last:
        kept = [*kept, *([docs.schema[text]] if text not in carry else [])]
    schema = T.StructType([*kept, *found])
    names = [field.name for field in kept]

    def finish(batch: pa.RecordBatch, results) -> pa.RecordBatch:
        if again:
            before = zip(batch.column("found_spans").to_pylist(), batch.column("found_items").to_pylist(), strict=True)
            results = [(n, _merged(old + new), sorted({*had, *items}))
                       for (n, new, items), (old, had) in zip(results, before, strict=True)]
        arrays = [batch.column(name) for name in names]
        if last and cutting and text in names:
            whole = batch.column(text)
            if any(r[1] for r in results):
                raw = whole.cast(pa.binary()).to_pylist()
                whole = pa.array([None if t is None else cut(t, r[1]).decode("utf-8", "replace")
                                  for t, r in zip(raw, results, strict=True)], whole.type)
            arrays[names.index(text)] = whole
        span = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
        arrays += [pa.array([r[0] for r in results], pa.int64()), pa.array([r[1] for r in results], span),
                   pa.array([r[2] for r in results], pa.list_(pa.string()))]
        return pa.RecordBatch.from_arrays(arrays, names=[field.name for field in schema])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tokens, sizes, words = [], [], [], 0
        number = shared.value.numbers.get
        for whole in batches:
            # Texts may be long, so a batch is taken in parts.
            for batch in _parts(whole, text):
                for one in batch.column(text).cast(pa.binary()):
                    found = split_words(one.as_py() or b"")
                    # A 0 follows each document.
                    ids = np.fromiter((number(w, 0) for w in found), np.int32, len(found))
                    tokens += [ids, np.zeros(1, np.int32)]
                    sizes.append(len(found))
                    words += len(found)
                held.append(batch)
                if words >= shard_words:
                    for part in _search_shard(held, tokens, sizes, shared.value):
                        yield finish(*part)
                    held, tokens, sizes, words = [], [], [], 0
        for part in _search_shard(held, tokens, sizes, shared.value):
            yield finish(*part)

    return map_arrow(docs, search, schema)


def _parts(batch: pa.RecordBatch, text: str, most: int = 16_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with some bytes of text each, one row at least."""
    lengths = np.array(pc.binary_length(batch.column(text)).fill_null(0), np.int64)
    part = np.cumsum(lengths) // most
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(lengths)]
    for a, b in zip(edges, edges[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW, carry: list[str] | None = None,
    cutting: bool = False, block_bytes: int = BLOCK_BYTES, shard_words: int = SHARD_WORDS,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """Documents with ``n_words``, ``spans`` and ``items``; with ``cutting``, without the spans.

    A window is ``window`` consecutive words of an item; an item with fewer is one window. ``spans``
    are the first and last word (from 0) of each stretch that windows cover, merged where they
    overlap or touch, ``items`` the ids, as strings in their order, of items with a window in the text.

    Items go to the tasks in blocks of about ``block_windows`` windows and ``block_bytes`` of text, and
    documents are written between two blocks, so a driver or task holds one block at a time and its size
    is bounded; an item is not cut. A shard of documents has about ``shard_words`` words, or one document.

    Null and empty texts have no words and no spans. Items without words have no window; an item
    without an id covers words but is not listed. Rows that repeat are treated alike; repeated items
    count once by id. An empty table gives an empty one, whichever side it is. ``carry`` names the columns of ``docs`` to return (default: all). Columns of
    the input with the names of result columns are replaced.
    """
    # Runs of word characters, counted without laying the words out.
    held = F.regexp_count(F.coalesce(F.col(item_text), F.lit("")), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
    size, windows = benchmark.agg(
        F.sum(F.octet_length(item_text)), F.sum(F.greatest(held - (window - 1), F.lit(1)))
    ).first()
    blocks = max(1, math.ceil((size or 0) / block_bytes), math.ceil((windows or 0) / block_windows))
    source = without(docs, "found_words", "found_spans", "found_items")
    carry = list(carry if carry is not None else without(source, "n_words", "spans", "items").columns)
    rows = source.select(*[quoted(name) for name in dict.fromkeys([*carry, text])])
    items = benchmark.select(
        F.col(item_id).cast("string").alias("id"), F.encode(F.coalesce(F.col(item_text), F.lit("")), "UTF-8").alias("text")
    )
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("text", "id"), F.lit(blocks)) == block)
        phrases = Phrases.of([(r["id"], bytes(r["text"])) for r in part.collect()], window)
        rows = _pass(rows, phrases, text, carry, block == blocks - 1, cutting, shard_words)
        if block < blocks - 1:
            rows = stash(rows, "decontaminate-pass")
    return rows.withColumnsRenamed(
        {"found_words": "n_words", "found_spans": "spans", "found_items": "items"}
    )


def without_benchmark(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents, with their own columns, and the benchmark's passages cut out of their texts.

    Every document stays; one that is nothing but passages stays with what stood around them. Null and
    empty texts stay as they are, columns may have any names, and the text column is found by its name as
    Spark compares names. Other edge cases are those of ``decontaminate``.
    """
    renamed = docs.toDF(*[f"c{n}" for n in range(len(docs.columns))])
    wanted = options.pop("text", "text").lower()
    text = renamed.columns[[name.lower() for name in docs.columns].index(wanted)]
    cleaned = decontaminate(renamed, benchmark, text=text, cutting=True, **options)
    return cleaned.select(*renamed.columns).toDF(*docs.columns)
