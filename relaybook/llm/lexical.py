"""Ranked lexical search by best positions over impact lists.

Documents are dealt to shards of bounded size. A shard keeps, for every term that is asked for, a list
of documents by falling impact. A search reads the lists of its terms side by side from the top, looks
every new document up in all of them, and marks the positions it meets. A list's best position is the
last one before which all have been seen, so no unseen document can score more than the sum of the
impacts at the best positions; when that is strictly below the k-th score, the search is over.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from relaybook.llm.common import map_arrow, stash

#: Entries of one shard's lists, about; a task holds them all (50 bytes each).
SHARD_ENTRIES = 1_000_000
#: Positions that are read from every list before the threshold is looked at again.
STEP = 64

# Bytes of terms: letters, digits and whatever is not ASCII; A-Z is lowered, the rest parts terms.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or re.match(rb"[0-9a-z]", bytes([b])) else 32 for b in range(256)
)
FOUND = "item_no long, doc_row long, score long"


def terms(text: bytes) -> Counter[bytes]:
    """The terms of a text and how often each occurs."""
    return Counter(text.translate(_TERM_BYTES).split())


def counted(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with ``text`` replaced by its number of terms ``n`` and its ``entries``, each a term and its count.

    The first entry of a row has the empty term, which stands for the row itself.
    """
    names = [name for name in rows.columns if name != text]
    kind = pa.list_(pa.struct([("term", pa.string()), ("tf", pa.int64())]))
    schema = rows.drop(text).withColumn("n", F.lit(0).cast("long")).withColumn(
        "entries", F.array().cast("array<struct<term: string, tf: bigint>>")
    ).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text).cast(pa.binary())
            for start in range(0, len(batch), 256):
                words, counts, offsets, sizes = [], [], [0], []
                for found in (terms(t.as_py() or b"") for t in texts.slice(start, 256)):
                    sizes.append(found.total())
                    words += [b"", *found]
                    counts += [1, *found.values()]
                    offsets.append(len(words))
                entries = pa.StructArray.from_arrays(
                    [pa.array(words, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())],
                    fields=list(kind.value_type),
                )
                part = batch.slice(start, 256)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(name) for name in names], pa.array(sizes, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), entries)],
                    names=[field.name for field in schema],
                )

    return map_arrow(rows, run, schema)


class Lists:
    """Impact lists of a shard: per term its documents by falling impact, and by number for direct access."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, doc_id: np.ndarray, impact: np.ndarray):
        self.rows, place = np.unique(doc, return_inverse=True)
        self.doc_ids = np.zeros(len(self.rows), np.int64)
        self.doc_ids[place] = doc_id
        by_impact = np.lexsort((place, -impact, term))
        self.terms, starts = np.unique(term[by_impact], return_index=True)
        self.bounds = [*starts.tolist(), len(term)]
        self.docs, self.impacts = place[by_impact].astype(np.int32), impact[by_impact]
        by_doc = np.lexsort((self.docs, term[by_impact]))
        self.sorted_docs, self.sorted_at = self.docs[by_doc], by_doc

    def of(self, term: int) -> tuple[np.ndarray, ...] | None:
        """A term's documents and impacts from the top, and its documents in order with their positions."""
        at = int(np.searchsorted(self.terms, term))
        if at == len(self.terms) or self.terms[at] != term:
            return None
        a, b = self.bounds[at], self.bounds[at + 1]
        return self.docs[a:b], self.impacts[a:b], self.sorted_docs[a:b], self.sorted_at[a:b] - a

    def best(self, asked: list[int], weights: list[int], k: int, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the ``k`` documents with the highest scores above 0, ties to smaller ids."""
        lists = [(*found, w) for t, w in zip(asked, weights, strict=True) if w > 0 and (found := self.of(t))]
        met = [np.zeros(len(docs) + 1, bool) for docs, *_ in lists]
        best_at = [0] * len(lists)
        seen = np.zeros(len(self.rows), bool)
        places, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        depth, longest = 0, max((len(docs) for docs, *_ in lists), default=0)
        while depth < longest:
            read = np.unique(np.concatenate([docs[depth:depth + step] for docs, *_ in lists]))
            fresh = read[~seen[read]]
            seen[fresh] = True
            total = np.zeros(len(fresh), np.int64)
            for (_, impacts, sorted_docs, sorted_at, weight), marks in zip(lists, met, strict=True):
                at = np.minimum(sorted_docs.searchsorted(fresh), len(sorted_docs) - 1)
                held = sorted_docs[at] == fresh
                positions = sorted_at[at[held]]
                marks[positions] = True
                total[held] += weight * impacts[positions]
            places, scores = np.concatenate([places, fresh]), np.concatenate([scores, total])
            if len(places) > k:
                order = np.lexsort((self.doc_ids[places], -scores))[:k]
                places, scores = places[order], scores[order]
            depth += step
            limit = 0
            for n, ((_, impacts, *_, weight), marks) in enumerate(zip(lists, met, strict=True)):
                # The mark behind the last position is never set, so a gap is always found.
                best_at[n] += int(np.argmin(marks[best_at[n]:]))
                if best_at[n] < len(impacts):
                    # A list that was seen to its end has no unseen document.
                    limit += weight * int(impacts[max(0, best_at[n] - 1)])
            if len(places) == k and limit < scores.min():
                break
        above = scores > 0
        return places[above], scores[above]


def _search(rows: DataFrame, k: int) -> DataFrame:
    """Answers (item_no, doc_row, score) of rows that come as whole shards: list entries, then items.

    A row of kind 0 has a term, a document and an impact; one of kind 1 an item, a term and its weight.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, parts, lists, item, asked = None, [], None, None, []

        def answer() -> Iterator[pa.RecordBatch]:
            if lists is not None and asked:
                found = np.concatenate(asked, axis=1)
                places, scores = lists.best(found[0].tolist(), found[1].tolist(), k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(places), item)), pa.array(lists.rows[places]), pa.array(scores)],
                    names=["item_no", "doc_row", "score"],
                )

        for batch in batches:
            shards, kinds, number, doc, doc_id, impact = (
                batch.column(c).to_numpy() for c in ("shard", "kind", "number", "doc_row", "doc_id", "impact")
            )
            changed = (np.diff(shards) != 0) | (np.diff(kinds) != 0) | ((np.diff(number) != 0) & (kinds[1:] == 1))
            cuts = [0, *(np.flatnonzero(changed) + 1), len(batch)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if shards[a] != own:
                    yield from answer()
                    own, parts, lists, item, asked = shards[a], [], None, None, []
                if kinds[a] == 0:
                    parts.append([column[a:b] for column in (number, doc, doc_id, impact)])
                    continue
                if lists is None and parts:
                    lists, parts = Lists(*[np.concatenate(x) for x in zip(*parts, strict=True)]), []
                if number[a] != item:
                    yield from answer()
                    item, asked = number[a], []
                asked.append(np.stack([doc[a:b], impact[a:b]]))
        yield from answer()

    return map_arrow(rows, run, FOUND)


def ranked(
    docs: DataFrame, items: DataFrame, k: int = 20, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", shard_entries: int = SHARD_ENTRIES,
) -> DataFrame:
    """For each item the ``k`` documents with the highest scores above 0: item_id, rank, doc_id, score.

    Every document is ranked by its whole text, however long; the result is exact. N, L, the document
    frequencies and the lists cover all documents. Lists are kept for the terms of the items only.

    Null and empty texts have no terms; they are no documents of the statistics, and as items get no
    rows. Equal scores are ranked by ascending id, null ids last. Repeated documents are documents of
    their own and repeated items are asked each for itself. An empty table gives no rows. Other columns,
    whatever their names, are not read.
    """
    numbered = stash(items.select(
        F.col(item_id).alias("item_id"), F.col(item_text).alias("text"),
    ).withColumn("item_no", F.monotonically_increasing_id()), "lexical-items")
    asked = stash(counted(numbered.select("item_no", "text"), "text").select(
        "item_no", F.inline("entries")
    ).filter("term <> ''"), "lexical-asked")
    vocabulary = stash(
        asked.select("term").distinct().withColumn("term_no", F.monotonically_increasing_id())
        # The row of the empty term is each document itself.
        .unionAll(items.sparkSession.range(1).select(F.lit(""), F.lit(-1).cast("long"))), "lexical-terms",
    )
    # An id of the highest number stands for null, and is so behind all others.
    null_id = (1 << 63) - 1
    read = counted(docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(null_id)).alias("doc_id"), F.col(text).alias("text"),
    ), "text").filter("n > 0").withColumn("doc_row", F.monotonically_increasing_id())
    entries = stash(
        read.select("doc_row", "doc_id", "n", F.inline("entries")).join(vocabulary, "term").drop("term"),
        "lexical-entries",
    )
    count, length, held = entries.agg(
        F.count_if(F.col("term_no") < 0), F.sum(F.when(F.col("term_no") < 0, F.col("n"))), F.count_if(F.col("term_no") >= 0),
    ).first()
    entries = entries.filter("term_no >= 0")
    weighted = stash(entries.groupBy("term_no").agg(
        F.floor(1000 * F.log((2.0 * (count or 0) + 2) / (2 * F.count("*") + 1))).cast("long").alias("weight")
    ), "lexical-weights")
    questions = asked.join(vocabulary, "term").join(weighted, "term_no").select(
        "item_no", "term_no", (F.col("weight") * F.col("tf")).alias("weight")
    )

    shards = max(1, -(-held // shard_entries))
    measure = F.expr(f"75 + (25 * n * {count or 0}) div {length or 1}")
    impact = F.expr("(1000000000 * tf) div (1000 * tf + 12 * m)")
    lists = entries.withColumn("m", measure).select(
        F.pmod(F.xxhash64("doc_row"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("kind"),
        F.col("term_no").alias("number"), "doc_row", "doc_id", impact.alias("impact"),
    )
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    searches = questions.select(every, "*").select(
        "shard", F.lit(1).alias("kind"), F.col("item_no").alias("number"), F.col("term_no").alias("doc_row"),
        F.lit(0).cast("long").alias("doc_id"), F.col("weight").alias("impact"),
    )
    dealt = lists.unionAll(searches).repartitionById(shards, F.col("shard")).sortWithinPartitions(
        "shard", "kind", "number"
    )
    answers = stash(_search(dealt, k), "lexical-answers")
    # The rows that hold a document's id are few beside the answers only where answers are many.
    ids = entries.select("doc_row", "doc_id").join(
        answers.select("doc_row").distinct(), "doc_row", "left_semi"
    ).distinct()
    ranks = F.row_number().over(Window.partitionBy("item_no").orderBy(F.desc("score"), "doc_id", "doc_row"))
    first = answers.join(ids, "doc_row").withColumn("rank", ranks).filter(F.col("rank") <= k)
    return first.join(numbered.select("item_no", "item_id"), "item_no").select(
        "item_id", "rank", F.when(F.col("doc_id") < null_id, F.col("doc_id")).alias("doc_id"), "score"
    )
