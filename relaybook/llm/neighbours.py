"""Nearest neighbours by counted collisions: sorted projections, windows that widen, verified vectors.

Vectors are cut into shards of bounded size, and each shard keeps one sorted array for every
projection. A query opens a window around its own projection in each array. A vector in enough windows
has collided often enough to be looked at; if the best ones found are not yet near enough for the
present radius, all windows widen together, as if the projections had been cut into wider buckets anew.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relaybook.llm.common import map_arrow, stash

#: Vectors of one shard, about; a task holds the shard and its sorted projections (3 KB a vector).
SHARD_ROWS = 16_384
PROJECTIONS = 48
#: Half the width of a window, in radii.
REACH = 1.0
#: Chance that a vector within the radius collides too seldom.
MISSED = 0.05
#: How much the radius grows from round to round, and its beginning beside the third nearest vector tried.
GROWTH = 1.12
BEGIN = 0.95
#: Vectors whose distances tell where to begin; any beginning gives right results.
TRIED = 256
SEED = 13

FOUND = "query_no long, vector_no long, score double"


def threshold(projections: int = PROJECTIONS, reach: float = REACH, missed: float = MISSED) -> int:
    """Collisions that a vector at the radius has with a chance of ``1 - missed`` at least.

    The difference of two projections is normal with the distance as its deviation, so at the radius
    a projection collides with the chance of a normal value within ``reach``.
    """
    chance = math.erf(reach / math.sqrt(2))
    below = 0.0
    for hits in range(projections + 1):
        below += math.comb(projections, hits) * chance**hits * (1 - chance) ** (projections - hits)
        if below > missed:
            return hits
    return projections


def directions(size: int, count: int = PROJECTIONS, seed: int = SEED) -> np.ndarray:
    """Random directions (count, size), orthogonal in blocks, as long as normal vectors are on average."""
    random = np.random.default_rng(seed)
    blocks = [np.linalg.qr(random.standard_normal((size, size)))[0] for _ in range(-(-count // size))]
    return np.concatenate(blocks)[:count] * math.sqrt(size)


class Shard:
    """Vectors with sorted projections.

    For inner products, vectors are scaled by the largest norm and get one more component that makes
    them all of length 1; a query of length 1 with 0 there is nearest where the product is largest.
    """

    def __init__(self, vectors: np.ndarray, numbers: np.ndarray, ids: np.ndarray, scale: float):
        self.vectors, self.numbers, self.ids, self.scale = vectors, numbers, ids, scale
        scaled = vectors / scale
        spare = np.sqrt(np.maximum(0.0, 1.0 - (scaled * scaled).sum(1)))
        self.axes = directions(vectors.shape[1] + 1)
        projected = self.axes @ np.column_stack([scaled, spare]).T
        self.order = np.argsort(projected, axis=1, kind="stable")
        self.sorted = np.take_along_axis(projected, self.order, axis=1)
        self.least = threshold()
        step = max(1, len(vectors) // TRIED)
        self.tried = np.column_stack([scaled, spare])[::step]

    def nearest(self, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the ``k`` vectors with the largest inner products, ties to smaller ids.

        A vector within the last radius is found with the chance of 1 - MISSED at least, and the last
        radius holds the k-th vector found; the search ends earlier only if all were looked at.
        """
        n = len(self.vectors)
        size = np.abs(query).max()
        unit = query / size
        length = math.sqrt((unit * unit).sum())
        unit = np.append(unit / length, 0.0)
        at = self.axes @ unit
        collisions, seen = np.zeros(n, np.int64), np.zeros(n, bool)
        low = [int(row.searchsorted(x)) for row, x in zip(self.sorted, at, strict=True)]
        high = list(low)
        # Not the nearest one tried, which may be the query itself or a copy of it.
        gaps = ((self.tried - unit) ** 2).sum(1)
        gap = np.partition(gaps, 2)[2] if len(gaps) > 2 else gaps.max()
        radius = max(1e-3, BEGIN * math.sqrt(gap))
        places, scores = np.zeros(0, np.int64), np.zeros(0)
        while True:
            met = []
            for j, (row, order, x) in enumerate(zip(self.sorted, self.order, at.tolist(), strict=True)):
                first, last = row.searchsorted((x - radius * REACH, x + radius * REACH)).tolist()
                if first < low[j]:
                    met.append(order[first:low[j]])
                    low[j] = first
                if last > high[j]:
                    met.append(order[high[j]:last])
                    high[j] = last
            if met:
                collisions += np.bincount(np.concatenate(met), minlength=n)
            fresh = np.flatnonzero((collisions >= self.least) & ~seen)
            seen[fresh] = True
            places = np.concatenate([places, fresh])
            # Where many are to be verified, going through all in order is faster than picking them.
            many = 4 * len(fresh) > n
            scores = np.concatenate([scores, (self.vectors @ query)[fresh] if many else self.vectors[fresh] @ query])
            if len(places) > k:
                # A little more than k, as these sums may differ in their last digits.
                limit = np.partition(scores, -k)[-k] - 1e-9 * abs(scores).max()
                near = scores >= limit
                places, scores = places[near], scores[near]
            if len(places) >= k or seen.all():
                worst = np.sort(scores)[-k:].min() / (size * length * self.scale) if len(places) else -1.0
                if seen.all() or math.sqrt(max(0.0, 2 - 2 * worst)) <= radius:
                    # One sum per row, always in the same order, so that equal vectors score alike.
                    scores = (self.vectors[places] * query).sum(1)
                    best = np.lexsort((self.ids[places], -scores))[:k]
                    return places[best], scores[best]
            radius *= GROWTH


def _search(rows: DataFrame, k: int, scale: float) -> DataFrame:
    """Answers (query_no, vector_no, score) of rows that come as whole shards: vectors, then queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, parts, shard = None, [], None
        for batch in batches:
            shards, kinds, numbers, ids = (
                batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "kind", "number", "first_id")
            )
            vectors = batch.column("vector")
            cuts = [0, *(np.flatnonzero((np.diff(shards) != 0) | (np.diff(kinds) != 0)) + 1), len(batch)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                values = vectors.slice(a, b - a).flatten().to_numpy(zero_copy_only=False).astype(float)
                values = values.reshape(b - a, -1)
                if shards[a] != own:
                    own, parts, shard = shards[a], [], None
                if kinds[a] == 0:
                    parts.append((values, numbers[a:b], ids[a:b]))
                    continue
                if shard is None and parts:
                    shard = Shard(*[np.concatenate(x) for x in zip(*parts, strict=True)], scale)
                    parts = []
                if shard is not None:
                    found = [shard.nearest(v, k) for v in values]
                    sizes = [len(p) for p, _ in found]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.repeat(numbers[a:b], sizes)),
                        pa.array(shard.numbers[np.concatenate([p for p, _ in found])]),
                        pa.array(np.concatenate([s for _, s in found])),
                    ], names=["query_no", "vector_no", "score"])

    return map_arrow(rows, run, FOUND)


def takes_part(vector: Column) -> Column:
    """True for vectors without null, NaN or infinite components that are not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(
    rows: DataFrame, asked: Column, k: int = 20, row_id: str = "vec_id", vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """For each row that ``asked`` (a condition on the id) marks, its ``k`` nearest other rows by inner product.

    Returns query_id, rank (from 1), vec_id and score, the product of the given vectors in double
    precision. Every vector is indexed. The search is approximate: each vector among the nearest is
    found with a chance of 1 - MISSED at least, whatever the vectors are like.

    Equal vectors are indexed once, with their smallest ids, so any number of copies costs one vector.
    Ties go to the smaller id, null ids last. Vectors that are null, empty, zero, or hold null or
    non-finite components take no part; vectors are compared with those of the same length. Rows equal
    in id and vector count as one row; rows of one id with different vectors are rows of their own, and
    each asks for itself. With fewer than ``k`` others all of them are returned; an empty table gives
    no rows. Other columns, whatever their names, are not read.
    """
    some = k + 1  # the query's own row may be among them
    able = rows.select(F.col(row_id).cast("long").alias("id"), F.col(vector).alias("vector")).filter(
        takes_part(F.col("vector"))
    )
    copies = Window.partitionBy("hash", "vector").orderBy(F.col("id").asc_nulls_last())
    distinct = able.distinct().withColumn("hash", F.xxhash64("vector")).withColumn(
        "place", F.row_number().over(copies)
    ).filter(F.col("place") <= some)
    indexed = stash(distinct.groupBy("hash", "vector").agg(
        F.collect_list(F.struct("id")).alias("ids"),
        F.min(F.coalesce("id", F.lit((1 << 63) - 1))).alias("first_id"),
    ).withColumn("number", F.monotonically_increasing_id()), "neighbours-vectors")
    asking = able.filter(asked).distinct().withColumn("hash", F.xxhash64("vector"))
    queries = stash(asking.join(indexed.select("hash", "vector", "number"), ["hash", "vector"]).select(
        F.col("id").alias("query_id"), F.col("number").alias("query_no")
    ), "neighbours-queries")

    sizes = indexed.groupBy(F.size("vector").alias("size")).agg(
        F.ceil(F.count("*") / shard_rows).alias("shards")
    )
    before = Window.orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("first_shard", F.coalesce(F.sum("shards").over(before), F.lit(0)))
    sizes = stash(sizes, "neighbours-shards")
    shards = sizes.agg(F.sum("shards")).first()[0]
    if shards is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    wide = F.transform("vector", lambda x: x.cast("double"))
    largest = indexed.agg(F.max(F.array_max(F.transform(wide, lambda x: F.abs(x))))).first()[0]
    squares = F.aggregate(wide, F.lit(0.0), lambda a, x: a + (x / largest) * (x / largest))
    scale = largest * math.sqrt(indexed.agg(F.max(squares)).first()[0])

    placed = indexed.select("number", "first_id", "vector", F.size("vector").alias("size")).join(sizes, "size")
    members = placed.select(
        (F.col("first_shard") + F.pmod(F.xxhash64("number"), F.col("shards"))).cast("int").alias("shard"),
        F.lit(0).alias("kind"), "number", "first_id", "vector",
    )
    every = F.sequence(F.col("first_shard"), F.col("first_shard") + F.col("shards") - 1).cast("array<int>")
    questions = placed.join(
        queries.select(F.col("query_no").alias("number")).distinct(), "number"
    ).select(F.explode(every).alias("shard"), F.lit(1).alias("kind"), "number", "first_id", "vector")
    dealt = members.unionAll(questions).repartitionById(int(shards), F.col("shard"))
    answers = stash(
        _search(dealt.sortWithinPartitions("shard", "kind"), some, scale), "neighbours-answers"
    )

    by_query = Window.partitionBy("query_no").orderBy(F.desc("score"), F.col("first_id"))
    known = indexed.select(F.col("number").alias("vector_no"), "first_id", "ids")
    best = answers.join(known.select("vector_no", "first_id"), "vector_no").withColumn(
        "place", F.row_number().over(by_query)
    ).filter(F.col("place") <= some)
    each = best.join(known.select("vector_no", "ids"), "vector_no").select(
        "query_no", "vector_no", "score", F.inline("ids").alias("id")
    )
    order = [F.desc("score"), F.col("id").asc_nulls_last(), F.col("vector_no")]
    listed = each.withColumn("place", F.row_number().over(Window.partitionBy("query_no").orderBy(*order))).filter(
        F.col("place") <= some
    )
    others = queries.join(listed, "query_no").filter(
        ~((F.col("vector_no") == F.col("query_no")) & F.col("id").eqNullSafe(F.col("query_id")))
    )
    ranks = F.row_number().over(Window.partitionBy("query_id", "query_no").orderBy(*order))
    return others.withColumn("rank", ranks).filter(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias("vec_id"), "score"
    )
