"""A Merkle manifest: leaves of a dataset, levels of parent-linked nodes, and proofs by recursive climb.

Every row is a leaf. The leaves of a group (a language) form a binary tree, and the groups' roots form
another one above them. A stored node row leads to its parent and holds its sibling, so a proof is a
recursive query that goes up one node row at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relaybook.llm.common import quoted, stash
from relaybook.session import work_dir

#: The tree of the groups' roots; the groups' own trees are numbered from 0.
TOP = -1
_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"
_AUTO_BUCKETS = "spark.sql.sources.bucketing.autoBucketedScan.enabled"


class Manifest(NamedTuple):
    #: row, doc_id, leaf, changed, lang, tree, pos: a leaf's digest, and that of its changed row.
    leaves: DataFrame
    #: tree, subroot
    subroots: DataFrame
    #: tree, level, pos, up_tree, up_level, up_pos, sibling, sibling_first
    nodes: DataFrame
    #: Hex digest; null for an empty table.
    root: str | None


def part(value: Column) -> Column:
    """A value as the hash reads it: its length in bytes, a colon and itself, or ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[part(v) for v in values]), 256))


def hex_text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def parent(*digests: Column) -> Column:
    """The digest over the hex texts of some digests; null ones are left out."""
    return F.unhex(F.sha2(F.concat(*[F.coalesce(hex_text(d), F.lit("")) for d in digests]), 256))


def added_one(doc_id: Column, n_chars: Column) -> Column:
    """``n_chars``, one more where 7 divides the checksum of the id (a null id has none)."""
    wide = n_chars.cast("decimal(38,0)")
    return F.when(F.crc32(doc_id.cast("string")) % 7 == 0, wide + 1).otherwise(wide)


def placed(rows: DataFrame, group: list[str], order: list[str], purpose: str) -> DataFrame:
    """``rows`` with ``row``, a number of their own, and ``pos``, their place in the group from 0.

    Rows are sorted by range and numbered inside each task; the ranges' counts, which are as many as
    tasks and groups, give the places before. So a group that holds most rows spreads over all tasks,
    also where its rows are equal: a salt takes part in the ranges.
    """
    key = [quoted(name) for name in (*group, *order)]
    salted = rows.withColumn("salt", F.monotonically_increasing_id())
    ordered = salted.repartitionByRange(*key, F.col("salt")).sortWithinPartitions(*key, "salt")
    numbered = stash(ordered.drop("salt").withColumn("row", F.monotonically_increasing_id()), purpose)
    # Above its lowest 33 bits, a number tells its task.
    counted = numbered.withColumn("task", F.shiftright("row", 33))
    bounds = counted.groupBy("task", *group).agg(F.min("row").alias("first_row"), F.count("*").alias("held"))
    before = (
        f"coalesce(sum(held) over (partition by {', '.join(['0', *[f'`{g}`' for g in group]])} "
        "order by task rows between unbounded preceding and 1 preceding), 0)"
    )
    starts = bounds.withColumn("start", F.expr(before)).select(
        F.col("task").alias("own_task"), *[F.col(g).alias(f"own_{g}") for g in group], "first_row", "start"
    )
    same = F.col("task") == F.col("own_task")
    for name in group:
        same &= quoted(name).eqNullSafe(F.col(f"own_{name}"))
    return counted.join(starts, same).select(
        *[quoted(n) for n in numbered.columns],
        (F.col("start") + F.col("row") - F.col("first_row")).alias("pos"),
    )


def runs(level: DataFrame) -> DataFrame:
    """The pairs of a level (tree, level, pos, n, digest), and single last nodes, of trees with ``n`` > 1 nodes.

    A run is known by its parent's place; it holds its one or two members and the parent's digest.
    """
    member = F.struct("pos", "digest")
    pairs = level.filter("n > 1").groupBy("tree", "level", F.expr("pos div 2").alias("up")).agg(
        F.min(member).alias("first"), F.max(member).alias("last"), F.max("n").alias("n")
    )
    second = F.when(F.col("last.pos") > F.col("first.pos"), F.col("last.digest"))
    return pairs.select(
        "tree", "level", "up", "first", "last", "n", parent(F.col("first.digest"), second).alias("digest")
    )


def climbed(level: DataFrame, most: int, purpose: str) -> tuple[list[DataFrame], DataFrame]:
    """The runs of all levels above one, and the top node (tree, level, digest) of each tree."""
    found, tops = [], level.filter("n = 1").select("tree", "level", "digest")
    while most > 1:
        found.append(stash(runs(level), purpose))
        level = found[-1].select(
            "tree", (F.col("level") + 1).alias("level"), F.col("up").alias("pos"),
            F.expr("(n + 1) div 2").alias("n"), "digest",
        )
        tops = tops.unionAll(level.filter("n = 1").select("tree", "level", "digest"))
        most = (most + 1) // 2
    return found, tops


def linked(found: DataFrame) -> DataFrame:
    """The node rows of runs: each member with its parent's place and its sibling, if any."""
    paired = F.col("last.pos") > F.col("first.pos")
    left = F.struct(
        F.col("first.pos").alias("pos"), F.when(paired, F.col("last.digest")).alias("sibling"),
        F.lit(False).alias("sibling_first"),
    )
    right = F.struct(
        F.col("last.pos").alias("pos"), F.col("first.digest").alias("sibling"),
        F.lit(True).alias("sibling_first"),
    )
    members = F.explode(F.when(paired, F.array(left, right)).otherwise(F.array(left))).alias("member")
    return found.select("tree", "level", "up", members).select(
        "tree", "level", "member.pos", F.col("tree").alias("up_tree"),
        (F.col("level") + 1).alias("up_level"), F.col("up").alias("up_pos"),
        "member.sibling", "member.sibling_first",
    )


def build(
    docs: DataFrame, doc_id: str = "doc_id", group: str = "lang", fields: tuple[str, ...] = (
        "doc_id", "source", "lang", "n_chars", "text"),
    changed: Callable[[], dict[str, Column]] | None = None,
) -> Manifest:
    """Leaves, node rows and root of a table; ``changed`` replaces fields for the leaves' other digest.

    Leaves of a group stand in the order of ``doc_id`` (null first) and then of their digest, so equal
    rows are next to each other and the manifest does not depend on how the table is stored. Null
    fields, empty and long texts are hashed whole, each by its own mark; a null group is a group like
    others and the first. Repeated rows are a leaf each. An empty table has no root. Other columns,
    whatever their names, are not read.
    """
    plain = {name: quoted(name) for name in fields}
    other = plain | (changed() if changed else {})
    leaves = stash(docs.select(
        quoted(doc_id).alias("doc_id"), quoted(group).alias("lang"),
        leaf(*plain.values()).alias("leaf"), leaf(*other.values()).alias("changed"),
    ), "merkle-leaves")
    ordered = placed(leaves, ["lang"], ["doc_id", "leaf"], "merkle-ordered")
    groups = stash(ordered.groupBy("lang").agg(F.count("*").alias("n")), "merkle-groups")
    trees = stash(placed(groups, [], ["lang"], "merkle-order").select(
        F.col("lang").alias("own_lang"), F.col("pos").alias("tree"), "n"
    ), "merkle-trees")
    leaves = stash(
        ordered.join(trees, F.col("lang").eqNullSafe(F.col("own_lang"))).drop("own_lang"), "merkle-placed"
    )
    zero = F.lit(0)
    most, count = trees.agg(F.max("n"), F.count("*")).first()
    below, subroots = climbed(
        leaves.select("tree", zero.alias("level"), "pos", "n", F.col("leaf").alias("digest")), most or 0,
        "merkle-runs",
    )
    subroots = stash(subroots, "merkle-subroots")
    above, top = climbed(
        subroots.select(
            F.lit(TOP).cast("long").alias("tree"), zero.alias("level"), F.col("tree").alias("pos"),
            F.lit(count).alias("n"), "digest",
        ), count, "merkle-top",
    )
    found = top.select(hex_text(F.col("digest"))).first()
    nodes = [linked(level) for level in below]
    if above:
        # The lowest nodes of the upper tree are the groups' roots, and stand under those addresses.
        first = linked(above[0]).drop("tree", "level")
        roots = subroots.select("tree", "level")
        nodes.append(first.join(roots, first.pos == roots.tree).select(
            roots.tree, roots.level, F.lit(0).cast("long").alias("pos"), "up_tree", "up_level", "up_pos",
            "sibling", "sibling_first",
        ))
    nodes += [linked(level) for level in above[1:]]
    schema = leaves.select(
        "tree", zero.alias("level"), "pos", F.col("tree").alias("up_tree"), zero.alias("up_level"),
        F.col("pos").alias("up_pos"), F.col("leaf").alias("sibling"), F.lit(True).alias("sibling_first"),
    ).filter(F.lit(False))
    for more in nodes:
        schema = schema.unionAll(more)
    return Manifest(
        leaves, subroots.select("tree", hex_text(F.col("digest")).alias("subroot")), schema,
        found[0] if found else None,
    )


def climb(manifest: Manifest, start: str = "leaf", digest_only: bool = False) -> DataFrame:
    """Per leaf (row): ``folded``, the root recomputed from the column ``start`` and the stored siblings,
    and ``proof``, the siblings' hex texts from the leaf up, both made by one recursive query. With
    ``digest_only`` the proof, which grows with the height of the trees, is written as its digest.

    The query goes up a node row at a time for all leaves at once, and each step appends a sibling. The
    node rows lie in buckets of their address, so a step shuffles only the leaves' rows of 50 bytes or
    so; the number of steps is the height of the trees. Sibling rows are put together per leaf at the
    end, as many as the leaf has steps. The session's limit on a recursion's rows is lifted for this query.
    """
    spark = manifest.leaves.sparkSession
    name = f"merkle_{uuid.uuid4().hex}"
    address = ["tree", "level", "pos"]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid_out = manifest.nodes.repartition(buckets, *address)
    writer = laid_out.write.bucketBy(buckets, *address).option("path", work_dir(spark, "merkle-nodes"))
    writer.format("parquet").saveAsTable(f"{name}_nodes")
    manifest.leaves.createOrReplaceTempView(f"{name}_leaves")
    limit, automatic = spark.conf.get(_ROW_LIMIT), spark.conf.get(_AUTO_BUCKETS)
    spark.conf.set(_ROW_LIMIT, "-1")
    spark.conf.set(_AUTO_BUCKETS, "false")
    try:
        steps = spark.sql(f"""
            WITH RECURSIVE climb(row, tree, level, pos, step, folded, sibling) AS (
                SELECT row, tree, 0, pos, 0, {start}, CAST(NULL AS BINARY) FROM {name}_leaves
                UNION ALL
                SELECT c.row, n.up_tree, n.up_level, n.up_pos, c.step + 1,
                    unhex(sha2(concat(
                        IF(n.sibling_first, lower(hex(n.sibling)), ''), lower(hex(c.folded)),
                        IF(n.sibling_first, '', coalesce(lower(hex(n.sibling)), ''))), 256)),
                    n.sibling
                FROM climb c JOIN {name}_nodes n ON c.tree = n.tree AND c.level = n.level AND c.pos = n.pos)
            SELECT row, step, folded, sibling FROM climb""")
        siblings = F.transform(
            F.array_sort(F.collect_list(F.struct("step", "sibling"))),
            lambda s: F.coalesce(hex_text(s["sibling"]), F.lit("")),
        )
        proof = F.array_join(siblings, "")
        return stash(steps.groupBy("row").agg(
            hex_text(F.max_by("folded", "step")).alias("folded"),
            (F.sha2(proof, 256) if digest_only else proof).alias("proof"),
        ), "merkle-proofs")
    finally:
        spark.conf.set(_ROW_LIMIT, limit)
        spark.conf.set(_AUTO_BUCKETS, automatic)
        spark.catalog.dropTempView(f"{name}_leaves")
        spark.sql(f"DROP TABLE IF EXISTS {name}_nodes")


def verify(docs: DataFrame, changed: Callable[[], dict[str, Column]], **options) -> DataFrame:
    """Per row of ``docs``: its leaf, subroot, root, proof, and whether the changed row still leads to the root.

    ``changed`` gives the fields of rows that were changed since the manifest was built, as columns. The
    edge cases are those of ``build``.
    """
    manifest = build(docs, changed=changed, **options)
    proofs = climb(manifest, "changed", digest_only=True)
    rows = manifest.leaves.join(proofs, "row").join(manifest.subroots, "tree")
    root = F.lit(manifest.root).cast("string")
    return rows.select(
        "doc_id", hex_text(F.col("leaf")).alias("leaf"), "subroot", root.alias("root"),
        F.col("proof").alias("proof_sha256"), F.col("folded").alias("folded_root"),
        (F.col("folded") == root).alias("verified"),
    )
