"""A corpus from raw documents to training shards, in five stages of the llm operators.

Every stage takes any table with the columns of ``documents`` and returns the same columns, all but the
last one, with further columns of any name left as they are. An empty table gives an empty one. What a
stage does with nulls, empty and very long texts, ties and repeated rows is said at the stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from relaybook.llm import decontaminate, mixing, quality, shards, simhash
from relaybook.llm.common import stash, table
from relaybook.llm.queries import SHARDS


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that the rules reject go.

    Null and empty texts have no words and go. A text is judged whole and by itself, so equal rows stay or
    go together. The language is read from ``lang``; a null one is not known.
    """
    return quality.keep_good(docs, lang="lang")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: of each class of near copies, the document with the smallest id stays.

    Null and empty texts are one class. A null id is behind all others. Of rows equal in id and text one
    stays; classes that share their smallest id keep a row each.
    """
    return simhash.one_of_each(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: passages of benchmark items are cut out; their documents stay.

    Null and empty texts stay as they are, equal rows are cut alike, and items without words cut nothing.
    """
    return decontaminate.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents as often as the mix takes them, in training order.

    Texts without words are not taken, a document is taken twice at most, and null sources are one source.
    Equal positions are ordered by a hash of the row.
    """
    return mixing.mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: where each document of the mix is stored.

    A row for each copy, which share a virtual slot and have slots of their own; null texts have 16 bytes.
    """
    placed = shards.shard(docs, SHARDS, carry=["doc_id", "source"])
    return placed.select("doc_id", "source", "size", "text_crc32", "shard", "slot", "virtual_slot")


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_passages),
    ("mixing sources", mixture),
    ("sharding", sharding),
]

#: Stage 2 rests on 64-bit hashes that SQL lacks; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
