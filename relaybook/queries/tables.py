"""The document table, and lines of text files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relaybook.operators.documents import document_lines
from relaybook.queries.fixtures import table
from relaybook.queries.registry import query
from relaybook.schemas import DOCUMENT
from relaybook.session import work_dir
from relaybook.sources import read_lines, read_table, typed_columns
from relaybook.sources.tables import slice_predicates, split_misfits
from relaybook.streaming.sinks import write_lines

_LINES = """
    SELECT doc_id AS id,
           concat('id: ', doc_id, chr(9), 'type: ', coalesce(lang, 'null'),
                  chr(9), 'authors: ', coalesce(source, 'null'),
                  chr(9), 'title: ', coalesce(split_part(text, chr(10), 1), 'null'),
                  chr(9), 'year:', 2000 + doc_id % 25) AS line
    FROM documents"""


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents under a name in the catalog, read back by position."""
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", F.substring_index("text", "\n", 1),
        (F.lit(2000) + F.col("doc_id") % 25).cast("string"),
    )
    name = f"doc1_{uuid.uuid4().hex}"
    rows.createTempView(name)
    try:
        return typed_columns(read_table(spark, name), DOCUMENT)
    finally:
        spark.catalog.dropTempView(name)


@query(_LINES)
def doc_table_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_lines(_documents(spark, sf_dir))


@query(f"{_LINES} ORDER BY id LIMIT 10")
def doc_table_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_lines(_documents(spark, sf_dir).orderBy("id").limit(10))


@query("""
    SELECT value, count(*) AS n
    FROM (SELECT unnest(string_split(text, chr(10))) AS value FROM documents) GROUP BY value""")
def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all ``.txt`` files in a folder tree, next to files of another kind."""
    folder = work_dir(spark, "text_lines")
    documents = table(spark, sf_dir, "documents")
    for_language = documents.select("lang", "text").write.partitionBy("lang")
    for_language.text(f"{folder}/tree/texts")
    documents.select("doc_id", "source").write.csv(f"{folder}/tree/lists")
    lines = read_lines(spark, f"{folder}/tree", name_glob="*.txt", recursive=True)
    return lines.groupBy("value").agg(F.count("*").alias("n"))


@query("""
    SELECT line, count(*) AS n FROM (
        SELECT concat(event_type, ' ', user_id) AS line FROM events) GROUP BY line""")
def text_sink_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines written to text files and read back."""
    folder = work_dir(spark, "text_sink_lines")
    lines = table(spark, sf_dir, "events").select(
        F.concat("event_type", F.lit(" "), F.col("user_id").cast("string")).alias("value")
    )
    write_lines(lines, f"{folder}/out")
    found = read_lines(spark, f"{folder}/out")
    return found.groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))


@query("""
    SELECT doc_id AS id, lang AS type, source AS authors, n_chars::VARCHAR AS title,
        CASE WHEN doc_id % 6 = 0 THEN 'n/a' WHEN doc_id % 6 = 1 THEN NULL ELSE (2000 + doc_id % 25)::VARCHAR END AS year,
        CASE WHEN doc_id % 6 = 0 THEN 'year' ELSE '' END AS misfits
    FROM documents""")
def doc_table_misfits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document table with years that are no numbers: typed rows, and rejected ones with the reason."""
    year = F.when(F.col("doc_id") % 6 == 0, "n/a").when(F.col("doc_id") % 6 != 1, (2000 + F.col("doc_id") % 25).cast("string"))
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars", year)
    fitting, rejected = split_misfits(rows, DOCUMENT)
    fitting = fitting.withColumn("misfits", F.lit("")).withColumn("year", F.col("year").cast("string"))
    rejected = rejected.withColumn("misfits", F.array_join("misfits", ",")).withColumn("title", F.col("title").cast("string"))
    return fitting.unionByName(rejected)


@query("SELECT doc_id, 1 AS slices FROM documents")
def doc_table_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slices that a read over JDBC would use: each document is in one of them, nulls too."""
    documents = table(spark, sf_dir, "documents").withColumn("size", F.nullif("n_chars", F.lit(0)))
    conditions = slice_predicates(documents, "size", 12)
    held = [F.coalesce(F.expr(c), F.lit(False)).cast("int") for c in conditions]
    return documents.select("doc_id", sum(held[1:], held[0]).alias("slices"))
