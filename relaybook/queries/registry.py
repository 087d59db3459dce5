"""Registry of queries, and the SQL pieces several of them share."""

from __future__ import annotations

import functools
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


class Query(NamedTuple):
    run: Run
    sql: str


REGISTRY: dict[str, Query] = {}


def query(sql: str) -> Callable[[Run], Run]:
    """Register a function under its name, next to its SQL."""

    def register(run: Run) -> Run:
        @functools.wraps(run)
        def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
            # The tables hold times without a zone, and the SQL reads them as UTC.
            zone = spark.conf.get("spark.sql.session.timeZone")
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            try:
                return run(spark, sf_dir)
            finally:
                spark.conf.set("spark.sql.session.timeZone", zone)

        REGISTRY[run.__name__] = Query(in_utc, sql)
        return run

    return register


def sql_words(text: str, table: str, keep: str = "") -> str:
    """A SELECT of the words of a text column, one row each."""
    return f"""
        SELECT {keep} unnest(CASE
            WHEN {text} = '' THEN ['']
            WHEN rtrim({text}, ' ') = '' THEN []
            ELSE string_split(rtrim({text}, ' '), ' ') END) AS word
        FROM {table}"""
