"""Run a registered query and its SQL, and compare schema and rows."""

from __future__ import annotations

import collections
from pathlib import Path

import duckdb

# How a Spark type is written by DuckDB.
SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def sql_result(sql: str, sf_dir: str):
    with duckdb.connect() as con:
        for file in Path(sf_dir).glob("*.parquet"):
            con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
        found = con.execute(sql)
        names = [d[0] for d in found.description]
        types = {d[0]: str(d[1]) for d in found.description}
        return types, _bag(names, found.fetchall())


def spark_result(df):
    types = {name: SAME_TYPE[kind] for name, kind in df.dtypes}
    return types, _bag(df.columns, [tuple(row) for row in df.collect()])


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return collections.Counter(tuple(row[i] for i in order) for row in rows)


def check(query, spark, sf_dir: str) -> int:
    """Number of rows, once both sides are found equal."""
    return compare(query.run(spark, sf_dir), query.sql, sf_dir)


def compare(df, sql: str, sf_dir: str) -> int:
    spark_types, spark_rows = spark_result(df)
    sql_types, sql_rows = sql_result(sql, sf_dir)
    assert spark_types == sql_types, (spark_types, sql_types)
    missing, extra = sql_rows - spark_rows, spark_rows - sql_rows
    assert not missing and not extra, (missing.most_common(3), extra.most_common(3))
    return sum(spark_rows.values())
